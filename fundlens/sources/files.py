"""Small file operations wherever the data is stored, through Hadoop's file system."""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import SparkSession


def _where(spark: SparkSession, path: str):
    """Hadoop path and the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as folder listings give it."""
    place, files = _where(spark, path)
    return files.makeQualified(place).toString()


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Paths of a folder's entries; none if there is no such folder."""
    place, files = _where(spark, path)
    return sorted(s.getPath().toString() for s in files.listStatus(place)) if files.exists(place) else []


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written, or since the newest entry of a folder was added."""
    place, files = _where(spark, path)
    times = [files.getFileStatus(place).getModificationTime()]
    if files.getFileStatus(place).isDirectory():
        times += [s.getModificationTime() for s in files.listStatus(place)]
    return time.time() - max(times) / 1000


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    place, files = _where(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove_files(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if there is none."""
    place, files = _where(spark, path)
    return files.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder; an error if that fails."""
    place, files = _where(spark, old)
    if not files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} could not be moved to {new}")


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole unless there is one of that name; False if there is.

    The text is written under a name that readers skip and then takes its place in
    one step that fails if the name is taken: a link on a local disk, a rename
    without overwriting elsewhere (atomic on HDFS; object stores need a file
    system with an atomic rename).
    """
    place, files = _where(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if files.getScheme() == "file":
            try:
                os.link(hidden.toUri().getPath(), files.makeQualified(place).toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(hidden, place, options)
        except Exception:
            if files.exists(place):
                return False
            raise
        return True
    finally:
        files.delete(hidden, False)
