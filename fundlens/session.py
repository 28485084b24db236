"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from fundlens.sources.files import age_seconds, list_folder, remove_files

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # Hot join keys are split at run time; both join sides of the big joins in
    # this package sit directly on a shuffle, which is what the rule asks for.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A map task that ran again with other rows makes the stages behind it run again as a whole.
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}


# Input bytes per shuffle partition. The jobs shuffle narrow rows, a fraction of what they read.
BYTES_PER_PARTITION = 512 * 1024**2
PARTITION_RANGE = (200, 50_000)


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions for shuffles over ``input_bytes``; AQE merges those that turn out small.

    AQE only ever lowers the number, so the start has to fit the input: at 100 TB
    the default of 200 would give partitions that no executor can sort in memory.
    """
    low, high = PARTITION_RANGE
    return min(high, max(low, -(-input_bytes // BYTES_PER_PARTITION)))


def with_settings(builder: SparkSession.Builder, input_bytes: int | None = None) -> SparkSession.Builder:
    """Add the settings the jobs expect to a session builder.

    Pass the size of the input to size the shuffles by it.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    return builder


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting falls back to a temporary folder: executors of a cluster could
    not read each other's local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="fundlens-"))
    return sc.getCheckpointDir().rstrip("/")


def staging_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_root(spark)}/fundlens/{tag}-{uuid.uuid4().hex}"


def write_observed(
    df: DataFrame, path: str, codec: str | None = None, mode: str = "errorifexists", **observed: Column
) -> tuple[DataFrame, dict]:
    """Write ``df`` as Parquet; returns what lies there and aggregates of its rows, without reading them again."""
    observation = Observation()
    if observed:
        df = df.observe(observation, *[c.alias(n) for n, c in observed.items()])
    df.write.parquet(path, mode, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path), observation.get if observed else {}


@contextlib.contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """What a write shuffles goes when the write ends.

    Otherwise it stays on the executors' disks until the driver happens to collect
    garbage, so a job of many steps holds the shuffles of steps long past. For jobs
    whose steps are read as files: a frame that is run again shuffles anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Step:
    """A frame that was written under the shared folder.

    ``observed`` are aggregates of its rows, taken while they are written; they are
    the last thing before the write, so a task that runs again counts once.
    """

    def __init__(self, df: DataFrame, tag: str = "step", **observed: Column):
        self.spark = df.sparkSession
        self.path = staging_path(self.spark, tag)
        self.frame, self.seen = write_observed(df, self.path, **observed)

    def remove(self) -> None:
        """Delete the files; for steps whose only reader has itself been written."""
        remove_files(self.spark, self.path)


def cut_lineage(df: DataFrame, tag: str = "step") -> DataFrame:
    """Write ``df`` under the shared folder and go on from what was written.

    Rows read afterwards do not depend on executors that are still alive, and
    non-deterministic columns keep the values they were written with. Parquet
    keeps the step small, gives Spark its true size, and lets later reads take
    single columns. :func:`clean_steps` removes what old runs have left.
    """
    return Step(df, tag).frame


def clean_steps(spark: SparkSession, older_than_seconds: float) -> list[str]:
    """Delete staged steps that nobody has written to for so long; returns their paths.

    Runs share the folder, so the age has to exceed the longest run. Only what
    :func:`staging_path` names lies there: published tables never do.
    """
    steps = list_folder(spark, f"{checkpoint_root(spark)}/fundlens")
    # A step's age is that of its newest entry, so one that is being written is never old.
    old = [path for path in steps if age_seconds(spark, path) > older_than_seconds]
    for path in old:
        remove_files(spark, path)
    return old
