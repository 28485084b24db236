"""Blocks of hashed keys between the batches that hold texts and the parts that count keys.

A batch of texts sends its keys to parts of the hash range, as a few binary blocks
instead of a row per key: sorted keys as differences in byte planes, which
the shuffle compresses well, next to the number of the text that has each key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Characters of text in a batch, and keys that one part should hold.
BATCH_CHARS = 6_000_000
PART_CHARS = 12_000_000
MOST_TEXTS = 60_000
KEY_BITS = 56


def parts_for(docs: DataFrame, column: str = "text") -> int:
    """Parts of the hash range: at least three per shuffle partition, and enough for the input."""
    chars = docs.agg(F.sum(F.length(column).cast("long"))).first()[0] or 0
    spark: SparkSession = docs.sparkSession
    return max(3 * int(spark.conf.get("spark.sql.shuffle.partitions")), chars // PART_CHARS)


def batched(docs: DataFrame, *more: Column) -> DataFrame:
    """(partition, doc_id, text, more): what :func:`batches_of` takes."""
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(F.spark_partition_id().alias("_partition"), *own, *more)


def batches_of(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[tuple[int, list[list]]]:
    """(batch number, columns but the first): rows gathered up to a size, numbered so that a second run numbers alike."""
    serial = None
    rows, size = [], 0
    for batch in batches:
        if serial is None and len(batch):
            serial = batch.column(0)[0].as_py() << 24
        columns = [c.to_pylist() for c in batch.columns[1:]]
        for row in zip(*columns):
            n = len(row[text]) if row[text] else 0
            if rows and (size + n > BATCH_CHARS or len(rows) >= MOST_TEXTS):
                yield serial, [list(c) for c in zip(*rows)]
                serial, rows, size = serial + 1, [], 0
            rows.append(row)
            size += n
    if rows:
        yield serial, [list(c) for c in zip(*rows)]


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned values as byte planes of their differences."""
    steps = np.diff(values.astype("<u8"), prepend=np.zeros(1, "<u8"))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T[: KEY_BITS // 8]).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(KEY_BITS // 8, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : KEY_BITS // 8] = planes.T
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def part_bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins among ascending keys of :data:`KEY_BITS` bits (one entry more than parts)."""
    # Exact: the limits of the parts as whole numbers.
    limits = np.array([(p << KEY_BITS) // parts for p in range(parts + 1)], np.uint64)
    return np.searchsorted(keys, limits)
