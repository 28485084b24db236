"""Global row numbers without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fundlens.session import cut_lineage

# monotonically_increasing_id: partition number above, row position in the low 33 bits.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[str], name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """Number all rows 1..n in the order of ``order`` (NULLs last), then of the other columns.

    Rows are range-partitioned and sorted within partitions, written once, and
    each partition is shifted by the sizes of those before it. Copies carry a
    tie-break id, so equal rows may also be spread over several partitions. The id
    is taken from written files: a task that runs again finds the same one.
    """
    rest = [c for c in df.columns if c not in order]
    keys = [F.col(c).asc_nulls_last() for c in [*order, *rest]] + [F.col("_copy").asc()]
    tagged = cut_lineage(df).withColumn("_copy", F.monotonically_increasing_id())
    ranged = tagged.repartitionByRange(partitions, *keys) if partitions else tagged.repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    placed = cut_lineage(placed.drop("_copy").withColumn("_part", F.shiftright("_place", _POSITION_BITS)))

    # One row per partition, so both the window and the broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_place").bitwiseAND((1 << _POSITION_BITS) - 1)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + 1)
        .select(*df.columns, name)
    )
