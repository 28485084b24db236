"""Hard negatives of anchor vectors, by exact scores from the Method of Four Russians.

Vectors are integers. A candidate is kept as bit planes: for each plane and each
group of eight dimensions one byte. An anchor has a table of all 256 subset sums
per group; a candidate's byte picks its sum, and the planes are added up by
shifting. Anchors and candidates meet in a grid of blocks: a cell holds a bounded
number of both, and what leaves it is the few best of each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fundlens.llm.common import only
from fundlens.session import cut_lineage

GROUP = 8
SCALE = 256
# Candidates and anchors of one cell: what bounds its memory.
CELL_CANDIDATES, CELL_ANCHORS = 131_072, 8_192
# Cells a block of anchors is spread over at least, so that few rows still use several tasks.
LEAST_BLOCKS = 12
# Candidates and anchors scored at once; the tables of so many anchors stay in a core's cache.
STEP_CANDIDATES, STEP_ANCHORS = 2_048, 128
POSITIVES, NEGATIVES = 5, 3
FROM_PERCENT, TO_PERCENT = 50, 95


def quantised(embedding: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, null unless all of them are finite numbers."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))
    return F.when(F.col(embedding).isNotNull() & usable, scaled)


def vector_rows(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector): rows that take part, each distinct one once.

    A null label, null vector or a component that is null or not finite excludes a row.
    """
    kept = only(rows, "vec_id", "label", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), quantised("embedding", scale).alias("vector")
    )
    return kept.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).distinct()


def planes_of(low: int, high: int) -> int:
    """Bits that hold every whole number from ``low`` to ``high`` in two's complement."""
    return 1 + max(int(high).bit_length(), (-int(low) - 1).bit_length() if low < 0 else 0)


def pack_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Bytes (row, plane, group): bit j of a byte is that plane of dimension 8 * group + j."""
    rows, dims = vectors.shape
    groups = -(-dims // GROUP)
    out = np.empty((rows, planes, groups), np.uint8)
    for p in range(planes):
        out[:, p] = np.packbits(((vectors >> p) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def subset_sums(anchors: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """Table (group, byte, anchor): the sum of the anchor's components whose bit is set in the byte."""
    count, dims = anchors.shape
    groups = -(-dims // GROUP)
    padded = np.zeros((count, groups * GROUP), kind)
    padded[:, :dims] = anchors
    table = np.zeros((groups, 1 << GROUP, count), kind)
    for j in range(GROUP):
        table[:, 1 << j : 2 << j] = table[:, : 1 << j] + padded[:, j::GROUP].T[:, None, :]
    return table


def table_scores(table: np.ndarray, packed: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """Inner products (candidate, anchor): a plane's looked-up sums, added to twice those of the planes above."""
    rows, planes, groups = packed.shape
    total = np.zeros((rows, table.shape[2]), kind)
    for p in range(planes - 1, -1, -1):
        plane = table[0][packed[:, p, 0]] if groups else np.zeros(total.shape, table.dtype)
        for g in range(1, groups):
            plane += table[g][packed[:, p, g]]
        np.left_shift(total, 1, out=total)
        if p == planes - 1:  # the sign's plane
            np.subtract(total, plane, out=total)
        else:
            np.add(total, plane, out=total)
    return total


class _Sizes:
    """What the staged vectors say of their numbers: widths that hold every sum exactly."""

    def __init__(self, vectors: DataFrame, anchors: Column):
        low, high = F.array_min("vector"), F.array_max("vector")
        numbers = [F.count(F.lit(1)), F.count(F.when(anchors, 1)), F.max(F.size("vector")), F.min(low), F.max(high)]
        self.rows, self.anchors, dims, low, high = [x or 0 for x in vectors.agg(*numbers).first()]
        self.dims, largest = dims, max(abs(low), abs(high))
        self.planes = planes_of(low, high)
        # Scores are compared as hundredths, in 64 bits.
        if 100 * dims * largest * largest >= 2**62:
            raise ValueError(f"scores of {dims} components up to {largest} do not fit 64 bits")
        whole = dims * largest
        self.sums = np.int16 if whole < 2**15 else np.int32 if whole < 2**31 else np.int64
        self.scores = np.int32 if whole * largest < 2**30 else np.int64


def _matrix(vectors: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors end in zeros."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat, sizes = np.asarray(lists.flatten()).astype(np.int64), np.asarray(lists.value_lengths())
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


class _Cell:
    """The candidates of one cell in the order of their ids, null last, so that ties fall to the first."""

    def __init__(self, table: pa.Table, sizes: _Sizes):
        ids = table["vec_id"].combine_chunks()
        self.null = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0))
        order = np.lexsort((self.ids, self.null))
        self.null, self.ids = self.null[order], self.ids[order]
        self.labels = np.asarray(table["label"])[order]
        data = np.frombuffer(b"".join(table["planes"].to_pylist()), np.uint8)
        self.packed = data.reshape(len(order), sizes.planes, -(-sizes.dims // GROUP))[order]
        self.sizes = sizes

    def scores(self, anchors: np.ndarray, places: np.ndarray) -> np.ndarray:
        """(anchor, candidate) scores of the candidates at ``places``."""
        table = subset_sums(anchors, self.sizes.sums)
        out = np.empty((len(anchors), len(places)), self.sizes.scores)
        for at in range(0, len(places), STEP_CANDIDATES):
            step = places[at : at + STEP_CANDIDATES]
            out[:, at : at + len(step)] = table_scores(table, self.packed[step], self.sizes.scores).T
        return out

    def id_at(self, place: int) -> int | None:
        return None if self.null[place] else int(self.ids[place])


def best_places(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, equal ones in order."""
    if len(scores) > most:
        limit = np.partition(scores, len(scores) - most)[len(scores) - most]
        places = np.flatnonzero(scores >= limit)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")[:most]]


def _grid(vectors: DataFrame, sizes: _Sizes, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Anchors and packed candidates, each repeated for the cells (``_a``, ``_c``) of their row or column."""
    across = max(1, -(-sizes.anchors // CELL_ANCHORS))
    down = max(LEAST_BLOCKS, -(-sizes.rows // CELL_CANDIDATES))
    dims, planes = sizes.dims, sizes.planes

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pack_planes(_matrix(batch.column(2), dims), planes)
            columns = [batch.column(0), batch.column(1), pa.array([row.tobytes() for row in packed], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(3)], names=["vec_id", "label", "planes", "_c"])

    place = F.xxhash64("vec_id", "label", "vector")
    block = vectors.withColumn("_c", F.pmod(place, F.lit(down)).cast("int"))
    packed = block.mapInArrow(pack, "vec_id long, label long, planes binary, _c int")
    cells = across * down
    right = packed.withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    # The block of an anchor follows other bits than its place among the candidates.
    left = anchors.withColumn("_a", F.pmod(F.xxhash64(F.lit("anchor"), place), F.lit(across)).cast("int"))
    left = left.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    return left.repartition(cells, "_a", "_c"), right.repartition(cells, "_a", "_c")


def _table(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, fields)})


def positives(vectors: DataFrame, sizes: _Sizes, anchors: DataFrame, most: int = POSITIVES) -> DataFrame:
    """(anchor_id, _key, positive_id, positive_score): the best other rows of each anchor's label."""
    fields = [("anchor_id", pa.int64()), ("_key", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _table([], fields)
        cell, rows = _Cell(right, sizes), []
        ids, keys, labels = (left[c].to_pylist() for c in ("vec_id", "_key", "label"))
        matrix, by_label = _matrix(left["vector"], sizes.dims), np.asarray(left["label"])
        for label in sorted(set(labels)):
            places, asked = np.flatnonzero(cell.labels == label), np.flatnonzero(by_label == label)
            for at in range(0, len(asked), STEP_ANCHORS):
                some = asked[at : at + STEP_ANCHORS]
                for i, scores in zip(some, cell.scores(matrix[some], places)):
                    others = np.flatnonzero(cell.null[places] | (cell.ids[places] != ids[i]))
                    for j in others[best_places(scores[others], most)]:
                        rows.append((ids[i], keys[i], cell.id_at(places[j]), int(scores[j])))
        return _table(rows, fields)

    left, right = _grid(vectors, sizes, anchors)
    schema = "anchor_id long, _key long, positive_id long, positive_score long"
    found = left.groupBy("_a", "_c").cogroup(right.groupBy("_a", "_c")).applyInArrow(score, schema)
    order = Window.partitionBy("anchor_id", "_key").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last())
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    most_positives: int = POSITIVES,
    most_negatives: int = NEGATIVES,
    from_percent: int = FROM_PERCENT,
    to_percent: int = TO_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    ``anchors`` is a condition on ``vec_id``; a null id is no anchor. A positive is
    one of the best rows of the anchor's label; its negatives are the best rows of
    other labels whose score lies between the two percentages of its own, equal
    scores by id, null last. Scores are exact whole numbers.

    Copies of a row (id, label and vector) count once; rows that share an id and
    differ are rows of their own, and no row is a positive of its own id. Vectors
    of unequal length are filled up with zeros. An empty table gives no row; an
    anchor without positives or a positive without negatives gives none either.
    Values too large for exact 64-bit scores are an error.
    """
    vectors = cut_lineage(vector_rows(rows, scale), "vectors")
    # Of no column but the id: other columns cannot clash with the condition.
    is_anchor = F.coalesce(anchors, F.lit(False)) & F.col("vec_id").isNotNull()
    sizes = _Sizes(vectors, is_anchor)
    key = F.xxhash64("vec_id", "label", "vector").alias("_key")
    asked = vectors.where(is_anchor).select("vec_id", "label", "vector", key)
    found = cut_lineage(positives(vectors, sizes, asked, most_positives), "positives")
    per_anchor = found.groupBy("anchor_id", "_key").agg(
        F.array_sort(F.collect_list(F.struct("_r", "positive_id", "positive_score"))).alias("wanted")  # a few each
    )
    known = asked.join(per_anchor.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "_key"])
    known = known.select("vec_id", "label", "vector", "_key", F.col("wanted._r").alias("_rs"), F.col("wanted.positive_score").alias("_scores"))

    fields = [("anchor_id", pa.int64()), ("_key", pa.int64()), ("_r", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _table([], fields)
        cell, out = _Cell(right, sizes), []
        ids, keys, ranks, wanted = (left[c].to_pylist() for c in ("vec_id", "_key", "_rs", "_scores"))
        matrix, labels, places = _matrix(left["vector"], sizes.dims), np.asarray(left["label"]), np.arange(len(cell.ids))
        for at in range(0, len(ids), STEP_ANCHORS):
            some = range(at, min(at + STEP_ANCHORS, len(ids)))
            for i, scores in zip(some, cell.scores(matrix[at : at + STEP_ANCHORS], places)):
                # Whole-number limits of from * positive <= 100 * negative <= to * positive.
                spans = [(-(-from_percent * s // 100), to_percent * s // 100) for s in wanted[i]]
                least, most = min(a for a, _ in spans), max(b for _, b in spans)
                near = np.flatnonzero((scores >= least) & (scores <= most) & (cell.labels != labels[i]))
                near = near[np.argsort(-scores[near], kind="stable")]
                falling = -scores[near].astype(np.int64)
                for r, (low, high) in zip(ranks[i], spans):
                    first, end = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
                    for j in near[first : min(end, first + most_negatives)]:
                        out.append((ids[i], keys[i], r, cell.id_at(j), int(scores[j])))
        return _table(out, fields)

    left, right = _grid(vectors, sizes, known)
    schema = "anchor_id long, _key long, _r int, negative_id long, negative_score long"
    near = left.groupBy("_a", "_c").cogroup(right.groupBy("_a", "_c")).applyInArrow(score, schema)
    order = Window.partitionBy("anchor_id", "_key", "_r").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_negatives)
    joined = best.join(found, ["anchor_id", "_key", "_r"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
