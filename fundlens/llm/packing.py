"""Packing of tokenised documents into sequences of a fixed capacity.

Shortest-pack-first over the length histogram (Krell et al., "Efficient Sequence
Packing without Cross-contamination", 2021): lengths are placed longest first,
always on the packs that are shortest so far, and whole counts of equal packs move
at a time. Only the histogram, at most one number per length, reaches the driver.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fundlens.llm.common import _LOWER, in_chunks, only, releasing, worker_state
from fundlens.llm.word_cache import WordCache
from fundlens.session import cut_lineage

CAPACITY = 2048
END_ID = 1
# Bytes of each generation of a worker's cache.
CACHE_BYTES = 64_000_000
WORDS_PER_TEXT = 512
# Characters of text whose distinct words are looked up together.
CHUNK_CHARS = 2_000_000
# Pieces of one bucket; ranks are counted within a bucket and length.
ROWS_PER_BUCKET, LEAST_BUCKETS = 100_000, 64

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class _WordIds:
    """Ids (as unsigned 32-bit bytes) of words without white space, looked up in the worker's cache."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks use all cores already
        self.tokenizer = Tokenizer.from_file(path)
        self.cache = WordCache(CACHE_BYTES)
        self.points = {p: self.encode(p) for p in (b".", b",")}
        self.mark = b"|"
        (self.mark_id,) = np.frombuffer(self.encode(self.mark), "<u4").tolist()

    def encode(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        # A letter before the last full stop or comma: the sign is a token run of its own.
        points = [self.points.get(w[-1:], b"") if w[-2:-1].isalpha() else b"" for w in words]
        stems = [w[:-1] if p else w for w, p in zip(words, points)]
        # Many words as one text, with a mark between them that has a token of its own.
        out = [self.encode(w) if self.mark in w else b"" for w in stems]
        marked = [i for i, w in enumerate(stems) if self.mark not in w]
        groups = [marked[at : at + WORDS_PER_TEXT] for at in range(0, len(marked), WORDS_PER_TEXT)]
        texts = [(b" %b " % self.mark).join(stems[i] for i in g).decode() for g in groups]
        for group, encoding in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = array("I", encoding.ids)
            cuts = [-1, *np.flatnonzero(np.frombuffer(ids, "<u4") == self.mark_id).tolist(), len(ids)]
            data = ids.tobytes()
            for i, a, b in zip(group, cuts, cuts[1:], strict=False):
                out[i] = data[4 * a + 4 : 4 * b]
            if len(cuts) != len(group) + 1:  # not seen, but then each word alone
                for i in group:
                    out[i] = self.encode(stems[i])
        return [w + p for w, p in zip(out, points)]

    def ids(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of at least the given words."""
        return self.cache.holding(words, self._encoded)


def _encoder(path: str):
    """Text to ids: the tokenizer works on each word apart, so a word's ids are looked up."""
    state = worker_state("tokenizer")
    if getattr(state, "path", None) != path:
        state.path, state.ids = path, _WordIds(path)
    return state.ids


def _ids_of_batch(texts: list[str | None], path: str) -> Iterator[bytes]:
    encoder = _encoder(path)
    for start, end in in_chunks(texts, CHUNK_CHARS):
        # A to Z in lower case as the tokenizer does it; its special tokens are told by their "<|".
        split = [(t or "").encode().translate(_LOWER).split() for t in texts[start:end]]
        special = [bool(t) and "<|" in t for t in texts[start:end]]
        known = encoder.ids({w for words, s in zip(split, special) if not s for w in words})
        for text, words, odd in zip(texts[start:end], split, special):
            yield encoder.encode(text.encode()) if odd else b"".join(map(known.__getitem__, words))


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: each document's ids and the end id, cut after every ``capacity`` ids.

    ``with_ids`` adds the ids themselves (binary, little-endian unsigned 32-bit). A
    null text is empty and gives one piece with the end id; a null doc_id is kept.
    """
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), _ids_of_batch(batch.column(1).to_pylist(), tokenizer)):
                ids += end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    row = (doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                    out.append((*row, piece) if with_ids else row)
            if out:
                columns = list(zip(*out))
                kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = PIECES + (", ids binary" if with_ids else "")
    return only(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text").mapInArrow(releasing(cut), schema)


def place_lengths(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Shortest-pack-first: (length, first rank, count, first sequence, offset) for every group of equal moves.

    Sequences ``first sequence`` .. + count take one piece of the length each, at
    the same offset. The heap holds runs of sequences that are filled alike.
    """
    packs: list[tuple[int, int, int]] = []  # filled, first sequence, count
    moves, opened = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if packs and packs[0][0] + length <= capacity:
                filled, first, count = heapq.heappop(packs)
                if count > left:
                    heapq.heappush(packs, (filled, first + left, count - left))
            else:
                filled, first, count = 0, opened, left
                opened += left
            taken = min(count, left)
            moves.append((length, rank, taken, first, filled))
            if filled + length < capacity:
                heapq.heappush(packs, (filled + length, first, taken))
            rank, left = rank + taken, left - taken
    return moves


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Rank of each piece among those of its length: a place in its bucket behind all earlier buckets.

    Buckets split a common length; they follow the ids alone, so that a task that is
    run again gives the same ranks.
    """
    buckets = max(LEAST_BUCKETS, rows // ROWS_PER_BUCKET)
    tagged = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    counts = tagged.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    placed = tagged.withColumn("_place", F.row_number().over(inside) - 1)
    return placed.join(bases, ["length", "_bucket"]).withColumn("_rank", F.col("_base") + F.col("_place"))


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Every id lies in exactly one piece; a sequence is filled from offset 0 without
    gaps. Repeated rows are packed like any others, an empty table gives no row.
    """
    spark = docs.sparkSession
    pieces = cut_lineage(tokenized_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    moves = place_lengths(histogram, capacity)
    slots = spark.createDataFrame(
        [(n, at, at + count, first, offset) for n, at, count, first, offset in moves],
        "length long, _from long, _to long, _first long, offset long",
    )
    # One row per move; the moves are bounded by the capacity, not by the documents.
    here = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    ranked = _ranked(pieces, sum(histogram.values())).alias("p")
    placed = ranked.join(F.broadcast(slots).alias("s"), (F.col("p.length") == F.col("s.length")) & here)
    sequence = (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id")
    return placed.select(*[F.col(f"p.{c}") for c in pieces.columns], sequence, F.col("offset"))
