"""Benchmark passages in documents, found by the q-gram lemma and verified by alignment.

A passage of m bytes that occurs with at most k edits shares at least
m - q + 1 - k*q of its q-grams with the document, and all of them lie on k + 1
neighbouring diagonals (Rasmussen, Stoye, Myers, "Efficient q-gram filters for
finding all epsilon-matches over a given length", 2006). Bands of 2(k + 1)
diagonals overlap by half, so one of them holds every such run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fundlens.llm.common import in_chunks, mix, releasing

Q = 12
EDIT_RATE = 0.06
# Passages shipped to the workers at a time; a larger benchmark is searched in several rounds.
ROUND_BYTES = 16 * 1024**2
_TABLE_BITS = 24

_FLAT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MATCHES = "doc_id long, item_id long, start long, end long, edits int"


def canonical(text: str | None) -> bytes:
    """Lower case; everything but letters, digits and non-ASCII characters is one blank."""
    return b" ".join((text or "").lower().encode().translate(_FLAT).split())


def edit_budget(m: int, rate: float = EDIT_RATE, q: int = Q) -> int:
    """Edits allowed in a passage of m bytes: the rate, as far as the lemma can still tell."""
    return max(0, min(int(rate * m), (m - q) // q))


def gram_codes(data: bytes, q: int = Q) -> np.ndarray:
    """Hash of the q bytes at each position."""
    n = len(data) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    padded = np.frombuffer(data + bytes(8), np.uint8)
    words = np.empty(n + q, np.uint64)
    for shift in range(8):
        part = padded[shift : shift + (len(padded) - shift) // 8 * 8].view("<u8")[: len(words[shift::8])]
        words[shift::8][: len(part)] = part
    return mix(words[:n] * np.uint64(0x9E3779B97F4A7C15) ^ words[q - 8 : q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F))


def align(item: bytes, text: bytes, limit: int) -> tuple[int, int, int] | None:
    """Least edits of ``item`` against any part of ``text``: (edits, start, end), or None above the limit.

    Row by row over the item; a row holds the band of the text and the start of the best path to each cell.
    """
    at = text.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    line = np.frombuffer(text, np.uint8)
    places = np.arange(len(line) + 1)
    costs, starts = np.zeros(len(line) + 1, np.int64), places.copy()
    for i, byte in enumerate(item, 1):
        swap, skip = costs[:-1] + (line != byte), costs[1:] + 1
        best = np.concatenate([[i], np.minimum(swap, skip)])
        origin = np.concatenate([[0], np.where(swap <= skip, starts[:-1], starts[1:])])
        level = best - places
        reach = np.minimum.accumulate(level)
        # Where a path came along the row, its start is that of the place it left.
        source = np.maximum.accumulate(np.where(level == reach, places, 0))
        costs, starts = reach + places, origin[source]
        if costs.min() > limit:
            return None
    end = int(costs.argmin())
    return (int(costs[end]), int(starts[end]), end) if costs[end] <= limit else None


class PassageIndex:
    """q-grams of the passages: a bit table in front of a sorted list."""

    def __init__(self, items: list[tuple[int, bytes]], q: int = Q, rate: float = EDIT_RATE):
        self.q, self.items = q, [(i, t) for i, t in items if len(t) >= q]
        # Too short for a q-gram, and for an edit: found as they are, between the ends of words.
        short = [(i, t) for i, t in items if 0 < len(t) < q]
        self.short = [(i, re.compile(rb"(?<![^ ])" + re.escape(t) + rb"(?![^ ])")) for i, t in short]
        codes = [gram_codes(t, q) for _, t in self.items]
        sizes = [len(c) for c in codes]
        every = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.item = np.repeat(np.arange(len(codes)), sizes)[order]
        self.offset = (np.concatenate([np.arange(n) for n in sizes]) if sizes else np.empty(0, np.int64))[order]
        self.codes, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.codes >> np.uint64(64 - _TABLE_BITS)] = True
        self.length = np.array([len(t) for _, t in self.items], np.int64)
        self.budget = np.array([edit_budget(len(t), rate, q) for _, t in self.items], np.int64)
        self.least = np.maximum(1, self.length - q + 1 - self.budget * q)

    def regions(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of the text windows whose bands share enough q-grams."""
        codes = gram_codes(data, self.q)
        near = np.flatnonzero(self.table[codes >> np.uint64(64 - _TABLE_BITS)])
        place = np.searchsorted(self.codes, codes[near])
        place[place == len(self.codes)] = 0
        same = self.codes[place] == codes[near] if len(self.codes) else np.zeros(len(near), bool)
        near, place = near[same], place[same]
        if not len(near):
            return
        times = self.count[place]
        index = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.first[place], times)
        item, diagonal = self.item[index], np.repeat(near, times) - self.offset[index]
        width = self.budget[item] + 1
        band = (diagonal + (1 << 32)) // width
        keys = np.concatenate([item << 40 | band, item << 40 | (band - 1)])
        keys, hits = np.unique(keys, return_counts=True)
        found = keys[hits >= self.least[keys >> 40]]
        last = None
        for key in found.tolist():  # ordered by item and place; touching bands are one window
            i, k = key >> 40, int(self.budget[key >> 40])
            lower = (key & (1 << 40) - 1) * (k + 1) - (1 << 32)
            start, end = max(0, lower - k), lower + 2 * (k + 1) + int(self.length[i]) + k
            if last and last[0] == i and start <= last[1] + 2 * (k + 1):
                last = (i, last[1], end)
            else:
                if last:
                    yield last
                last = (i, start, end)
        if last:
            yield last

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item_id, start, end, edits) of the verified regions."""
        for item_id, pattern in self.short:
            for n, text in enumerate(texts):
                for match in pattern.finditer(text):
                    yield n, item_id, match.start(), match.end(), 0
        gap = bytes(self.q)
        data = gap.join(texts)
        begins = np.cumsum([0] + [len(t) + self.q for t in texts])
        for i, start, end in self.regions(data):
            # A window may reach over the ends of its text, or over several texts.
            for n in range(max(0, np.searchsorted(begins, start, "right") - 1), len(texts)):
                if begins[n] >= end:
                    break
                lo, hi = max(0, start - int(begins[n])), end - int(begins[n])
                if found := align(self.items[i][1], texts[n][lo:hi], int(self.budget[i])):
                    edits, a, b = found
                    yield n, self.items[i][0], lo + a, lo + b, edits


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE, round_bytes: int = ROUND_BYTES
) -> DataFrame:
    """(doc_id, item_id, start, end, edits): where a document has a passage with at most ``edit_rate`` edits per byte.

    Places are bytes of the canonical text; passages that touch each other count as
    one place with the best match. Passages with fewer than q bytes match without edits
    and as whole words; null and empty ones never match, null texts have none. Repeated
    documents or items give repeated rows, an empty table on either side none.
    Passages are shipped in rounds of a checked size, each against all documents.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull())
    rounds = 1 + (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // round_bytes
    found = []
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for turn in range(rounds):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == turn)
        shipped = [(r["item_id"], canonical(r["text"])) for r in part.collect()]

        def search(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            index = PassageIndex(shipped, q, edit_rate)
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                rows = []
                for start, end in in_chunks(texts):
                    flat = [canonical(t) for t in texts[start:end]]
                    rows += [(ids[start + n], *rest) for n, *rest in index.matches(flat)]
                columns = list(zip(*rows)) or [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.int32()]
                names = ["doc_id", "item_id", "start", "end", "edits"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        found.append(narrow.mapInArrow(releasing(search), MATCHES))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
