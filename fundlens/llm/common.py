"""Words, hashes and batches shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# White space of the word rule: space and the control characters 9 to 13.
WORD_GAP = r"[\x20\x09-\x0D]+"
CHUNK_BYTES = 500_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAPS = np.zeros(256, bool)
_GAPS[[32, *range(9, 14)]] = True
# Weights of the word hash: random numbers from a fixed seed.
_RANDOM = np.random.default_rng(20240607)
_BYTE_WEIGHTS = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 & ~0b111 | 0b101
_STEP_WEIGHTS = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text, A to Z in lower case; None has none."""
    return (text or "").encode().translate(_LOWER).split()


def worker_state(name: str) -> ModuleType:
    """Attributes that outlive a task in its Python worker; only for caches of pure functions."""
    return sys.modules.setdefault(f"_worker_state_{name}", ModuleType(name))


def release_memory() -> None:
    """Give unused memory back to the system: idle workers of earlier stages count as well."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def releasing(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function over batches, which gives memory back when its task ends."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            release_memory()

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; those of a chunk of texts are kept in the worker."""
    state = worker_state("powers")
    known = getattr(state, str(base), np.ones(1, np.uint64))
    while len(known) < n:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 2**64))])
        if len(known) <= 2 * CHUNK_BYTES:
            setattr(state, str(base), known)
    return known[:n]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text's words start (one entry more than texts).

    A word is a run without :data:`WORD_GAP`, A to Z in lower case; None has no
    word. The hash is a polynomial over weighted bytes, so it costs a few array
    operations per byte and is the same in every worker.
    """
    parts = [(t or "").encode() for t in texts]
    joined = (b" " + b" ".join(parts) + b" ").translate(_LOWER)
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = 1 + np.concatenate([[0], np.cumsum(lengths + 1)])
    gap = _GAPS[data]
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    terms = _BYTE_WEIGHTS[data] * _powers(_BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    inverse = pow(_BASE, -1, 2**64)
    hashes = (sums[ends] - sums[starts]) * _powers(inverse, len(data))[starts]
    return mix(hashes), np.searchsorted(starts, begins)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring entries."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += hashes[j : j + n] * _STEP_WEIGHTS[j]
    return mix(total)


def in_chunks(texts: list[str | None], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``most`` characters; a longer text stands alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone: whatever else a table carries cannot clash with a result."""
    return df.select(*columns)
