"""Word bigram model by deleted interpolation, and the log-probability of every document.

Maximum-likelihood estimates of the bigram, the word and the uniform choice are
mixed. Mixture weights depend on how often the context was seen, in
octaves, and are learned by expectation-maximisation on the counts of a held-out part of
the learning documents (Jelinek, Mercer, "Interpolated estimation of Markov source
parameters from sparse data", 1980). Words and bigrams are counted over all
learning documents; only a histogram of bounded size reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from fundlens.llm.common import in_chunks, mix, word_hashes
from fundlens.llm.exchange import KEY_BITS, batched, batches_of, pack_sorted, part_bounds, parts_for, unpack_sorted
from fundlens.session import cut_lineage

# Parts a document can play: counted, counted and used to learn the weights, or only scored.
MAIN, WEIGHTS, SCORED = 0, 1, 2
END, BEGIN = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xC6A4A7935BD1E995)
OCTAVES = 40
# Steps per octave in the histogram of estimates for learning the weights.
GRID = 8
ROUNDS = 100
_BINS = 64 * GRID

_SENT = "part int, batch long, keys binary, main binary, weights binary"
_BACK = "batch long, part int, main binary, weights binary, ids array<long>, roles binary, lengths binary, vocabulary binary, sequence binary"
_KEPT = "batch long, ids array<long>, roles binary, lengths binary, sequence binary, words binary, pairs binary"


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers below 2^64 as compressed byte planes: those that are zero cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<i8")


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each with one end, and the number of tokens per text."""
    parts, lengths = [], []
    for start, end in in_chunks(texts):
        hashes, begins = word_hashes(texts[start:end])
        parts.append(np.insert(hashes, begins[1:], END))
        lengths.append(np.diff(begins) + 1)
    return np.concatenate(parts), np.concatenate(lengths)


class _Batch:
    """Token numbers of a batch in its own vocabulary, and its distinct bigrams."""

    def __init__(self, sequence: np.ndarray, lengths: np.ndarray, words: int):
        self.sequence, self.lengths = sequence, lengths
        self.starts = np.cumsum(lengths) - lengths
        context = np.empty_like(sequence)
        context[1:] = sequence[:-1]
        context[self.starts] = words  # the begin of a text, behind all words
        self.context = context
        self.pairs, self.pair = np.unique(context * (words + 1) + sequence, return_inverse=True)
        self.words = words

    def keys(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash keys of the words (even), the begin, and the bigrams (odd), in order, and that order."""
        hashes = np.append(vocabulary, BEGIN)
        single = mix(hashes ^ np.uint64(0xA5A5A5A5)) >> np.uint64(64 - KEY_BITS)
        first, second = hashes[self.pairs // (self.words + 1)], hashes[self.pairs % (self.words + 1)]
        double = mix(first * np.uint64(0x9E3779B97F4A7C15) + mix(second)) >> np.uint64(64 - KEY_BITS)
        keys = np.concatenate([single & ~np.uint64(1), double | np.uint64(1)])
        order = np.argsort(keys, kind="stable")
        return keys[order], order


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(x.split() for x in schema.split(", ")))
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


def counted_batches(docs: DataFrame, role: Column) -> DataFrame:
    """Batches of documents with the counts of all their words and bigrams over the whole corpus.

    The batch -1 has the number of tokens and of distinct words.
    """
    parts = parts_for(docs)
    narrow = batched(docs, role.cast("int").alias("role"))

    def numbered(batches: Iterator[pa.RecordBatch]):
        for number, (ids, texts, roles) in batches_of(batches):
            tokens, lengths = _tokens(texts)
            vocabulary, sequence = np.unique(tokens, return_inverse=True)
            yield number, ids, np.array(roles, np.int64), vocabulary, _Batch(sequence, lengths, len(vocabulary))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, roles, vocabulary, b in numbered(batches):
            keys, order = b.keys(vocabulary)
            token_role, counts = np.repeat(roles, b.lengths), []
            for r in (MAIN, WEIGHTS):
                mine = token_role == r
                words = np.bincount(b.sequence[mine], minlength=b.words)
                pairs = np.bincount(b.pair[mine], minlength=len(b.pairs))
                counts.append(np.concatenate([words, [(roles == r).sum()], pairs])[order])
            bounds = part_bounds(keys, parts)
            for p in range(parts):
                cut = slice(bounds[p], bounds[p + 1])
                if bounds[p + 1] > bounds[p]:
                    yield _table([(p, number, pack_sorted(keys[cut]), _squeeze(counts[0][cut]), _squeeze(counts[1][cut]))], _SENT)

    def add(table: pa.Table) -> pa.Table:
        """The corpus counts of each block's keys."""
        rows = table.to_pylist()
        keys = [unpack_sorted(r["keys"]) for r in rows]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = [np.bincount(place, np.concatenate([_unsqueeze(r[c]) for r in rows]), len(distinct)).astype(np.int64) for c in ("main", "weights")]
        out, at = [], 0
        begin = mix(np.array([BEGIN]) ^ np.uint64(0xA5A5A5A5)) >> np.uint64(64 - KEY_BITS) & ~np.uint64(1)
        word = (distinct & np.uint64(1) == 0) & (distinct != begin)
        stats = [int(sums[0][word].sum()), int(sums[1][word].sum()), int((sums[0] + sums[1] > 0)[word].sum())]
        for r, own in zip(rows, keys):
            mine = place[at : at + len(own)]
            at += len(own)
            out.append((r["batch"], r["part"], _squeeze(sums[0][mine]), _squeeze(sums[1][mine]), None, None, None, None, None))
        out.append((-1, rows[0]["part"], None, None, stats, None, None, None, None))
        return pa.Table.from_batches([_table(out, _BACK)])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, roles, vocabulary, b in numbered(batches):
            known = (_squeeze(roles), _squeeze(b.lengths), vocabulary.tobytes(), _squeeze(b.sequence))
            yield _table([(number, -1, None, None, ids, *known)], _BACK)

    def gather(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        if rows[0]["batch"] == -1:
            sums = np.array([r["ids"] for r in rows], np.int64).sum(0).tolist()
            return pa.Table.from_batches([_table([(-1, sums, None, None, None, None, None)], _KEPT)])
        known, blocks = rows[0], rows[1:]
        vocabulary = np.frombuffer(known["vocabulary"], np.uint64)
        b = _Batch(_unsqueeze(known["sequence"]), _unsqueeze(known["lengths"]), len(vocabulary))
        _, order = b.keys(vocabulary)
        counts = np.zeros((2, len(order)), np.int64)
        for i, c in enumerate(("main", "weights")):
            counts[i, order] = np.concatenate([_unsqueeze(r[c]) for r in blocks])  # lengths must agree
        words, pairs = counts[:, : b.words + 1].reshape(-1), counts[:, b.words + 1 :].reshape(-1)
        kept = (known["batch"], known["ids"], known["roles"], known["lengths"], known["sequence"], _squeeze(words), _squeeze(pairs))
        return pa.Table.from_batches([_table([kept], _KEPT)])

    summed = narrow.mapInArrow(send, _SENT).groupBy("part").applyInArrow(add, _BACK)
    return summed.unionByName(narrow.mapInArrow(describe, _BACK)).groupBy("batch").applyInArrow(gather, _KEPT)


def _rows(part: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: each holds a whole batch of texts."""
    for i in range(len(part)):
        yield part.slice(i, 1).to_pylist()[0]


def _opened(row: dict) -> tuple[_Batch, np.ndarray, np.ndarray, np.ndarray]:
    """Batch, roles, counts of words (and begin) and counts of bigrams, each as (main, weights)."""
    words, lengths = _unsqueeze(row["words"]).reshape(2, -1), _unsqueeze(row["lengths"])
    b = _Batch(_unsqueeze(row["sequence"]), lengths, words.shape[1] - 1)
    return b, _unsqueeze(row["roles"]), words, _unsqueeze(row["pairs"]).reshape(2, -1)


def _octave(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket per doubling of its count."""
    return np.where(counts > 0, np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, 0).clip(max=OCTAVES - 1)


def _step(ratio: np.ndarray) -> np.ndarray:
    """Place of a positive probability on the grid; 0 for none."""
    return np.where(ratio > 0, np.rint(-np.log2(np.maximum(ratio, 1e-18)) * GRID) + 1, 0).astype(np.int64).clip(max=_BINS - 1)


def learn_weights(batches: DataFrame, main_tokens: int, types: int) -> np.ndarray:
    """Weights (bigram, word, uniform) per octave of the context count.

    A token of the documents kept for the weights falls in a cell of octave and
    estimates, in steps of 1/8 octave; so the counts for the expectation steps are bounded.
    """

    def cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in _rows(part):
                b, roles, words, pairs = _opened(row)
                mine = np.repeat(roles == WEIGHTS, b.lengths)
                context, token, pair = b.context[mine], b.sequence[mine], b.pair[mine]
                seen = words[0][context]
                cell = _octave(seen) * _BINS * _BINS + _step(pairs[0][pair] / np.maximum(seen, 1)) * _BINS + _step(words[0][token] / max(1, main_tokens))
                keys, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    counted = batches.mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cell, n = counted["cell"].to_numpy(np.int64), counted["n"].to_numpy(float)
    octave = cell // (_BINS * _BINS)
    estimate = lambda step: np.where(step > 0, 2.0 ** (-(step - 1) / GRID), 0.0)
    chances = np.stack([estimate(cell // _BINS % _BINS), estimate(cell % _BINS), np.full(len(cell), 1 / (types + 1))])
    # A tenth of a token per choice keeps empty octaves defined.
    weights = np.full((OCTAVES, 3), 1 / 3)
    for _ in range(ROUNDS):
        parts = weights[octave].T * chances
        parts *= n / parts.sum(0)
        weights = np.stack([np.bincount(octave, p, OCTAVES) for p in parts], 1) + 0.1
        weights /= weights.sum(1, keepdims=True)
    return weights


def score_documents(docs: DataFrame, role: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``role`` is MAIN, WEIGHTS or SCORED; the first two are learned from. Scores are
    log10 probabilities of the whole text with its end; the base is the smoothed
    word model. A null text is empty: its end alone. Repeated rows are scored each;
    without learning documents all tokens are unknown.
    """
    batches = cut_lineage(counted_batches(docs, role), "counted")
    stats = batches.where("batch = -1").select("ids").first()
    main, held, types = stats["ids"] if stats else (0, 0, 0)
    total, batches = main + held, batches.where("batch >= 0")
    weights = learn_weights(batches, main, types)
    weights[0] = [0.0, *(weights[0, 1:] / weights[0, 1:].sum())]  # an unseen context has no bigram estimate

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in _rows(part):
                b, _, words, pairs = _opened(row)
                word, pair = words.sum(0), pairs.sum(0)
                seen, count = word[b.context], word[b.sequence]
                w = weights[_octave(seen)]
                chance = w[:, 0] * pair[b.pair] / np.maximum(seen, 1) + w[:, 1] * count / max(1, total) + w[:, 2] / (types + 1)
                base = np.log10((count + 0.1) / (total + 0.1 * (types + 1)))
                sums = [np.add.reduceat(x, b.starts) for x in ((count > 0).astype(np.int64), base, np.log10(chance))] if len(b.starts) else []
                n = len(b.starts)
                columns = [pa.array(row["ids"], pa.int64()), pa.array(b.lengths), pa.array(sums[0]), pa.array(np.full(n, total, np.int64)), *map(pa.array, sums[1:])]
                names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return batches.mapInArrow(score, schema)
