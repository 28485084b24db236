"""Languages of the spans of a text: scripts narrow the candidates, Viterbi labels the words.

Each word has a score per language, from the n-grams of its letters; a path
through the words pays a penalty for every switch of language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fundlens.llm.common import in_chunks, mix, releasing, worker_state

# Fixed values: (name, first, last code point) of letters; signs inside a range count as letters.
SCRIPTS = [
    ("latin", 0x41, 0x5A),
    ("latin", 0x61, 0x7A),
    ("latin", 0xAA, 0xAA),
    ("latin", 0xB5, 0xB5),
    ("latin", 0xBA, 0xBA),
    ("latin", 0xC0, 0xD6),
    ("latin", 0xD8, 0xF6),
    ("latin", 0xF8, 0x2AF),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x531, 0x586),
    ("hebrew", 0x5D0, 0x5EA),
    ("arabic", 0x620, 0x6D3),
    ("devanagari", 0x900, 0x963),
    ("thai", 0xE01, 0xE3A),
    ("georgian", 0x10A0, 0x10FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3041, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7A3),
]
UNDETERMINED = "und"
BUCKET_BITS = 15
GRAMS = (1, 2, 3, 4)
# Labelled rows per language that the model learns from (in expectation).
TRAIN_ROWS = 2000
MOST_LANGUAGES = 1000
# Characters of texts that are labelled together: their distinct words are scored once.
CHUNK_CHARS = 2_000_000
SMOOTHING = 0.5
SWITCH_PENALTY = 12.0
# A language uses a script if so much of its letters are in it.
SCRIPT_SHARE = 0.01
_OTHER_SCRIPT = -30.0

SCRIPT_NAMES = list(dict.fromkeys(n for n, _, _ in SCRIPTS))
OTHER = len(SCRIPT_NAMES)  # letters of any other script


def _script_table() -> np.ndarray:
    """Script of every code point, -1 if it is no letter; kept in the worker."""
    state = worker_state("scripts")
    if not hasattr(state, "table"):
        letters = (OTHER if unicodedata.category(chr(p))[0] == "L" else -1 for p in range(0x110000))
        state.table = np.fromiter(letters, np.int8, 0x110000)
        for name, first, last in SCRIPTS:
            state.table[first : last + 1] = SCRIPT_NAMES.index(name)
    return state.table


class Words:
    """Letter runs of some texts: the distinct ones, which of them stands where, and where texts begin."""

    def __init__(self, texts: list[str | None]):
        lowered = [(t or "").lower() for t in texts]
        joined = " " + " ".join(lowered) + " "
        script = _script_table()[np.frombuffer(joined.encode("utf-32-le"), "<u4")]
        begins = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
        letter = script >= 0
        self.starts = np.flatnonzero(~letter[:-1] & letter[1:]) + 1
        self.ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
        self.script = script[self.starts]
        self.texts = np.searchsorted(self.starts, begins)
        index: dict[str, int] = {}
        found = (index.setdefault(joined[a:b], len(index)) for a, b in zip(self.starts.tolist(), self.ends.tolist()))
        self.which = np.fromiter(found, np.int64, len(self.starts))
        self.distinct = list(index)


def word_grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the n-grams that end at each letter of the words, by n, and the word of each letter.

    Before its first letter a word has gaps alone, so a word's n-grams are its own.
    """
    gap = max(GRAMS) - 1
    points = np.frombuffer((" " * gap + (" " * gap).join(words) + " ").encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    places = np.arange(len(owner)) + gap * (owner + 1)
    code, buckets = np.zeros(len(points), np.uint64), []
    for n in range(1, max(GRAMS) + 1):
        shifted = points if n == 1 else np.concatenate([np.full(n - 1, 32, np.uint64), points[: 1 - n]])
        code = mix(code * np.uint64(31) + shifted + np.uint64(n))
        if n in GRAMS:
            buckets.append((code[places] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return buckets, owner


def learning_rows(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(lang, text) of about ``rows`` labelled documents per language, chosen by a hash of the text."""
    named = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # A share per language in the filter itself: no text is shuffled to its language.
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
    chosen = F.lit(False)
    for r in counts:
        chosen |= (F.col("lang") == r["lang"]) & (draw < min(1.0, rows / r["n"]))
    return named.where(chosen).select("lang", "text")


class LanguageModel:
    """Log-probabilities of n-gram buckets per language, and the scripts each language uses."""

    def __init__(self, langs: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        smooth = grams + SMOOTHING
        self.scores = np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32).T.copy()
        uses = scripts >= SCRIPT_SHARE * scripts.sum(1, keepdims=True)
        uses |= ~uses.any(0)  # a script that no language uses tells nothing
        uses[:, OTHER:] = True  # nor do letters of scripts that have no name here
        self.narrowing = np.where(uses, 0.0, _OTHER_SCRIPT).T

    @classmethod
    def fit(cls, docs: DataFrame, rows: int = TRAIN_ROWS) -> LanguageModel:
        """Count buckets on the executors; the counts are bounded by languages and buckets."""

        buckets, scripts = 1 << BUCKET_BITS, OTHER + 1

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[str, np.ndarray] = {}
            for batch in batches:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = Words([text])
                    total = sums.setdefault(lang, np.zeros(buckets + scripts, np.int64))
                    grams, owner = word_grams(words.distinct)
                    times = np.bincount(words.which, minlength=len(words.distinct))[owner]
                    for places in grams:
                        total[:buckets] += np.bincount(places, times, buckets).astype(np.int64)
                    total[buckets:] += np.bincount(words.script, words.ends - words.starts, scripts).astype(np.int64)
            for lang, total in sums.items():
                keys = np.flatnonzero(total)
                columns = [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(total[keys])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "key", "n"])

        counted = learning_rows(docs, rows).mapInArrow(releasing(count), "lang string, key long, n long")
        table = counted.groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
        langs = sorted(table["lang"].unique())
        matrix = np.zeros((len(langs), buckets + scripts))
        matrix[[langs.index(x) for x in table["lang"]], table["key"].to_numpy(int)] = table["n"].to_numpy()
        return cls(langs, matrix[:, :buckets], matrix[:, buckets:])

    def word_scores(self, words: Words) -> np.ndarray:
        """Score of each word in each language: its n-grams, once per distinct word, and whether its script fits."""
        grams, owner = word_grams(words.distinct)
        per_place = sum(self.scores[b] for b in grams).astype(np.float64)
        begins = np.searchsorted(owner, np.arange(len(words.distinct)))
        sums = np.add.reduceat(per_place, begins, axis=0) if len(begins) else np.zeros((0, len(self.langs)))
        return sums[words.which] + self.narrowing[words.script]

    def label(self, texts: list[str | None], penalty: float = SWITCH_PENALTY) -> Iterator[list[tuple[str, int, int, int]]]:
        """Per text its spans (language, first place, end, letters), in order."""
        words = Words(texts)
        paths = viterbi(self.word_scores(words), words.texts, penalty) if self.langs else None
        for i in range(len(texts)):
            a, b = words.texts[i], words.texts[i + 1]
            if a == b or paths is None:
                yield []
                continue
            path, base = paths[a:b], words.starts[a]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1])
            letters = np.add.reduceat(words.ends[a:b] - words.starts[a:b], cuts)
            stops = np.append(cuts[1:], b - a) - 1
            yield [
                (self.langs[path[c]], int(words.starts[a + c] - base), int(words.ends[a + e] - base), int(n))
                for c, e, n in zip(cuts, stops, letters)
            ]


def viterbi(scores: np.ndarray, begins: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word, for all texts at once: the longest texts first, one word of each per step."""
    lengths = np.diff(begins)
    order = np.argsort(-lengths, kind="stable")
    first, steps = begins[:-1][order], int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(steps), "left")  # texts longer than t
    total = np.zeros((len(order), scores.shape[1]))
    stays, bests = [], []
    for t in range(steps):
        n = active[t]
        best = total[:n].argmax(1)
        switched = total[np.arange(n), best][:, None] - penalty
        stay = total[:n] >= switched
        total[:n] = np.where(stay, total[:n], switched) + scores[first[:n] + t]
        stays.append(stay)
        bests.append(best)
    path = np.zeros(len(scores), np.int64)
    label = np.zeros(len(order), np.int64)
    for t in range(steps - 1, -1, -1):
        n, longer = active[t], active[t + 1] if t + 1 < steps else 0
        label[longer:n] = total[longer:n].argmax(1)  # texts that end here
        path[first[:n] + t] = label[:n]
        label[:n] = np.where(stays[t][np.arange(n), label[:n]], label[:n], bests[t])
    return path


def identify(docs: DataFrame, model: LanguageModel, with_spans: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score): the language with most letters in a text's spans, and its share of the letters.

    ``with_spans`` adds the spans: language, first place and end counted from the
    first word, letters. Texts that are null or have no letter are ``und`` with
    score 0; ties go to the first language by name; repeated rows stay.
    """
    span = "array<struct<lang:string,start:int,end:int,letters:int>>"
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("letters", pa.int32())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs, shares, spans = batch.column(1).to_pylist(), [], [], []
            for start, end in in_chunks(texts, CHUNK_CHARS):
                for found in model.label(texts[start:end]):
                    sums: dict[str, int] = {}
                    for lang, _, _, n in found:
                        sums[lang] = sums.get(lang, 0) + n
                    best = min(sums, key=lambda x: (-sums[x], x), default=UNDETERMINED)
                    langs.append(best)
                    shares.append(sums[best] / sum(sums.values()) if sums else 0.0)
                    spans.append([dict(zip(("lang", "start", "end", "letters"), x)) for x in found] if with_spans else None)
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(shares, pa.float64())]
            names = ["doc_id", "lang_pred", "score"]
            if with_spans:
                columns, names = [*columns, pa.array(spans, kind)], [*names, "spans"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, lang_pred string, score double" + (f", spans {span}" if with_spans else "")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(releasing(label), schema)


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows of ``docs``, all columns, whose text has a language; rows without an id and repeated rows as well."""
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, named = batch.column(place).to_pylist(), []
            for start, end in in_chunks(texts, CHUNK_CHARS):
                named += [bool(spans) for spans in model.label(texts[start:end])]
            yield batch.filter(pa.array(named, pa.bool_()))

    return docs.mapInArrow(releasing(keep), docs.schema)


def id_remainder(modulus: int) -> Column:
    """crc32 of doc_id written as text, modulo a number; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))
