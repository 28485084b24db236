"""Rules on words and lines, and lines that a host repeats over its documents.

Built-in column functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fundlens.llm.common import WORD_GAP, text_or_empty

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line is boilerplate in a host if more documents than both limits have it.
LINE_MIN_DOCS = 10
LINE_MAX_PERCENT = 5
# A document is depleted if less than this part of its words is left.
MIN_LEFT_PERCENT = 50


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def _metrics(docs: DataFrame) -> DataFrame:
    """Per row: words, symbols, repeated lines, and words in repeated three-word windows."""
    text = F.col("_text")
    gaps = " \t\n\x0b\x0c\r"
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, gaps, "") != "")
    base = docs.withColumns({"_words": words_of(text), "_lines": lines})
    n = F.size("_words")
    # Windows as (hash, position); sorted, so that equal windows are neighbours.
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    w = F.col("_words")
    windows = F.transform(starts, lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))
    base = base.withColumn("_windows", F.sort_array(windows))
    v = F.col("_windows")
    last = F.size(v) - 1

    def has_twin(x: Column, k: Column) -> Column:
        return ((k > 0) & (F.get(v, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(v, k + 1)["h"] == x["h"]))

    base = base.withColumn("_twins", F.sort_array(F.transform(F.filter(v, has_twin), lambda x: x["i"])))
    s = F.col("_twins")
    # A window covers three words, or as many as lie before the next window.
    covered = F.aggregate(
        F.transform(s, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return base.select(
        "doc_id",
        "source",
        "_text",
        "_row",
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, gaps, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def normal_line(line: Column) -> Column:
    """Lower case, digits as 0, white space as one blank."""
    blank = F.trim(F.regexp_replace(line, WORD_GAP, " "))
    return F.lower(F.regexp_replace(blank, "[0-9]", "0"))


def host_lines(docs: DataFrame, min_docs: int = LINE_MIN_DOCS, max_percent: float = LINE_MAX_PERCENT) -> tuple[DataFrame, DataFrame]:
    """All non-empty lines (_row, source, line, words), and (source, line) of those above the limits of their host.

    Documents of one host with equal texts count once: copies are no sign of
    boilerplate. Counting combines on the map side, so neither a hot host nor a hot
    line is gathered in one task.
    """
    texts = docs.select("_row", "source", F.xxhash64("_text").alias("_same"), F.explode(F.split("_text", "\n", -1)).alias("_line"))
    shown = texts.withColumn("_normal", normal_line(F.col("_line"))).where(F.col("_normal") != "")
    lines = shown.select(
        "_row", "source", "_same", F.xxhash64("_normal").alias("line"), F.size(F.split("_normal", " ")).alias("words")
    )
    counts = lines.groupBy("source", "line").agg(F.countDistinct("_same").alias("_docs"))
    hosts = docs.groupBy("source").agg(F.countDistinct(F.xxhash64("_text")).alias("_host_docs"))
    joined = counts.alias("c").join(hosts.alias("h"), F.col("c.source").eqNullSafe(F.col("h.source")))
    above = (F.col("_docs") > min_docs) & (F.col("_docs") * 100 > F.col("_host_docs") * max_percent)
    return lines.drop("_same"), joined.where(above).select("c.source", "c.line")


def quality_verdicts(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_repeat_percent: float = MAX_REPEAT_PERCENT,
    line_min_docs: int = LINE_MIN_DOCS,
    line_max_percent: float = LINE_MAX_PERCENT,
    min_left_percent: float = MIN_LEFT_PERCENT,
) -> DataFrame:
    """Per document: metrics, words in boilerplate lines (n_removed_words), base_failed and kept.

    A null text has no words and fails; documents without a source form one host;
    rows with equal doc_id and text get equal verdicts, one row each. No rows give no rows.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        text_or_empty().alias("_text"),
    ).withColumn("_row", F.xxhash64("doc_id", "source", "_text"))
    metrics = _metrics(own).drop("source", "_text")
    lines, boilerplate = host_lines(own, line_min_docs, line_max_percent)
    same = F.col("l.source").eqNullSafe(F.col("b.source")) & (F.col("l.line") == F.col("b.line"))
    cut = lines.alias("l").join(boilerplate.alias("b"), same, "left_semi")
    # Copies of one row share a key: their lines are counted once per copy, and divided again.
    copies = own.groupBy("_row").agg(F.count(F.lit(1)).alias("_copies"))
    removed = cut.groupBy("_row").agg(F.sum("words").alias("_removed"))
    removed = removed.join(copies, "_row").select("_row", F.expr("_removed div _copies").alias("n_removed_words"))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    left = F.col("n_words") - F.col("n_removed_words")
    out = metrics.join(removed, "_row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (left * 100 >= F.col("n_words") * min_left_percent)).drop("_row")
