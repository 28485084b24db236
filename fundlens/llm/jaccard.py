"""Exact links between documents whose sets of word shingles are similar, and their components.

Token-group matrix after Li et al., "LES3: Learning-based Exact Set Similarity
Search" (2021): similar sets form groups, the matrix holds which group has which
token in the union of its sets, and a set is compared with the members of a group
only if it shares enough tokens with that union.

1. A set that shares too few of its first tokens with other sets has no link
   (prefix filter in the order of the token hashes, so it needs no counts).
2. The distinct sets that are left form stars: each member links to the leader of its star.
3. Contraction: a set asks one or two sets of other components per token, drawn by a
   hash, as long as that finds links for many. A family of near copies is one
   component after a round or two, without any list of its pairs.
4. What is left between components: a set's tokens that are in other stars bound
   its overlap with each of them, and qualifying stars are opened.

Rows grow with the tokens: a set meets at most two sets per token in step 3, and in
step 4 only sets whose tokens lie in other components to ``percent`` are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fundlens.llm.common import in_chunks, mix, releasing, window_hashes, word_hashes
from fundlens.operators.linking import connected_components
from fundlens.session import Step, cut_lineage, shuffles_cleaned

# Bits of a token: below 2^63, so that it is the same number in every language.
KEY_BITS = 56
WIDTH = 5
PERCENT = 80
# What the prefix of a set is longer by, in percent of its size: the more, the fewer sets pass by a shared passage.
EXTRA_PERCENT = 10
# Contraction goes on while one in so many of the asking sets finds a link. It changes the work, never the result.
ASKING_PER_LINK = 20
# Sets that a set asks in one turn, and sets of a group whose union is stored; they change the work, never the result.
ASKED_PER_TURN = 4
GROUP_SETS = 32
# Bits per text of the filter in front of the exact join of texts, and most bits of it (8 MB, as of Spark's own
# filters): with more texts than that holds, more rows are shuffled for the join and none is lost.
FILTER_BITS_PER_TEXT = 16
MOST_FILTER_BITS = 2**26


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle."""
    for start, end in in_chunks(texts):
        hashes, begins = word_hashes(texts[start:end])
        windows = window_hashes(hashes, width) >> np.uint64(64 - KEY_BITS)
        for a, b in zip(begins[:-1], begins[1:]):
            if b - a >= width:
                yield np.unique(windows[a : b - width + 1])
            elif b > a:
                short = mix(np.append(window_hashes(hashes[a:b], b - a), np.uint64(b - a)))
                yield mix(short[:1] + short[1:]) >> np.uint64(64 - KEY_BITS)
            else:
                yield np.empty(0, np.uint64)


def _digest(tokens: np.ndarray) -> int:
    """64-bit identity of a set."""
    if not len(tokens):
        return 0
    sums = np.array([mix(tokens + np.uint64(1)).sum(dtype=np.uint64), mix(tokens + np.uint64(2)).sum(dtype=np.uint64)])
    return int(mix(sums[:1] ^ mix(sums[1:]) + np.uint64(len(tokens)))[0].astype(np.int64))


def _lists(values: np.ndarray, owners: np.ndarray, held: np.ndarray) -> pa.ListArray:
    """Arrow lists of the values of each owner, ascending; null where ``held`` is false."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(held)))])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values), mask=pa.array(~held))


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def document_heads(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, digest, text_hash, least, found, fresh, known) of every row.

    The last four are of the first of equal sets that are read together. ``fresh``
    and ``known`` are 32 bits of tokens of its prefix: those that no other set of the
    batch has, and those that the batch knows as shared and tells others of, of
    two sets each. ``found`` counts the prefix tokens that are shared within the batch.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, held, heads, seen = [], [], [], [], {0}
            for tokens in shingle_sets(batch.column(1).to_pylist(), width):
                sizes.append(len(tokens))
                digests.append(_digest(tokens))
                held.append(digests[-1] not in seen)
                seen.add(digests[-1])
                # Not the high bits: those of the first tokens are nearly alike.
                heads.append(tokens[: prefix_needs(len(tokens), percent)[0]].astype("<u4") if held[-1] else np.empty(0, "<u4"))
            keys = np.concatenate(heads or [np.empty(0, "<u4")])
            owners = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
            order = np.argsort(keys, kind="stable")
            same = keys[order][1:] == keys[order][:-1]
            before, after = np.concatenate([[False], same])[: len(keys)], np.concatenate([same, [False]])[: len(keys)]
            shared, told = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
            shared[order] = before | after
            # The first and the second of a run: two sets are enough to tell that a token is shared.
            told[order] = after & ~before | before & ~np.concatenate([[False], before])[: len(keys)]
            held = np.array(held, bool)
            found = np.bincount(owners[shared], minlength=len(held))
            least = [prefix_needs(n, percent)[1] for n in sizes]
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.int64()), batch.column(2)]
            columns += [pa.array(x, pa.int32(), mask=~held) for x in (np.array(least, np.int32), found.astype(np.int32))]
            columns += [_lists(keys[pick].view("<i4"), owners[pick], held) for pick in (~shared, told)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "digest", "text_hash", "least", "found", "fresh", "known"])

    schema = "doc_id long, n_shingles long, digest long, text_hash long, least int, found int, fresh array<int>, known array<int>"
    return _narrow(docs).mapInArrow(releasing(hashed), schema)


def document_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(digest, n, tokens) of the distinct sets of the given rows; no row for texts without words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {_digest(s): s for s in shingle_sets(batch.column(1).to_pylist(), width) if len(s)}
            sizes = [len(s) for s in sets.values()]
            flat = np.concatenate([*sets.values(), np.empty(0, np.uint64)]).astype(np.int64)
            tokens = _lists(flat, np.repeat(np.arange(len(sets)), sizes), np.ones(len(sets), bool))
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), tokens], names=["digest", "n", "tokens"])

    sets = _narrow(docs).mapInArrow(releasing(hashed), "digest long, n long, tokens array<long>")
    return sets.groupBy("digest").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


def least_overlap(n: Column, percent: int) -> Column:
    """Tokens that a set of ``n`` has to share with any set it links to."""
    return F.ceil(n * percent / 100)


def prefix_needs(n: int, percent: int) -> tuple[int, int]:
    """(length, least): of its first ``length`` tokens a set with a link shares ``least`` with the first ones of the other set.

    If two sets share o tokens, the first n - o + k tokens of one and m - o + k of the
    other share at least k. Here k is a part of the size; the smallest set that a set
    can link to has the least k.
    """
    least = -(-n * percent // 100)
    extra = lambda size: max(1, size * EXTRA_PERCENT // 100)
    return min(n, n - least + extra(n)), extra(least)


def _last_read(made: Step, *read: Step) -> Step:
    """``made``, and the steps that were read for the last time to write it go: tokens are most of what the disk holds."""
    for step in read:
        step.remove()
    return made


def _able_texts(rows: DataFrame) -> Step:
    """(text_hash) of one text of each set that the prefix filter leaves; other texts may share the hash.

    Hot tokens stay small: a batch sends each token at most twice.
    """
    fresh = rows.select(F.explode("fresh").alias("token"), "digest", F.lit(1).alias("counts"))
    known = rows.select(F.explode("known").alias("token"), "digest", F.lit(0).alias("counts"))
    token = Window.partitionBy("token")
    spread = fresh.unionByName(known).withColumns({"_a": F.min("digest").over(token), "_b": F.max("digest").over(token)})
    found = spread.where("counts = 1 and _a != _b").select("digest", F.lit(None).cast("int").alias("least"), F.col("counts").alias("found"))
    found = found.unionByName(rows.where("least is not null").select("digest", "least", "found"))
    sums = found.groupBy("digest").agg(F.max("least").alias("least"), F.sum("found").alias("found"))
    able = Step(sums.where("found >= least").select("digest"), "shared")
    texts = rows.join(able.frame, "digest", "left_semi").groupBy("digest").agg(F.min("text_hash").alias("text_hash")).select("text_hash").distinct()
    return _last_read(Step(texts, "texts", texts=F.count(F.lit(1))), able)


def _texts_of(docs: DataFrame, texts: Step) -> DataFrame:
    """(doc_id, text) of the rows whose text has one of the hashes.

    The list of hashes grows with the table, so it is joined by a shuffle. A bitmap of
    bounded size goes to the rows before that, and keeps most other texts out of it.
    """
    bits = min(MOST_FILTER_BITS, 2 ** (FILTER_BITS_PER_TEXT * texts.seen["texts"]).bit_length())
    place = lambda value: F.pmod(value, F.lit(bits)) + 1
    held = texts.frame.select(place(F.col("text_hash")).alias("_place"))
    held = held.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    rows = _narrow(docs).where(F.col("text").isNotNull()).withColumn("_place", place(F.col("text_hash")))
    near = rows.join(F.broadcast(held), F.bitmap_bucket_number("_place") == F.col("_bucket"))
    bit = F.bitmap_bit_position("_place").cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    near = near.where(F.getbit(byte, bit % 8) == 1).select("doc_id", "text", "text_hash")
    # Hashes are distinct. Not a semi join, which Spark would move in front of the bitmap.
    return near.join(texts.frame, "text_hash").select("doc_id", "text")


def _linked(tokens: str, n: str, other: str, other_n: str, percent: int) -> Column:
    shared = F.size(F.array_intersect(tokens, other))
    return shared * 100 >= (F.col(n) + F.col(other_n) - shared) * percent


def _stars(sets: DataFrame, key: Column, percent: int) -> DataFrame:
    """(node, leader) of the sets that link to the least set with the same key."""
    keyed = sets.select("node", "n", "tokens", key.alias("_key"))
    leaders = keyed.groupBy("_key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    heads = sets.select(F.col("node").alias("leader"), F.col("n").alias("_ln"), F.col("tokens").alias("_lt"))
    led = leaders.select(F.col("_key").alias("_led"), "leader").join(heads, "leader")
    pairs = keyed.join(led, F.col("_key") == F.col("_led"))
    return pairs.where(_linked("tokens", "n", "_lt", "_ln", percent)).select("node", "leader")


def similar_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    ``component_id`` is the least doc_id reachable by links between sets whose
    Jaccard similarity is at least ``percent``. A null or empty text has no shingle
    and stands alone; equal sets are one node; a component without any id has none;
    rows that share an id and differ are rows of their own. An empty table gives no
    row. A very long text needs some 60 bytes of its task per byte.
    """
    with shuffles_cleaned(docs.sparkSession):
        return _similar_components(docs, width, percent)


def _similar_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    heads = Step(document_heads(docs, width, percent), "heads")
    rows = cut_lineage(heads.frame.select("doc_id", "n_shingles", "digest"), "rows")
    # Whole sets only of texts that may have a link.
    texts = _last_read(_able_texts(heads.frame), heads)
    nodes = _last_read(Step(document_sets(_texts_of(docs, texts), width).withColumnRenamed("digest", "node"), "nodes"), texts)
    sets = _last_read(_shared_tokens(nodes.frame, percent), nodes)

    first = Step(_stars(sets.frame, F.array_min("tokens"), percent), "stars")
    rest = sets.frame.join(first.frame, "node", "left_anti")
    second = _stars(rest, F.array_max("tokens"), percent)
    members = sets.frame.join(first.frame.unionByName(second), "node", "left").select("node", "n", "tokens", F.coalesce("leader", "node").alias("star"))
    members = _last_read(Step(members, "members"), sets, first)
    edges = members.frame.where("node != star").select(F.col("node").alias("src"), F.col("star").alias("dst"))
    edges = cut_lineage(edges, "edges")

    # Components of stars: at first each star alone.
    read, placed, links, go_on, turn = [members], members.frame.withColumn("component", F.col("star")), None, True, 0
    while go_on:
        across = _last_read(_across(placed, percent, turn), *read)
        asked = _drawn_sets(across.frame, percent)
        if links is not None:
            asked = asked.join(links.select("node", "other"), ["node", "other"], "left_anti")
        answers = Step(_verified(asked, across.frame, percent), "answers", links=F.count(F.when(F.col("linked"), 1)))
        links = answers.frame if links is None else links.unionByName(answers.frame)
        go_on, turn = answers.seen["links"] * ASKING_PER_LINK > across.seen["sets"], turn + 1
        # Components only grow, so what lies within one now will not lie across again.
        read, placed = [across], across.frame.select("node", "n", "tokens", "star", "component")
        if answers.seen["links"]:
            label = _star_components(links.where("linked"))
            placed = placed.drop("component").join(label, "star", "left").withColumn("component", F.coalesce("component", "star"))
            read = [_last_read(Step(placed, "placed"), across)]
            placed = read[0].frame
    edges = edges.unionByName(links.where("linked").select(F.col("node").alias("src"), F.col("other").alias("dst")))
    left = _last_read(_across(placed, percent, turn), *read)
    if left.seen["sets"]:
        edges = edges.unionByName(_opened(left.frame, percent))
    return _labels(rows, edges)


def _shared_tokens(sets: DataFrame, percent: int) -> Step:
    """Sets of which ``percent`` of the tokens are in another set too, with those tokens alone."""
    flat = sets.select("node", F.explode("tokens").alias("token"))
    # Written, so that the join meets two plain shuffles and a hot token is split.
    shared = Step(flat.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("token"), "spread")
    held = flat.join(shared.frame, "token").groupBy("node").agg(F.collect_list("token").alias("tokens"))
    kept = held.join(sets.select("node", "n"), "node").where(F.size("tokens") >= least_overlap(F.col("n"), percent))
    return _last_read(Step(kept.select("node", "n", "tokens"), "able"), shared)


def _across(sets: DataFrame, percent: int, turn: int) -> Step:
    """Sets of which ``percent`` of the tokens lie in other components too, with those tokens, rarest first.

    ``others`` holds for each of them up to two sets with that token that are not of the
    own component: the one with the least share of tokens of its own, which is near to
    most of a family of copies, and one drawn by a hash of set, token and turn.
    """
    missed = F.floor((F.col("n") - F.size("tokens")) * 1000 / F.col("n"))
    flat = sets.select("node", "component", missed.alias("missed"), F.explode("tokens").alias("token"))
    typical, drawn = F.col("missed") * 2**40 + F.pmod(F.col("node"), F.lit(2**40)), F.xxhash64("node", "token", F.lit(turn))
    spread = flat.groupBy("token").agg(
        F.count(F.lit(1)).alias("sets"), F.min("component").alias("_a"), F.max("component").alias("_b"),
        F.min_by("node", typical).alias("low"), F.min_by("component", typical).alias("low_component"),
        F.max_by("node", drawn).alias("high"), F.max_by("component", drawn).alias("high_component"),
    )
    # Written, so that the join meets two plain shuffles and a hot token is split.
    spread = Step(spread.where("_a != _b").drop("_a", "_b"), "spread")
    others = [F.when(F.col(f"{x}_component") != F.col("component"), F.col(x)).alias(x) for x in ("low", "high")]
    found = flat.select("node", "component", "token").join(spread.frame, "token").select("node", F.struct("sets", "token", *others).alias("held"))
    ranked = found.groupBy("node").agg(F.sort_array(F.collect_list("held")).alias("held"))
    kept = ranked.join(sets.drop("tokens"), "node").where(F.size("held") >= least_overlap(F.col("n"), percent))
    part = lambda name: F.transform("held", lambda h: h[name])
    others = F.flatten(F.array(*[F.slice(part(x), F.lit(1), _probes(F.size("held"), percent)) for x in ("low", "high")]))
    across = kept.withColumns({"tokens": part("token"), "others": F.filter(others, lambda x: x.isNotNull())}).drop("held")
    return _last_read(Step(across, "across", sets=F.count(F.lit(1))), spread)


def _probes(held: Column, percent: int) -> Column:
    """How many of the tokens that :func:`_across` lists hold one of any set that a set links to.

    A set misses at most n minus the least overlap of its tokens; those in no other
    component are missed for certain.
    """
    return (held - least_overlap(F.col("n"), percent) + 1).cast("int")


def _drawn_sets(across: DataFrame, percent: int) -> DataFrame:
    """(node, star, other): the sets that a set asks in a turn, those drawn for most of its probing tokens first."""
    often = lambda x: F.struct((-F.size(F.filter("others", lambda y: y == x))).alias("times"), x.alias("other"))
    ranked = F.array_sort(F.transform(F.array_distinct("others"), often))
    return across.select("node", "star", F.explode(F.slice(ranked, 1, ASKED_PER_TURN)).alias("_o")).select("node", "star", "_o.other")


def _verified(asked: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(node, star, other, other_star, linked): whether a set links to the one it asks."""
    others = members.select(F.col("node").alias("other"), F.col("star").alias("other_star"), F.col("n").alias("_on"), F.col("tokens").alias("_ot"))
    both = asked.join(members.select("node", "n", "tokens"), "node").join(others, "other")
    near = F.least("n", "_on") * 100 >= F.greatest("n", "_on") * percent
    return both.select("node", "star", "other", "other_star", (near & _linked("tokens", "n", "_ot", "_on", percent)).alias("linked"))


def _star_components(links: DataFrame) -> DataFrame:
    """(star, component) of the stars that links between their sets connect."""
    between = links.select(F.col("star").alias("src"), F.col("other_star").alias("dst")).where("src != dst").distinct()
    nodes = between.select(F.col("src").alias("row_id")).unionByName(between.select(F.col("dst").alias("row_id"))).distinct()
    return cut_lineage(connected_components(between, nodes).withColumnRenamed("row_id", "star"), "labels")


def _opened(across: DataFrame, percent: int) -> DataFrame:
    """Links between sets of different components which contraction has not found.

    Both ends of such a link are in ``across``; the end in the smaller component asks.
    Groups are sets of one component that have a like share of tokens in others, cut
    by a hash, so that a union and what is opened is bounded.
    """
    missed = F.floor((F.col("n") - F.size("tokens")) * 100 / F.col("n"))
    sets = across.drop("others").withColumn("missed", missed)
    weights = sets.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    cuts = sets.groupBy("component", "missed").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).alias("_cuts"))
    sets = sets.join(weights, "component").join(cuts, ["component", "missed"])
    sets = sets.withColumn("group", F.xxhash64("component", "missed", F.pmod(F.xxhash64("node"), F.col("_cuts")))).drop("_cuts", "missed")
    sets = cut_lineage(sets, "asking")
    rank, c = F.struct("weight", "component"), F.size("tokens")
    probes = sets.select("node", "n", c.alias("c"), rank.alias("rank"), F.explode(F.slice("tokens", F.lit(1), _probes(c, percent))).alias("token"))
    # The matrix: which group has a token in the union of its sets, and what bounds its sets.
    bounds = [F.min("n").alias("_least"), F.max("n").alias("_most"), F.max(c).alias("_c"), F.min(rank).alias("_rank")]
    unions = sets.groupBy("group").agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"), *bounds)
    unions = cut_lineage(unions, "unions")
    matrix = unions.select("group", "_least", "_most", "_c", "_rank", F.explode("union").alias("token"))
    # A set shares at most c tokens with any other component, and an overlap of o makes (n + m) * P / (100 + P) <= o.
    able = F.least("c", "_c") * (100 + percent) >= (F.col("n") + F.col("_least")) * percent
    able &= (F.col("n") * 100 >= F.col("_least") * percent) & (F.col("_most") * 100 >= F.col("n") * percent)
    candidates = probes.join(matrix, (probes["token"] == matrix["token"]) & (F.col("rank") < F.col("_rank")) & able)
    candidates = cut_lineage(candidates.select("node", "group").distinct(), "candidates")
    # Bound the overlap by the union, then open the group.
    bounded = candidates.join(sets.select("node", "n", "tokens"), "node").join(unions.select("group", "union"), "group")
    qualified = bounded.where(F.size(F.array_intersect("tokens", "union")) >= least_overlap(F.col("n"), percent)).drop("union")
    inside = sets.select(F.col("group").alias("_group"), F.col("node").alias("dst"), F.col("n").alias("_mn"), F.col("tokens").alias("_mt"))
    near = (F.least("n", "_mn") * 100 >= F.greatest("n", "_mn") * percent) & (
        F.least(F.size("tokens"), F.size("_mt")) * (100 + percent) >= (F.col("n") + F.col("_mn")) * percent
    )
    opened = qualified.join(inside, (F.col("group") == F.col("_group")) & near)
    return opened.where(_linked("tokens", "n", "_mt", "_mn", percent)).select(F.col("node").alias("src"), "dst")


def _labels(docs_sets: DataFrame, links: DataFrame) -> DataFrame:
    """Least doc_id of each component; a row without tokens shares its set with equal sets alone."""
    links = cut_lineage(links, "links")
    nodes = links.select(F.col("src").alias("row_id")).unionByName(links.select(F.col("dst").alias("row_id"))).distinct()
    label = cut_lineage(connected_components(links, nodes), "components")
    sets = docs_sets.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("_least"))
    named = sets.join(label.withColumnRenamed("row_id", "digest"), "digest", "left")
    named = named.select("digest", "_least", F.coalesce("component", "digest").alias("_component"))
    least = named.groupBy("_component").agg(F.min("_least").alias("component_id"))
    named = named.join(least, "_component").select("digest", "component_id")
    filled = docs_sets.where("n_shingles > 0").select("doc_id", "n_shingles", "digest").join(named, "digest")
    empty = docs_sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.select("doc_id", "n_shingles", "component_id").unionByName(empty)
