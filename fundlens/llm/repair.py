"""Cheapest repair of conversation structure by iterative-deepening A*.

Rows are kept, given another role, deleted or preceded by inserted ones, so that the
roles read: perhaps a system row, then user and assistant in turns, or nothing at
all. The search is depth first, in the order of the edits' letters, under a growing
cost bound; a table remembers for each state the cost that it is known to need at
least. The first accepting path is the cheapest one, and of equal ones the least by
its letters.

A conversation is cut into segments of bounded length. Each is searched alone from
every state to every state, and the cheapest chain of segments is the repair of the
whole, so that no search and no group of rows grows with a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fundlens.llm.common import only
from fundlens.operators.groups import with_group_totals
from fundlens.operators.numbering import number_rows
from fundlens.session import cut_lineage

# Edits in ASCII order, and their costs.
DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3
# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ACCEPTING = (START, ASSISTANT)
# The role that an inserted or changed row takes in each state.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
_NEXT_BY_INITIAL = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# Rows of a segment, and searches that a worker remembers.
SEGMENT_ROWS, REMEMBERED = 128, 8_192
# Rows that one task searches.
ROWS_PER_TASK = 100_000

# White space as the word rule has it; anything else makes a text not blank.
_SPACE, _NOT_SPACE = r"\x20\x09-\x0D", r"[^\x20\x09-\x0D]"


def edits_of(shape: str, place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, next place, next state) in ASCII order of the edits.

    A shape has a letter per row: s, u, a or x (any other role), a capital for a
    truncated text, ``-`` for a row that has to be deleted.
    """
    row = shape[place] if place < len(shape) else None
    if row is not None:
        yield DELETE, COST[DELETE], place + 1, state
    yield INSERT, COST[INSERT], place, FOLLOWING[state]
    if row is not None and row != "-":
        more = TRUNCATED_COST if row.isupper() else 0
        kept = _NEXT_BY_INITIAL.get(row.lower(), {}).get(state)
        if kept is not None:
            yield KEEP, COST[KEEP] + more, place + 1, kept
        yield REROLE, COST[REROLE] + more, place + 1, FOLLOWING[state]


def _least_costs(shape: str) -> list[int]:
    """What the rows from each place on cost at least, whatever their order."""
    out = [0]
    for row in reversed(shape):
        out.append(out[-1] + (COST[DELETE] if row == "-" else min(TRUNCATED_COST, COST[DELETE]) if row.isupper() else 0))
    return out[::-1]


@lru_cache(REMEMBERED)
def search(shape: str, state: int, goals: tuple[int, ...]) -> tuple[int, str, int] | None:
    """(cost, audit, last state) of the cheapest, then ASCII-least path from ``state`` to one of ``goals``.

    None if no path leads there: the start can only be left, and a system row only
    follows the start.
    """
    rows = len(shape)
    reachable = {state} | ({SYSTEM, USER, ASSISTANT} if state == START else {USER, ASSISTANT})
    goals = tuple(g for g in goals if g in reachable)
    if not goals:
        return None
    # No edit leads back to the start or to a system row: one way at most stays there, without a search.
    if goals == (state,) and state in (START, SYSTEM):
        return COST[DELETE] * rows, DELETE * rows, state
    if goals == (SYSTEM,):
        ways = [(TRUNCATED_COST * (r == "S"), DELETE * i + KEEP + DELETE * (rows - 1 - i)) for i, r in enumerate(shape) if r in "sS"]
        cost, audit = min(ways, default=(0, None))
        return audit and (COST[DELETE] * (rows - 1) + cost, audit, SYSTEM)
    ahead, needs = _least_costs(shape), {}
    bound = ahead[0]
    while True:
        # One entry per state on the path: its edits left, what is left of the bound, its least need so far, the edit to it.
        path = [[edits_of(shape, 0, state), bound, 1 << 60, "", 0, state]]
        if not shape and state in goals:
            return 0, "", state
        while path:
            edits, left, least, _, place, at = path[-1]
            for edit, cost, place_to, state_to in edits:
                need = needs.get((place_to, state_to), ahead[place_to])
                if cost + need <= left:
                    if place_to == len(shape) and state_to in goals:
                        audit = "".join(p[3] for p in path) + edit
                        return bound - left + cost, audit, state_to
                    path[-1][2] = least
                    path.append([edits_of(shape, place_to, state_to), left - cost, 1 << 60, edit, place_to, state_to])
                    break
                least = min(least, cost + need)
            else:
                # No way on within the bound: the state is known to need more than what was left.
                needs[place, at] = least
                path.pop()
                if path:
                    # The edit that led here, with what its state is now known to need.
                    cost = path[-1][1] - left
                    path[-1][2] = min(path[-1][2], cost + least)
                else:
                    bound = least


def segment_paths(shape: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a segment: from the start if first, to acceptance if last."""
    out = []
    for before in (START,) if first else STATES:
        for goals in (ACCEPTING,) if last else tuple((g,) for g in STATES):
            if found := search(shape, before, goals):
                out.append((before, found[2], found[0], found[1]))
    return out


def chain_paths(segments: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cheapest, then ASCII-least chain: its cost, and (state before, audit) of each segment.

    Audits of one segment with equal cost and states are never the beginning of one
    another (the longer one would insert more), so the least parts make the least whole.
    """
    best: dict[int, tuple] = {START: (0, "", None)}
    for paths in segments:
        new: dict[int, tuple] = {}
        for before, after, cost, audit in paths:
            if before in best:
                total, so_far, _ = best[before]
                way = (total + cost, so_far + audit, (best[before], before, audit))
                if after not in new or way[:2] < new[after][:2]:
                    new[after] = way
        best = new
    way = min((best[s] for s in ACCEPTING if s in best), key=lambda w: w[:2])
    cost, parts = way[0], []
    while way[2] is not None:
        way, before, audit = way[2]
        parts.append((before, audit))
    return cost, parts[::-1]


def apply_edits(rows: list[tuple[str, str]], state: int, audit: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows of one segment that is entered in ``state``."""
    left = iter(rows)
    for edit in audit:
        role, text = next(left) if edit != INSERT else (None, "")
        if edit == DELETE:
            continue
        state = _NEXT_BY_INITIAL[role[:1]][state] if edit == KEEP else FOLLOWING[state]
        yield (role if edit == KEEP else ROLE_OF[state]), text


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after a fixed damage of some rows; a null role or text becomes one space.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2
    removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it a user's.
    """
    key = F.concat(_text("conv_id"), F.lit(":"), _text("turn"))
    fate = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), fate.alias("_fate"))
    text = F.when(F.col("_fate") == 1, F.lit("")).when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", ""))
    times = F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("_fate != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("_copy"),
    ).drop("_copy")


_PATHS = "array<struct<before:int,after:int,cost:long,audit:string>>"
_PATH_TYPE = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number that follows the conversation, then the turn, nulls first; its files are written."""
    # Nulls first: a flag before the turn, since numbers are given with nulls last.
    keyed = rows.select("conv_id", F.col("turn").isNotNull().cast("int").alias("_has"), "turn", "role", "text")
    return number_rows(keyed, ["conv_id", "_has", "turn", "role", "text"], "_no")


def _faults(numbered: DataFrame) -> DataFrame:
    """Narrow rows: place, turn, initial of the role, fault (first of blank, duplicate, truncated, or none)."""
    digest = F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)).alias("_digest")
    last = F.regexp_extract("text", f"({_NOT_SPACE})[{_SPACE}]*\\z", 1)
    seen = numbered.select(
        "conv_id", "_no", "turn", F.substring("role", 1, 1).alias("_initial"), digest,
        (~F.col("text").rlike(_NOT_SPACE)).alias("_blank"), last.isin(".", "!", "?").alias("_ended"),
    )
    seen = cut_lineage(seen, "narrow")
    seen = with_group_totals(seen, ["conv_id", "_digest"], {"_seen_no": F.min("_no")}).drop("_digest")
    seen = with_group_totals(seen, ["conv_id"], {"_first_no": F.min("_no"), "_rows": F.count(F.lit(1))})
    fault = F.when(F.col("_blank"), "blank").when(F.col("_no") > F.col("_seen_no"), "duplicate").when(~F.col("_ended"), "truncated")
    return seen.select("conv_id", "_no", (F.col("_no") - F.col("_first_no")).alias("_place"), "_rows", "turn", "_initial", fault.alias("_fault"))


def repair_conversations(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per conv_id: gaps, faults, illegal neighbours, cost, audit and repaired text of its rows.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired ``role:text`` lines). Rows are taken by turn,
    nulls first; rows of one turn by role and text. A null conv_id is a
    conversation of its own, a null role or text is one space, an empty role fits no
    place. An empty table gives no row. Long texts are only hashed,
    long conversations are searched in segments; the audit and the hash are single
    values, so a conversation's audits meet in one group and its repaired lines pass
    through one task in order, a batch at a time.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text"))
    numbered = _numbered(rows)
    faults = cut_lineage(_faults(numbered).withColumn("_segment", F.floor(F.col("_place") / segment_rows)), "faults")
    chosen = cut_lineage(_chosen_edits(faults, segment_rows), "edits")
    repaired = _repaired_hash(numbered, chosen)
    audits = chosen.groupBy("conv_id").agg(
        F.first("cost").alias("cost"),
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("_no", "audit"))), lambda x: x["audit"])).alias("audit"),
    )
    counts = _counts(faults)
    joined = counts.join(audits, counts["conv_id"].eqNullSafe(audits["conv_id"])).join(repaired, counts["conv_id"].eqNullSafe(repaired["_conv_id"]))
    return joined.select(counts["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _counts(faults: DataFrame) -> DataFrame:
    """Gaps, faults and illegal neighbours of each conversation, by sums that combine before the shuffle."""
    number = lambda name: F.count(F.when(F.col("_fault") == name, 1)).alias(name)
    turns = F.max("turn") - F.min("turn") + 1
    # Distinct turns as a count per (conversation, turn), so that no set of turns is gathered.
    firsts = faults.groupBy("conv_id", "turn").agg(*[number(n) for n in ("blank", "duplicate", "truncated")])
    sums = [F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")]
    gaps = F.coalesce(turns - F.count("turn"), F.lit(0)).alias("gaps")
    counted = firsts.groupBy("conv_id").agg(gaps, *sums)
    # Neighbours have neighbouring numbers: each row meets the one before it.
    own = faults.where("_place > 0").select(F.col("_no").alias("_at"), F.col("_initial").alias("_own"), F.col("conv_id").alias("_pair_conv"))
    before = faults.select((F.col("_no") + 1).alias("_at"), F.col("_initial").alias("_before"))
    pairs = own.join(before, "_at")
    illegal = pairs.groupBy("_pair_conv").agg(F.count(F.when(~F.concat("_before", "_own").isin("su", "ua", "au"), 1)).alias("_illegal"))
    found = counted.join(illegal, counted["conv_id"].eqNullSafe(illegal["_pair_conv"]), "left")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", F.coalesce("_illegal", F.lit(0)).alias("illegal"))


def _chosen_edits(faults: DataFrame, segment_rows: int) -> DataFrame:
    """(conv_id, _no, _before, audit, cost): the edits of each segment from its first number, the cost of its conversation."""
    initial = F.when(F.col("_initial").isin("s", "u", "a"), F.col("_initial")).otherwise(F.lit("x"))
    letter = F.when(F.col("_fault").isin("blank", "duplicate"), F.lit("-")).when(F.col("_fault") == "truncated", F.upper(initial)).otherwise(initial)
    lettered = F.array_sort(F.collect_list(F.struct("_place", letter.alias("letter"))))  # at most segment_rows
    shapes = faults.groupBy("conv_id", "_segment").agg(
        F.concat_ws("", F.transform(lettered, lambda x: x["letter"])).alias("shape"), F.max("_rows").alias("_rows"), F.min("_no").alias("_no")
    )
    # One row per segment: its place, whether it is the last and the only one.
    final = (F.col("_segment") == F.floor((F.col("_rows") - 1) / segment_rows)).alias("_last")
    alone = (F.col("_rows") <= segment_rows).alias("_alone")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            paths = [segment_paths(shape, segment == 0, last) for segment, shape, last in zip(*columns[4:], columns[3])]
            found = [[dict(zip(("before", "after", "cost", "audit"), p)) for p in some] for some in paths]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, _PATH_TYPE)], names=["conv_id", "_no", "_alone", "paths"])

    asked = shapes.select("conv_id", "_no", alone, final, "_segment", "shape")
    # Narrow rows, costly searches: tasks by the number of rows, not by their bytes.
    tasks = max(3 * faults.sparkSession.sparkContext.defaultParallelism, -(-faults.count() // ROWS_PER_TASK))
    asked = asked.repartition(tasks, "conv_id", "_no")
    solved = cut_lineage(asked.mapInArrow(solve, f"conv_id long, _no long, _alone boolean, paths {_PATHS}"), "paths")

    def chain(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["_no"])
        cost, parts = chain_paths([[tuple(p.values()) for p in r["paths"]] for r in rows])
        return pa.table(
            {
                "conv_id": pa.array([r["conv_id"] for r in rows], pa.int64()),
                "_no": pa.array([r["_no"] for r in rows], pa.int64()),
                "_before": pa.array([b for b, _ in parts], pa.int32()),
                "audit": pa.array([a for _, a in parts], pa.string()),
                "cost": pa.array([cost] * len(rows), pa.int64()),
            }
        )

    way = F.element_at("paths", 1)
    short = solved.where("_alone").select("conv_id", "_no", way["before"].alias("_before"), way["audit"].alias("audit"), way["cost"].alias("cost"))
    chained = solved.where("not _alone").groupBy("conv_id").applyInArrow(chain, "conv_id long, _no long, _before int, audit string, cost long")
    return short.unionByName(chained)


def _repaired_hash(numbered: DataFrame, chosen: DataFrame) -> DataFrame:
    """(_conv_id, repaired_sha256): a conversation's rows in order through one task, batch by batch."""
    rows = numbered.select("conv_id", "_no", "role", "text", F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("_before"))
    # The edits of a segment stand before its first row.
    heads = chosen.select("conv_id", "_no", F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("_kind"), "_before")
    ordered = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "_no", "_kind")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, hashed, empty, head, held = None, None, True, None, []

        def flush() -> None:
            nonlocal empty
            for role, text in apply_edits(held, *head) if head else ():
                hashed.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text", "_kind", "_before")]
            for conv, role, text, kind, before in zip(*columns):
                if kind == 0:
                    if hashed is not None:
                        flush()
                    if hashed is None or conv != current:
                        if hashed is not None:
                            done.append((current, hashed.hexdigest()))
                        current, hashed, empty = conv, hashlib.sha256(), True
                    head, held = (before, text), []
                else:
                    held.append((role, text))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([h for _, h in done])], names=["_conv_id", "repaired_sha256"])
                done = []
        if hashed is not None:
            flush()
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([hashed.hexdigest()])], names=["_conv_id", "repaired_sha256"])

    return ordered.select("conv_id", "role", "text", "_kind", "_before").mapInArrow(digest, "_conv_id long, repaired_sha256 string")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """:func:`repair_conversations` of :func:`damaged` rows, with a row for every conv_id that there was.

    A conversation without rows after the damage has zeros, no audit and the hash of nothing.
    """
    ids = only(conversations, "conv_id").select(F.col("conv_id").cast("long").alias("_id")).distinct()
    found = repair_conversations(damaged(only(conversations, "conv_id", "turn", "role", "text")))
    whole = ids.join(found, ids["_id"].eqNullSafe(found["conv_id"]), "left")
    zeros = [F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    return whole.select(F.col("_id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
