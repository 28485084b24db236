"""Joins of the jobs.

Only the fixed chain lists carry a broadcast hint. All other sides can grow, so
Spark chooses by measured size and AQE splits hot keys of the shuffled ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fundlens.functions.text import json_fields, json_text
from fundlens.sources.schemas import MATCHING_DOCUMENT

# Levels of aligned blocks: 2^22 days are more than all years that a timestamp can hold.
LEVELS = 23
DAY_SECONDS = 86_400


def _left(df: DataFrame, lookup: DataFrame, pairs: list[tuple[Column, str]], add: dict[str, str]) -> DataFrame:
    """Left join on ``expression of df = column of lookup``, adding ``{output: lookup column}``."""
    side = lookup.select(
        *[F.col(name).alias(f"_on{i}") for i, (_, name) in enumerate(pairs)],
        *[F.col(src).alias(f"_add_{out}") for out, src in add.items()],
    )
    on = reduce(lambda a, b: a & b, [c == side[f"_on{i}"] for i, (c, _) in enumerate(pairs)])
    kept = [df[c] for c in df.columns if c not in add]
    return df.join(side, on, "left").select(*kept, *[side[f"_add_{out}"].alias(out) for out in add])


def join_applications(donations: DataFrame, grants: DataFrame) -> DataFrame:
    """Donations with the grant they went to; donations without one go."""
    return donations.join(grants, ["application_id", "round_id", "chain_id"], "inner")


def attach_registry(applications: DataFrame, registry: DataFrame) -> DataFrame:
    """Round number by chain and round id, both ids compared in lower case."""
    side = registry.select("chain_id", F.lower("round_id").alias("_rid"), "round_number")
    pairs = [(F.lower(applications["round_id"]), "_rid"), (applications["chain_id"], "chain_id")]
    return _left(applications, side, pairs, {"round_num": "round_number"})


def attach_round_name(applications: DataFrame, rounds: DataFrame) -> DataFrame:
    """Round name; only the application's round id is lower-cased, the round's is not."""
    side = rounds.select("id", "chain_id", json_text(F.col("round_metadata"), "name").alias("_name"))
    pairs = [(F.lower(applications["round_id"]), "id"), (applications["chain_id"], "chain_id")]
    return _left(applications, side, pairs, {"round_name": "_name"})


def attach_round_labels(applications: DataFrame, registry: DataFrame, rounds: DataFrame) -> DataFrame:
    """:func:`attach_registry` and :func:`attach_round_name` in one join of the applications.

    The two small sides meet first, by a full join on the same key. Two joins of
    the applications on one key would share a shuffle, and a shared shuffle keeps
    Spark from splitting a round that has very many applications.
    """
    numbers = registry.select("chain_id", F.lower("round_id").alias("_rid"), F.col("round_number").alias("_number"))
    named = rounds.select(
        F.col("chain_id").alias("_chain"), F.col("id").alias("_id"),
        json_text(F.col("round_metadata"), "name").alias("_name"),
    )
    on = (numbers["_rid"] == named["_id"]) & (numbers["chain_id"] == named["_chain"])
    labels = numbers.join(named, on, "full").select(
        F.coalesce("chain_id", "_chain").alias("chain_id"), F.coalesce("_rid", "_id").alias("_rid"), "_number", "_name"
    )
    pairs = [(F.lower(applications["round_id"]), "_rid"), (applications["chain_id"], "chain_id")]
    return _left(applications, labels, pairs, {"round_num": "_number", "round_name": "_name"})


def attach_matching_registry(matching: DataFrame, registry: DataFrame) -> DataFrame:
    """Round number for matching rows; only the registry's round id is lower-cased."""
    side = registry.select("chain_id", F.lower("round_id").alias("_rid"), "round_number")
    pairs = [(matching["round_id"], "_rid"), (matching["chain_id"], "chain_id")]
    return _left(matching, side, pairs, {"round_num": "round_number"})


def attach_chain_name(df: DataFrame, mapping: DataFrame, name: str = "blockchain") -> DataFrame:
    """Chain name for a chain id, from one of the fixed chain lists."""
    return _left(df, F.broadcast(mapping), [(df["chain_id"], "chain_id")], {name: "chain_name"})


def attach_chain_id(df: DataFrame, mapping: DataFrame, name: str = "blockchain") -> DataFrame:
    """Chain id for a chain name, from one of the fixed chain lists; NULL if not listed."""
    return _left(df, F.broadcast(mapping), [(df[name], "chain_name")], {"chain_id": "chain_id"})


def interval_blocks(first: Column, last: Column) -> Column:
    """(level, block) of the fewest aligned blocks of 2^level units that cover first..last, ends included.

    At most two blocks a level: some 2 log2 of the length, whatever the length.
    """
    block = lambda level, at: F.struct(level.cast("int").alias("level"), at.alias("block"))
    none = F.array().cast("array<struct<level:int,block:bigint>>")

    def climb(state: Column, level: Column) -> Column:
        low, high, found = state["low"], state["high"], state["found"]
        left = (low <= high) & (F.pmod(low, F.lit(2)) == 1)
        right = (low + left.cast("bigint") <= high) & (F.pmod(high, F.lit(2)) == 0)
        found = F.concat(found, F.when(left, F.array(block(level, low))).otherwise(none), F.when(right, F.array(block(level, high))).otherwise(none))
        # An empty rest stays empty: the ends would meet again on a higher level.
        up = lambda c, end: F.when(low <= high, F.shiftright(c, 1)).otherwise(end)
        rest = [up(low + left.cast("bigint"), low).alias("low"), up(high - right.cast("bigint"), high).alias("high")]
        return F.struct(*rest, found.alias("found"))

    start = F.struct(first.cast("bigint").alias("low"), last.cast("bigint").alias("high"), none.alias("found"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, climb, lambda state: state["found"])


def assign_round_by_time(
    df: DataFrame, timings: DataFrame, ts: str, bucket_seconds: int = DAY_SECONDS
) -> DataFrame:
    """``round_num`` of every window with ``start < ts < end``; rows in no window keep NULL.

    A window is listed as the few aligned blocks of days that cover it. The days
    that occur among the rows meet them through their block on every level, and
    the rows meet the windows of their day by equality plus the strict bounds. So a
    row meets a window at most once, overlapping windows still fan out, days
    without rows cost nothing and no side has to fit in memory. ``df`` is read twice.
    """
    bucket = lambda c: F.floor(F.unix_seconds(c) / F.lit(bucket_seconds))
    blocks = interval_blocks(bucket(F.col("start_date")), bucket(F.col("end_date")))
    windows = timings.where(F.col("start_date") < F.col("end_date")).select("round_num", "start_date", "end_date", F.inline(blocks))
    days = df.select(bucket(F.col(ts)).alias("_day")).where(F.col("_day").isNotNull()).distinct()
    placed = days.select("_day", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    placed = placed.withColumn("block", F.expr("shiftright(_day, level)"))
    known = placed.join(windows, ["level", "block"]).select("_day", "round_num", "start_date", "end_date")
    at = df[ts]
    inside = (bucket(at) == known["_day"]) & (at > known["start_date"]) & (at < known["end_date"])
    return df.join(known, inside, "left").select(*[df[c] for c in df.columns], known["round_num"])


def attach_application(df: DataFrame, applications: DataFrame, add: dict[str, Column], application: str) -> DataFrame:
    """Columns of the application by chain, round and application id."""
    side = applications.select(
        F.col("chain_id"), F.col("round_id"), F.col("id"), *[c.alias(f"_src_{out}") for out, c in add.items()]
    )
    pairs = [(df["chain_id"], "chain_id"), (df["round_id"], "round_id"), (df[application], "id")]
    return _left(df, side, pairs, {out: f"_src_{out}" for out in add})


def attach_stats(df: DataFrame, stats: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Left join to aggregates; ``keys`` maps a column of ``df`` to one of ``stats``."""
    add = {c: c for c in stats.columns if c not in keys.values()}
    return _left(df, stats, [(df[a], b) for a, b in keys.items()], add)


def restrict_to_rounds(df: DataFrame, rounds: DataFrame, strategy: str) -> DataFrame:
    """Rows whose round runs ``strategy``; round keys are unique, so a semi join does."""
    chosen = rounds.where(F.col("strategy_name") == strategy)
    on = (df["round_id"] == chosen["id"]) & (df["chain_id"] == chosen["chain_id"])
    return df.join(chosen, on, "left_semi")


def attach_program(totals: DataFrame, programs: DataFrame) -> DataFrame:
    """Program of a report row; its chain id is text there ('0' where unknown)."""
    pairs = [(totals["Chain ID"].cast("int"), "chain_id"), (totals["Round ID"], "round_id")]
    return _left(totals, programs, pairs, {"program": "program"})


def split_credit(df: DataFrame, shares: DataFrame, keys: list[str], value: str, splits: str, how: str = "left"):
    """Each value divided among the addresses that share its key: one row per address."""
    joined = df.join(shares, keys, how)
    return joined.withColumn("gmv", F.col(value).cast("double") / F.nullif(F.col(splits), F.lit(0)))


def explode_distribution(rounds: DataFrame) -> DataFrame:
    """One row per entry of a round's matching distribution; rounds without entries go.

    The document is parsed once: ``entry`` holds the element and ``paid_at`` the block time text.
    """
    kept = [c for c in rounds.columns if c != "matching_distribution"]
    parsed = rounds.select(*kept, json_fields(F.col("matching_distribution"), MATCHING_DOCUMENT).alias("_doc"))
    # The time is taken out first, so that the rows of a round do not each carry its whole document.
    timed = parsed.select(*kept, F.col("_doc.blockTimestamp").alias("paid_at"), "_doc")
    # The outer form with a test of the position: for a plain explode Spark would derive a filter
    # on the array size, and parse the document once more for it.
    entries = F.posexplode_outer("_doc.matchingDistribution").alias("_at", "entry")
    return timed.select(*kept, "paid_at", entries).where(F.col("_at").isNotNull()).drop("_at")


def attach_names(df: DataFrame, names: DataFrame) -> DataFrame:
    """Name of an address; case matters."""
    return _left(df, names, [(df["address"], "address")], {"name": "name"})


def attach_payout_address(df: DataFrame, addresses: DataFrame, key: str, lookup_key: str, add: dict[str, str]):
    """Payout details by title or grant id; a key listed twice gives two rows."""
    return _left(df, addresses, [(df[key], lookup_key)], add)
