"""Aggregates, and aggregates carried back to the rows of their group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fundlens.functions.values import credits_to_usd


def with_group_totals(
    df: DataFrame, keys: list[str], aggs: dict[str, Column], nullable_keys: bool = True
) -> DataFrame:
    """Every row with the aggregates of its group, as ``agg OVER (PARTITION BY keys)`` gives.

    A window would send a whole group to one task. Here the aggregate combines on
    the map side and its one row per group is joined back. Both sides of that join
    sit directly on a shuffle, so the rows of a hot group, copies included, are
    split at run time and its totals go to every split. The merge hint keeps the
    totals off the driver: Spark would judge them by the size of the files behind
    ``df``, which says little about their number. ``df`` is read twice. NULL keys form a group; say so if there are none,
    plain equality is faster.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(f"_{n}") for n, c in aggs.items()])
    # Always 0, but not known to be: with it the totals are shuffled anew for the join instead of
    # staying where they were aggregated, which would keep Spark from splitting the rows.
    place = F.pmod(F.hash(*keys), F.lit(1))
    right = totals.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[f"_{n}" for n in aggs], place.alias("_total_place")).hint("merge")
    left = df.withColumn("_place", place)
    pairs = [(left[k], right[f"_key_{k}"]) for k in keys]
    same = reduce(lambda a, b: a & b, [a.eqNullSafe(b) if nullable_keys else a == b for a, b in pairs])
    joined = left.join(right, same & (left["_place"] == right["_total_place"]), "left")
    return joined.select(*[left[c] for c in df.columns], *[F.col(f"_{n}").alias(n) for n in aggs])


def with_split_count(df: DataFrame, keys: list[str], name: str = "address_count") -> DataFrame:
    """Every row with the number of rows of its group."""
    return with_group_totals(df, keys, {name: F.count(F.lit(1))})


def round_operators(roles: DataFrame) -> DataFrame:
    """Distinct addresses of each round and how many of them share its value.

    Every role counts, and an address with two roles counts once.
    """
    people = roles.select("chain_id", "round_id", "address").distinct()
    counted = with_group_totals(people, ["chain_id", "round_id"], {"count_addresses": F.count("address")})
    return counted.select("chain_id", "round_id", "address", F.lit("round_operator").alias("role"), "count_addresses")


def control_total(df: DataFrame, amount: Column | str) -> DataFrame:
    """One row: the sum of ``amount`` over rows where it is not NULL, or 0."""
    value = F.col(amount) if isinstance(amount, str) else amount
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).alias("total"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def payout_totals(payouts: DataFrame) -> DataFrame:
    """Direct payouts per round: sum and time of the last one."""
    return payouts.groupBy("chain_id", "round_id").agg(
        F.sum("amount_in_usd").alias("direct_grants_payout"), F.max("timestamp").alias("last_payout_time")
    )


def contribution_stats(contributions: DataFrame) -> DataFrame:
    """Voice-credit value, distinct donors and transactions, last time, per round."""
    return contributions.groupBy("round_id", "chain_id").agg(
        credits_to_usd(F.sum("voice_credit_balance")).alias("usd"),
        F.countDistinct("contributor_address").alias("unique_donors"),
        F.countDistinct("transaction_hash").alias("transactions"),
        F.max("timestamp").alias("latest_contribution"),
    )


def group_summary(profiles: DataFrame) -> DataFrame:
    """Per project group: donated total (0 if all NULL), newest time, number of projects."""
    return profiles.groupBy("group_id").agg(
        F.coalesce(F.sum("amount_donated"), F.lit(0)).alias("total_amount_donated"),
        F.max("created_at").alias("latest_created_application"),
        F.count("project_id").alias("application_count"),
    )
