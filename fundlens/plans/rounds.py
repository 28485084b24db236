"""Round totals report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from fundlens import constants as K
from fundlens.functions.text import json_text
from fundlens.functions.values import null_to_zero, safe_div, strategy_title
from fundlens.operators.filters import active_since, drop_test_chains, until, where_in
from fundlens.operators.groups import contribution_stats, payout_totals
from fundlens.operators.joins import attach_chain_name, attach_program, attach_stats, restrict_to_rounds
from fundlens.operators.sets import order_totals, stack
from fundlens.sources.readers import chain_names

REPORT_COLUMNS = [
    "program", "Name", "Total USD", "Crowdfunding USD", "Matching USD", "Donations", "Donors",
    "Avg Donor Contribution", "Chain", "Indexed Time", "Strategy", "Chain ID", "Round ID",
]
_KEYS = {"chain_id": "chain_id", "id": "round_id"}


def programs(registry: DataFrame) -> DataFrame:
    """Program of each numbered round, a few rounds left out; round ids in lower case."""
    numbered = registry.where(F.col("round_number").isNotNull())
    kept = where_in(numbered, "round_id", K.EXCLUDED_PROGRAM_ROUNDS, negate=True, lower=True)
    return kept.select("program", "chain_id", F.lower("round_id").alias("round_id"))


def direct_allocation_stats(donations: DataFrame, rounds: DataFrame) -> DataFrame:
    """Last donation and total of each direct donation round.

    Sums come before the restriction: a round with very many donations is then
    one row, whereas rows joined on the round would meet in one task.
    """
    given = donations.groupBy("round_id", "chain_id").agg(
        F.max("timestamp").alias("last_donation_time"), F.sum("amount_in_usd").alias("total_donated")
    )
    return restrict_to_rounds(given, rounds.select("id", "chain_id", "strategy_name"), K.DIRECT_ALLOCATION_V2)


def _per_donor(total: Column, donors: Column) -> Column:
    return null_to_zero(safe_div(null_to_zero(total), donors))


def _usd(c: Column) -> Column:
    return c.cast("double")


def external_totals(external: DataFrame, now: datetime | None) -> DataFrame:
    """Rounds that the indexer does not know; they are all matching."""
    past = until(external, "timestamp", now)
    zero = F.lit(0).cast("bigint")
    return past.select(
        F.col("desc").alias("Name"),
        _usd(F.col("amount_in_usd")).alias("Total USD"),
        F.lit(0.0).alias("Crowdfunding USD"),
        _usd(F.col("amount_in_usd")).alias("Matching USD"),
        zero.alias("Donations"),
        zero.alias("Donors"),
        F.lit(0.0).alias("Avg Donor Contribution"),
        F.col("network_name").alias("Chain"),
        F.col("timestamp").alias("Indexed Time"),
        F.col("strategy_name").alias("Strategy"),
        F.lit("0").alias("Chain ID"),
        F.lit("0").alias("Round ID"),
    )


def indexed_totals(rounds: DataFrame, payouts: DataFrame, donations: DataFrame) -> DataFrame:
    """Indexed rounds. A round with a distribution counts its pool, even a NULL one;
    only a round without a distribution falls back to its direct payouts."""
    listed = drop_test_chains(active_since(rounds)).select(
        "id", "chain_id", "strategy_name", json_text(F.col("round_metadata"), "name").alias("name"),
        F.col("matching_distribution").isNotNull().alias("distributed"), "match_amount_in_usd",
        "total_amount_donated_in_usd", "total_donations_count", "unique_donors_count", "donations_end_time",
        "applications_start_time",
    )
    listed = attach_stats(listed, payout_totals(drop_test_chains(payouts)), _KEYS)
    listed = attach_stats(listed, direct_allocation_stats(drop_test_chains(donations), rounds), _KEYS)
    listed = attach_chain_name(listed, chain_names(rounds.sparkSession), "chain_name")

    direct = F.col("strategy_name") == K.DIRECT_ALLOCATION_V2
    crowd = null_to_zero(F.col("total_amount_donated_in_usd"))
    pool = F.when(F.col("distributed"), F.col("match_amount_in_usd")).otherwise(F.col("direct_grants_payout"))
    matching = null_to_zero(pool)
    ended = F.coalesce("donations_end_time", "last_payout_time")
    time = F.coalesce(F.when(direct, F.col("last_donation_time")).otherwise(ended), "applications_start_time")
    return listed.select(
        F.when(direct, K.DIRECT_ALLOCATION_ROUND_NAME).otherwise(F.col("name")).alias("Name"),
        _usd(crowd + matching).alias("Total USD"),
        _usd(crowd).alias("Crowdfunding USD"),
        _usd(matching).alias("Matching USD"),
        null_to_zero(F.col("total_donations_count")).cast("bigint").alias("Donations"),
        null_to_zero(F.col("unique_donors_count")).cast("bigint").alias("Donors"),
        _per_donor(F.col("total_amount_donated_in_usd"), F.col("unique_donors_count")).alias("Avg Donor Contribution"),
        F.col("chain_name").alias("Chain"),
        time.alias("Indexed Time"),
        strategy_title(F.col("strategy_name")).alias("Strategy"),
        F.col("chain_id").cast("string").alias("Chain ID"),
        F.col("id").alias("Round ID"),
    )


def maci_report(maci_rounds: DataFrame, contributions: DataFrame) -> DataFrame:
    """Voice-credit rounds."""
    listed = drop_test_chains(maci_rounds).withColumn("name", json_text(F.col("round_metadata"), "name"))
    listed = attach_stats(listed, contribution_stats(contributions), _KEYS)
    listed = attach_chain_name(listed, chain_names(maci_rounds.sparkSession), "chain_name")
    usd = null_to_zero(F.col("usd"))
    strategy = F.col("strategy_name")
    return listed.select(
        F.col("name").alias("Name"),
        usd.alias("Total USD"),
        usd.alias("Crowdfunding USD"),
        F.lit(0.0).alias("Matching USD"),
        null_to_zero(F.col("transactions")).alias("Donations"),
        null_to_zero(F.col("unique_donors")).alias("Donors"),
        _per_donor(F.col("usd"), F.col("unique_donors")).alias("Avg Donor Contribution"),
        F.col("chain_name").alias("Chain"),
        F.col("donations_end_time").alias("Indexed Time"),
        F.when(strategy == K.MACI_V2, K.MACI_TITLE).otherwise(strategy).alias("Strategy"),
        F.col("chain_id").cast("string").alias("Chain ID"),
        F.col("id").alias("Round ID"),
    )


def round_totals(
    rounds: DataFrame,
    payouts: DataFrame,
    donations: DataFrame,
    registry: DataFrame,
    external: DataFrame,
    maci_rounds: DataFrame,
    maci_contributions: DataFrame,
    now: datetime | None = None,
) -> DataFrame:
    """Totals of all rounds from the three sources, largest first."""
    totals = stack(
        [
            external_totals(external, now),
            indexed_totals(rounds, payouts, donations),
            maci_report(maci_rounds, maci_contributions),
        ]
    )
    report = attach_program(totals, programs(registry))
    return order_totals(report.select(*[F.col(f"`{c}`") for c in REPORT_COLUMNS]))
