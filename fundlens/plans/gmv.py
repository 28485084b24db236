"""Value moved per transaction, attributed to donors, grantees, operators and developers.

Values are summed per transaction as decimals before anything fans out, so the
fan-out joins are not followed by another aggregation. Amounts of shared value
leave as DOUBLE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from fundlens import constants as K
from fundlens.functions.text import json_fields, json_text
from fundlens.functions.times import iso_ts
from fundlens.functions.values import credits_to_usd, match_usd, strategy_or_default
from fundlens.operators.filters import above, drop_strategy, drop_test_chains
from fundlens.operators.groups import round_operators
from fundlens.operators.joins import (
    attach_application,
    attach_chain_id,
    attach_chain_name,
    attach_names,
    attach_stats,
    explode_distribution,
    split_credit,
)
from fundlens.operators.sets import stack
from fundlens.session import shuffles_cleaned, staging_path, write_observed
from fundlens.sources.readers import chain_mapping
from fundlens.sources.schemas import GRANT_METADATA

# Exact sums of money need a fixed scale.
AMOUNT = "decimal(28,8)"
ROUND_KEY = ["chain_id", "round_id"]
TX_KEY = ["chain_id", "round_id", "tx_hash", "tx_timestamp"]
ROW_COLUMNS = [
    "blockchain", "chain_id", "pool_name", "round_id", "tx_timestamp", "tx_hash", "address", "strategy_name", "role",
    "gmv",
]
EVENT_COLUMNS = [
    "blockchain", "round_id", "strategy_name", "pool_name", "tx_timestamp", "tx_hash", "address", "role", "gmv",
    "data_source", "name",
]

DevRule = Callable[[Column, Column], Column]


def _known(*options: tuple[Column, str]) -> Column:
    """Array of the addresses whose condition holds."""
    return F.filter(F.array(*[F.when(cond, F.lit(a)) for cond, a in options]), lambda x: x.isNotNull())


def donation_devs(strategy: Column, blockchain: Column) -> Column:
    """Developer addresses of donations: a main one, and a second one for some contracts."""
    v2 = strategy.isin(K.VOTING_V2, K.DIRECT_ALLOCATION_V2)
    v1_optimism = (strategy == K.QF_V1) & (blockchain == "optimism")
    v1_ethereum = (strategy == K.QF_V1) & (blockchain == "ethereum")
    devs = _known(
        (v2, K.DEV_V2),
        (v1_optimism, K.DEV_V1_OPTIMISM),
        (~v2 & ~v1_optimism, K.DEV_DEFAULT),
        (strategy == K.VOTING_V2, K.DEV_VOTING),
        (v1_ethereum, K.DEV_V1_OPTIMISM),
    )
    return F.when(blockchain.isNotNull() & (strategy != ""), devs)


def distribution_devs(strategy: Column, blockchain: Column) -> Column:
    """Developer addresses of distributions; both contract generations differ from donations."""
    v2 = strategy.isin(K.VOTING_V2, K.DIRECT_LITE_V2)
    v1 = strategy.isin(K.QF_V1, K.DIRECT_V1)
    v1_optimism = v1 & (blockchain == "optimism")
    devs = _known(
        (v2, K.DEV_V2),
        (v1_optimism, K.DEV_V1_OPTIMISM),
        (~v2 & ~v1_optimism, K.DEV_DEFAULT),
        (v1 & (blockchain == "ethereum"), K.DEV_V1_OPTIMISM),
    )
    return F.when(blockchain.isNotNull() & strategy.isNotNull(), devs)


def maci_devs(strategy: Column, blockchain: Column) -> Column:
    """Voice-credit rounds: always two addresses."""
    return F.when(blockchain.isNotNull(), F.array(F.lit(K.DEV_V2), F.lit(K.DEV_MACI)))


def dev_shares(pairs: DataFrame, rule: DevRule) -> DataFrame:
    """Developer addresses and split count of each distinct (strategy_name, blockchain)."""
    devs = rule(F.col("strategy_name"), F.col("blockchain"))
    known = pairs.select("strategy_name", "blockchain").distinct().withColumn("devs", devs)
    return known.select(
        "strategy_name", "blockchain", F.explode("devs").alias("dev_address"), F.size("devs").alias("address_count")
    )


def _round_profile(rounds: DataFrame) -> DataFrame:
    """The few columns of a round that events carry; the JSON stays behind."""
    return rounds.select(
        "chain_id", F.col("id").alias("round_id"), "strategy_name",
        json_text(F.col("round_metadata"), "name").alias("pool_name"),
    )


def _party_totals(donations: DataFrame, address: str, role: str) -> DataFrame:
    return donations.groupBy(
        "chain_id", "round_id", F.col("transaction_hash").alias("tx_hash"), F.col("timestamp").alias("tx_timestamp"),
        F.col(address).alias("address"),
    ).agg(F.sum("amount_in_usd").alias("total")).withColumn("role", F.lit(role))


def _on_round() -> dict[str, str]:
    return {"chain_id": "chain_id", "round_id": "round_id"}


def donations_by_tx(donations: DataFrame, rounds: DataFrame, chains: DataFrame) -> DataFrame:
    """Donated total per round and transaction."""
    totals = donations.groupBy(
        "chain_id", "round_id", F.col("transaction_hash").alias("tx_hash"), F.col("timestamp").alias("tx_timestamp")
    ).agg(F.sum("amount_in_usd").alias("total_amount_in_usd"))
    profiled = attach_chain_name(attach_stats(totals, _round_profile(rounds), _on_round()), chains)
    return profiled.select(
        "chain_id", "blockchain", "round_id", strategy_or_default(F.col("strategy_name")).alias("strategy_name"),
        F.col("pool_name").alias("round_name"), "tx_hash", "tx_timestamp", "total_amount_in_usd",
    )


def operator_share(base: DataFrame, operators: DataFrame, value: str = "gmv") -> DataFrame:
    """Each row's value divided among the operators of its round; without any, address is NULL."""
    shares = operators.select(*ROUND_KEY, "address", "count_addresses")
    rows = split_credit(base.withColumnRenamed(value, "_value"), shares, ROUND_KEY, "_value", "count_addresses")
    return rows.withColumn("role", F.lit("round_operator")).select(*ROW_COLUMNS)


def dev_share(base: DataFrame, rule: DevRule, value: str = "gmv") -> DataFrame:
    """Each row's value divided among the contract developers; without any, address is NULL."""
    listed = base.withColumnRenamed(value, "_value").withColumn(
        "_devs", rule(F.col("strategy_name"), F.col("blockchain"))
    )
    share = F.col("_value").cast("double") / F.nullif(F.size("_devs"), F.lit(0))
    gmv = F.when(F.col("_devs").isNotNull(), share)
    return listed.select(
        "*", gmv.alias("gmv"), F.explode_outer("_devs").alias("address"), F.lit("contract_dev").alias("role")
    ).select(*ROW_COLUMNS)


def per_tx(rows: DataFrame, value: str = "gmv") -> DataFrame:
    """Rows that differ in address or project only, summed per transaction."""
    return rows.groupBy(*[c for c in ROW_COLUMNS if c not in ("address", "role", "gmv")]).agg(
        F.sum(value).alias("gmv")
    )


def donor_grantee_share(donations: DataFrame, rounds: DataFrame, chains: DataFrame) -> DataFrame:
    """One donation gives a donor row and a grantee row, summed per transaction and address."""
    parties = _party_totals(donations, "donor_address", "donor").unionByName(
        _party_totals(donations, "recipient_address", "grantee")
    )
    profiled = attach_chain_name(attach_stats(parties, _round_profile(rounds), _on_round()), chains)
    return profiled.withColumn("strategy_name", strategy_or_default(F.col("strategy_name"))).withColumn(
        "gmv", F.col("total").cast("double")
    ).select(*ROW_COLUMNS)


def distribution_base(rounds: DataFrame, applications: DataFrame, payouts: DataFrame) -> DataFrame:
    """Matched payouts from the rounds' distributions, and direct payouts above zero."""
    entry = F.col("entry")
    matched = explode_distribution(drop_test_chains(rounds)).select(
        "chain_id",
        F.col("id").alias("round_id"),
        json_text(F.col("round_metadata"), "name").alias("round_name"),
        F.coalesce(iso_ts(F.col("paid_at")), F.col("donations_end_time")).alias("timestamp"),
        entry["projectName"].alias("project_name"),
        entry["projectPayoutAddress"].alias("recipient_address"),
        match_usd(entry["matchPoolPercentage"], F.col("match_amount_in_usd"), F.col("id")).cast(AMOUNT).alias(
            "amount_in_usd"
        ),
        "strategy_id",
        "strategy_name",
        entry["applicationId"].alias("application_id"),
    )
    matched = attach_application(
        matched, applications, {"transaction_hash": F.col("distribution_transaction")}, "application_id"
    ).withColumn("source_type", F.lit("matching"))

    profile = rounds.select(
        "chain_id", F.col("id").alias("round_id"), json_text(F.col("round_metadata"), "name").alias("round_name"),
        "strategy_id", "strategy_name",
    )
    # Amounts get their wide type behind the joins: a payout is shuffled as narrow as it was read.
    direct = attach_application(
        above(payouts, "amount_in_usd", 0),
        applications.withColumn("_grant", json_fields(F.col("metadata"), GRANT_METADATA)["application"]),
        {"project_name": F.col("_grant.project.title"), "recipient_address": F.col("_grant.recipient")},
        "application_id",
    )
    direct = attach_stats(direct, profile, _on_round()).withColumn("source_type", F.lit("direct")).withColumn(
        "amount_in_usd", F.col("amount_in_usd").cast(AMOUNT)
    )
    columns = [
        "chain_id", "round_id", "round_name", "timestamp", "project_name", "recipient_address", "transaction_hash",
        "amount_in_usd", "strategy_id", "strategy_name", "source_type",
    ]
    return stack([matched.select(*columns), direct.select(*columns)])


def grantee_rows(base: DataFrame, chains: DataFrame) -> DataFrame:
    """Distributed amounts as rows of the grantee; gmv stays DECIMAL for later sums."""
    named = attach_chain_name(base, chains)
    return named.select(
        "blockchain", "chain_id", F.col("round_name").alias("pool_name"), "round_id",
        F.col("timestamp").alias("tx_timestamp"), F.col("transaction_hash").alias("tx_hash"),
        F.col("recipient_address").alias("address"), "strategy_name", F.lit("grantee").alias("role"),
        F.col("amount_in_usd").alias("gmv"),
    )


def maci_totals(contributions: DataFrame, rounds: DataFrame, chains: DataFrame) -> DataFrame:
    """Voice credits per round, transaction and contributor, with the newest time."""
    totals = contributions.groupBy(
        "round_id", "chain_id", F.col("contributor_address").alias("address"),
        F.col("transaction_hash").alias("tx_hash"),
    ).agg(F.sum("voice_credit_balance").alias("credits"), F.max("timestamp").alias("tx_timestamp"))
    named = attach_stats(totals, _round_profile(rounds).drop("strategy_name"), _on_round())
    return attach_chain_name(named, chains).withColumn("strategy_name", F.lit(K.MACI_LABEL))


def donor_rows(totals: DataFrame) -> DataFrame:
    """Voice-credit totals as rows of the donor."""
    return totals.withColumn("role", F.lit("donor")).withColumn("gmv", credits_to_usd(F.col("credits"))).select(
        *ROW_COLUMNS
    )


def maci_tx(totals: DataFrame) -> DataFrame:
    """Voice-credit value per transaction; credits are summed before they are converted."""
    return per_tx(totals, "credits").withColumn("gmv", credits_to_usd(F.col("gmv")))


def external_rows(events: DataFrame, chains: DataFrame) -> DataFrame:
    """On-chain distribution events from outside the indexer; one strategy is covered elsewhere."""
    kept = drop_strategy(events, K.EXTERNAL_VOTING)
    return attach_chain_id(kept, chains).withColumns(
        {"pool_name": F.lit(""), "round_id": F.lit("")}
    ).select(*ROW_COLUMNS)


def _countable(rows: DataFrame) -> DataFrame:
    kept = above(rows.where(F.col("address").isNotNull()), "gmv", K.MIN_GMV, inclusive=True)
    return drop_test_chains(kept)


def finish_gmv(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with an address, on a known chain, of at least the least value; names added."""
    return attach_names(_countable(rows), names).select(*EVENT_COLUMNS)


def _round_shares(profile: DataFrame, operators: DataFrame, rule: DevRule, names: DataFrame, chains: DataFrame):
    """Who shares the value of each round: its operators and its contract developers, with names.

    Developers are a handful of addresses that occur in every transaction.
    Naming them here, per round, keeps them out of the join of names to events.
    """
    profile = attach_chain_name(profile, chains)
    people = operators.select(*ROUND_KEY, "address", "role", F.col("count_addresses").alias("splits"))
    people = attach_chain_name(attach_stats(people, profile.drop("blockchain"), _on_round()), chains)
    devs = profile.withColumn("_devs", rule(F.col("strategy_name"), F.col("blockchain"))).select(
        *profile.columns, F.lit("contract_dev").alias("role"), F.size("_devs").cast("bigint").alias("splits"),
        F.explode("_devs").alias("address"),
    )
    shares = people.unionByName(devs).where(F.col("address").isNotNull())
    return attach_names(drop_test_chains(shares), names)


def _share_out(totals: DataFrame, shares: DataFrame, source: str) -> DataFrame:
    rows = split_credit(drop_test_chains(totals), shares, ROUND_KEY, "total", "splits", "inner")
    return above(rows, "gmv", K.MIN_GMV, inclusive=True).withColumn("data_source", F.lit(source)).select(
        *EVENT_COLUMNS
    )


def zstd_step(df: DataFrame, tag: str) -> DataFrame:
    """What :func:`cut_lineage` does, in the codec that takes the least room."""
    return write_observed(df, staging_path(df.sparkSession, tag), "zstd")[0]


def _party_events(parties: DataFrame, role: str, labelled: DataFrame, names: DataFrame, chains: DataFrame) -> DataFrame:
    """Totals of donors or of grantees as events; names come first, while the rows are narrow."""
    totals = parties.withColumn("gmv", F.col("total").cast("double")).select(*TX_KEY, "address", "gmv")
    named = attach_names(_countable(totals), names)
    return attach_chain_name(attach_stats(named, labelled, _on_round()), chains).withColumns(
        {"role": F.lit(role), "data_source": F.lit(K.FROM_DONATION)}
    ).select(*EVENT_COLUMNS)


def event_parts(
    donations: DataFrame,
    rounds: DataFrame,
    applications: DataFrame,
    payouts: DataFrame,
    roles: DataFrame,
    maci_contributions: DataFrame,
    maci_rounds: DataFrame,
    maci_roles: DataFrame,
    external_events: DataFrame,
    names: DataFrame,
    stage: Callable[[DataFrame, str], DataFrame] = zstd_step,
) -> dict[str, DataFrame]:
    """All attributed events in parts, which can be written one after another.

    ``rounds`` is unique on (id, chain_id). ``stage`` writes the frames that are
    read more than once and returns what was written: their readers take other
    columns, so Spark would find no equal exchange to reuse and build each frame anew.
    The totals per transaction are written too, so that what was shuffled to sum them
    is gone when they are shared out.
    """
    chains = chain_mapping(donations.sparkSession)
    profile = _round_profile(rounds)
    # Nothing on a test chain is counted: it goes before it is shuffled.
    donations, applications, payouts = map(drop_test_chains, (donations, applications, payouts))
    contributions = drop_test_chains(maci_contributions)

    with shuffles_cleaned(donations.sparkSession):
        operators = stage(round_operators(roles), "gmv_operators")
        grantees = stage(_party_totals(donations, "recipient_address", "grantee"), "gmv_grantees")
        by_tx = stage(grantees.groupBy(*TX_KEY).agg(F.sum("total").alias("total")), "gmv_donated")

        paid = stage(distribution_base(rounds, applications, payouts), "gmv_distributions")
        paid_by_tx = paid.groupBy(
            *ROUND_KEY, F.col("transaction_hash").alias("tx_hash"), F.col("timestamp").alias("tx_timestamp")
        ).agg(F.sum("amount_in_usd").alias("total"))
        paid_by_tx = stage(paid_by_tx, "gmv_distributed")

        credits = stage(maci_totals(contributions, maci_rounds, chains), "gmv_voice_credits")
        credits_by_tx = maci_tx(credits).withColumnRenamed("gmv", "total").select(*TX_KEY, "total")

    donors = _party_totals(donations, "donor_address", "donor")
    labelled = profile.withColumn("strategy_name", strategy_or_default(F.col("strategy_name")))
    donation_shares = _round_shares(labelled, operators, donation_devs, names, chains)
    distribution_shares = _round_shares(profile, operators, distribution_devs, names, chains)
    # Developers share in every contribution, also in rounds that are not listed.
    maci_profile = attach_stats(
        contributions.select(*ROUND_KEY).distinct(), _round_profile(maci_rounds).drop("strategy_name"), _on_round()
    ).withColumn("strategy_name", F.lit(K.MACI_LABEL))
    maci_shares = _round_shares(maci_profile, round_operators(maci_roles), maci_devs, names, chains)

    plain = stack(
        [
            grantee_rows(paid, chains).withColumn("data_source", F.lit(K.FROM_DISTRIBUTION)),
            donor_rows(credits).withColumn("data_source", F.lit(K.FROM_MACI)),
            external_rows(external_events, chains).withColumn("data_source", F.lit(K.FROM_EXTERNAL)),
        ]
    )
    return {
        "donors": _party_events(donors, "donor", labelled, names, chains),
        "grantees": _party_events(grantees, "grantee", labelled, names, chains),
        "others": finish_gmv(plain, names),
        "donation_shares": _share_out(by_tx, donation_shares, K.FROM_DONATION),
        "distribution_shares": _share_out(paid_by_tx, distribution_shares, K.FROM_DISTRIBUTION),
        "voice_shares": _share_out(credits_by_tx, maci_shares, K.FROM_MACI),
    }


def gmv_events(
    donations: DataFrame,
    rounds: DataFrame,
    applications: DataFrame,
    payouts: DataFrame,
    roles: DataFrame,
    maci_contributions: DataFrame,
    maci_rounds: DataFrame,
    maci_roles: DataFrame,
    external_events: DataFrame,
    names: DataFrame,
    stage: Callable[[DataFrame, str], DataFrame] = zstd_step,
) -> DataFrame:
    """All attributed events; equals :func:`finish_gmv` over the union of the branches.

    The shuffles of one frame lie on the disks together until it has been read, so
    two of the :func:`event_parts` that shuffle all their rows are written first.
    """
    parts = event_parts(
        donations, rounds, applications, payouts, roles, maci_contributions, maci_rounds, maci_roles, external_events,
        names, stage,
    )
    with shuffles_cleaned(donations.sparkSession):
        for name in ("grantees", "others"):
            parts[name] = stage(parts[name], f"gmv_events_of_{name}")
    return stack(list(parts.values()))
