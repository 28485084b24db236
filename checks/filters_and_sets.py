"""Checks of P1-P10, O1-O5 and U1-U3."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import check
from fundlens.operators import filters, sets
from fundlens.plans import ingest
from fundlens.functions.text import json_text


@check(
    "p1_project_constants",
    "SELECT donor_address AS donor, amount_in_usd AS usd, 'GrantsStack' AS source, '' AS round_id, 16 AS round_num FROM {donations}",
)
def _(v):
    return filters.select_as(
        v.donations,
        {
            "donor": "donor_address", "usd": "amount_in_usd", "source": F.lit("GrantsStack"), "round_id": F.lit(""),
            "round_num": F.lit(16),
        },
    )


@check("p2_drop_test_chain", "SELECT id, chain_id FROM {donations} WHERE chain_id <> 11155111")
def _(v):
    return filters.drop_test_chains(v.donations).select("id", "chain_id")


@check("p3_thresholds", "SELECT id, amount_in_usd FROM {payouts} WHERE amount_in_usd > 0 AND transaction_hash IS NOT NULL")
def _(v):
    return filters.not_null(filters.above(v.payouts, "amount_in_usd", 0), "transaction_hash").select(
        "id", "amount_in_usd"
    )


@check("p3_threshold_inclusive", "SELECT event_id, value FROM {events} WHERE value >= 0.5")
def _(v):
    return filters.above(v.events, "value", 0.5, inclusive=True).select("event_id", "value")


@check(
    "p4_in_and_not_in",
    "SELECT address, chain, entity_id FROM {label_book} WHERE lower(address) IN ('0xc1','0xc2','0xc30') AND chain NOT IN ('polygon','base')",
)
def _(v):
    chosen = filters.where_in(v.label_book, "address", ["0xc1", "0xc2", "0xc30"], lower=True)
    return filters.where_in(chosen, "chain", ["polygon", "base"], negate=True).select("address", "chain", "entity_id")


@check(
    "p5_active_since",
    "SELECT id, strategy_name, donations_end_time FROM {order_rounds} WHERE donations_end_time >= TIMESTAMP '2024-01-01' "
    "OR applications_start_time >= TIMESTAMP '2024-01-01' OR strategy_name = 'allov2.DirectAllocationStrategy'",
)
def _(v):
    return filters.active_since(v.order_rounds).select("id", "strategy_name", "donations_end_time")


@check("p6_until_now", "SELECT event_id, ts FROM {events} WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'")
def _(v):
    return filters.until(v.events, "ts", datetime(2024, 1, 15, 12)).select("event_id", "ts")


@check(
    "p7_drop_strategy",
    "SELECT tx_hash, strategy_name FROM {external_events} WHERE strategy_name <> 'DonationVotingMerkleDistributionDirectTransferStrategy'",
)
def _(v):
    name = "DonationVotingMerkleDistributionDirectTransferStrategy"
    return filters.drop_strategy(v.external_events, name).select("tx_hash", "strategy_name")


@check("p8_like", "SELECT schema_name, o_orderkey FROM {schema_names} WHERE schema_name LIKE 'chain_data___'")
def _(v):
    return filters.where_like(v.schema_names, "schema_name", "chain_data___").select("schema_name", "o_orderkey")


@check(
    "p9_valid_address",
    "SELECT grantid, payoutaddress FROM {past_grants} WHERE regexp_matches(payoutaddress, '^0x[a-fA-F0-9]{{40}}$')",
)
def _(v):
    return filters.valid_addresses(v.past_grants, "payoutaddress").select("grantid", "payoutaddress")


@check("p10_require_title", "SELECT p_partkey, title FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN NULL ELSE p_name END AS title FROM {part}) t WHERE title <> ''")
def _(v):
    title = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 2, F.col("p_name"))
    return filters.require_title(v.part.select("p_partkey", title.alias("title")))


PER_DONOR = 'SELECT donor_address, SUM(CASE WHEN donor_address IS NULL THEN NULL ELSE amount_in_usd END) AS "Total USD" FROM {donations} GROUP BY donor_address'


@check("o1_order_totals_nulls_first", PER_DONOR)
def _(v):
    totals = v.donations.groupBy("donor_address").agg(
        F.sum(F.when(F.col("donor_address").isNotNull(), F.col("amount_in_usd"))).alias("Total USD")
    )
    return sets.order_totals(totals)


@check("o2_order_events", "SELECT tx_timestamp, role, address, gmv FROM {external_events}")
def _(v):
    return sets.order_events(v.external_events, ingest.EVENT_ORDER).select(*ingest.EVENT_ORDER)


@check("o3_order_ids_as_text", "SELECT CAST(o_custkey AS STRING) AS group_id, o_orderkey FROM {orders}")
def _(v):
    return sets.order_lookup(v.orders.select(F.col("o_custkey").cast("string").alias("group_id"), "o_orderkey"))


@check("o4_top_n", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(v):
    rows = v.orders.select("o_orderkey", "o_totalprice")
    return sets.top_n(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 25)


@check("o5_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} ORDER BY o_orderkey LIMIT 5")
def _(v):
    return sets.preview(v.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])


@check(
    "u1_union_all",
    "SELECT id, amount_in_usd, 'indexer' AS source FROM {donations} UNION ALL SELECT id, amount_in_usd, 'static' FROM {old_donations}",
)
def _(v):
    part = lambda df, name: df.select("id", "amount_in_usd", F.lit(name).alias("source"))
    return sets.stack([part(v.donations, "indexer"), part(v.old_donations, "static")])


@check(
    "u2_union_distinct",
    "SELECT donor_address, chain_id, application_id FROM {donations} UNION SELECT donor_address, chain_id, application_id FROM {old_donations}",
)
def _(v):
    columns = ["donor_address", "chain_id", "application_id"]
    return sets.union_distinct(v.donations.select(*columns), v.old_donations.select(*columns))


@check(
    "u3_concat_missing_columns",
    "SELECT name AS title, CAST(grantid AS STRING) AS project_id, createdon AS last_seen FROM {past_grants} "
    "UNION ALL SELECT metadata->>'$.application.project.title', project_id, NULL FROM {applications}",
)
def _(v):
    past = v.past_grants.select(
        F.col("name").alias("title"), F.col("grantid").cast("string").alias("project_id"),
        F.col("createdon").alias("last_seen"),
    )
    current = v.applications.select(
        json_text(F.col("metadata"), "application", "project", "title").alias("title"), "project_id"
    )
    return sets.concat_profiles(past, current)
