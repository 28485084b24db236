"""Checks of F1-F21: column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.aggregates import owner_sql, title_sql
from checks.registry import check
from fundlens.functions import text, times, values

C = F.col


@check("f1_lower", "SELECT doc_id, lower(text) AS low FROM {documents}")
def _(v):
    return v.documents.select("doc_id", text.lower(C("text")).alias("low"))


@check(
    "f2_repair_hex_prefix",
    "SELECT block_time, usd_amount, '0' || COALESCE(lower(substr(donor, 2)), '') AS voter FROM {alpha_donations}",
)
def _(v):
    return v.alpha_donations.select("block_time", "usd_amount", text.repair_hex_prefix(C("donor")).alias("voter"))


@check(
    "f3_json_text",
    "SELECT id, chain_id, round_id, metadata->>'$.application.project.title' AS title, metadata->>'$.application.recipient' AS recipient, "
    "metadata->>'$.application.missing' AS missing, metadata->>'$.application.project.createdAt' AS created FROM {applications}",
)
def _(v):
    m = C("metadata")
    return v.applications.select(
        "id", "chain_id", "round_id", text.json_text(m, "application", "project", "title").alias("title"),
        text.json_text(m, "application", "recipient").alias("recipient"),
        text.json_text(m, "application", "missing").alias("missing"),
        text.json_text(m, "application", "project", "createdAt").alias("created"),
    )


@check("f3_json_null", "SELECT id, round_metadata->>'$.eligibility.description' AS description, round_metadata->>'$.name' AS name FROM {order_rounds}")
def _(v):
    m = C("round_metadata")
    return v.order_rounds.select(
        "id", text.json_text(m, "eligibility", "description").alias("description"), text.json_text(m, "name").alias("name")
    )


@check(
    "f4_json_elements",
    "SELECT r.id, e.projectId AS project_id, e.originalMatchAmountInToken AS original FROM {order_rounds} r, "
    "unnest(from_json(r.matching_distribution->'$.matchingDistribution', '[{{\"projectId\":\"VARCHAR\",\"originalMatchAmountInToken\":\"VARCHAR\"}}]')) AS u(e)",
)
def _(v):
    entries = text.json_elements(
        C("matching_distribution"), "matchingDistribution", "projectId: string, originalMatchAmountInToken: string"
    )
    return v.order_rounds.select("id", F.explode(entries).alias("e")).select(
        "id", C("e.projectId").alias("project_id"), C("e.originalMatchAmountInToken").alias("original")
    )


@check("f5_explode_array", "SELECT DISTINCT chain_id, unnest(['left', 'right']) AS side FROM {contributions}")
def _(v):
    return v.contributions.select("chain_id", F.explode(F.array(F.lit("left"), F.lit("right"))).alias("side")).distinct()


@check(
    "f6_iso_timestamp",
    "SELECT id, strptime(matching_distribution->>'$.blockTimestamp', '%Y-%m-%dT%H:%M:%S.%gZ') AS paid_at FROM {order_rounds}",
)
def _(v):
    stamp = text.json_text(C("matching_distribution"), "blockTimestamp")
    return v.order_rounds.select("id", times.iso_ts(stamp).alias("paid_at"))


@check(
    "f7_epoch_ms_timestamp",
    "SELECT id, round_id, chain_id, make_timestamp((CAST(metadata->>'$.application.project.createdAt' AS BIGINT) // 1000) * 1000000) AS created_at FROM {applications}",
)
def _(v):
    created = text.json_text(C("metadata"), "application", "project", "createdAt")
    return v.applications.select("id", "round_id", "chain_id", times.epoch_ms_ts(created).alias("created_at"))


@check(
    "f8_casts",
    "SELECT o_orderkey, CAST(o_orderkey AS STRING) AS key_text, CAST(CAST(o_custkey AS STRING) AS INT) AS cust, CAST(o_orderdate AS DATE) AS day, "
    "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS midnight, CAST(o_orderdate AS STRING) AS date_text FROM {orders}",
)
def _(v):
    day = C("o_orderdate").cast("date")
    return v.orders.select(
        "o_orderkey", C("o_orderkey").cast("string").alias("key_text"),
        C("o_custkey").cast("string").cast("int").alias("cust"), day.alias("day"),
        day.cast("timestamp").alias("midnight"), C("o_orderdate").cast("string").alias("date_text"),
    )


@check(
    "f9_labels",
    "SELECT id, CASE WHEN strategy_name IN ('allov1.QF', 'allov2.DonationVotingMerkleDistributionDirectTransferStrategy') THEN 'Allo QF' "
    "WHEN strategy_name IN ('allov1.Direct', 'allov2.DirectGrantsLiteStrategy') THEN 'Direct Grants' "
    "WHEN strategy_name = 'allov2.DirectAllocationStrategy' THEN 'Direct Donations' ELSE strategy_name END AS title, "
    "CASE WHEN strategy_name = '' THEN 'allov1.QF' ELSE strategy_name END AS filled FROM {order_rounds}",
)
def _(v):
    s = C("strategy_name")
    return v.order_rounds.select(
        "id", values.strategy_title(s).alias("title"), values.strategy_or_default(s).alias("filled")
    )


@check(
    "f9_checkout_chain",
    "SELECT voter_address, grant_id, checkout_type, COALESCE(CASE checkout_type WHEN 'eth_std' THEN 1 WHEN 'eth_polygon' THEN 137 WHEN 'eth_zksync' THEN 324 END, 0) AS chain_id FROM {past_contributions}",
)
def _(v):
    return v.past_contributions.select(
        "voter_address", "grant_id", "checkout_type", values.chain_of_checkout(C("checkout_type")).alias("chain_id")
    )


@check(
    "f10_coalesce",
    "SELECT id, COALESCE(match_amount_in_usd, 0) AS pool, COALESCE(donations_end_time, applications_start_time) AS time FROM {order_rounds}",
)
def _(v):
    return v.order_rounds.select(
        "id", values.null_to_zero(C("match_amount_in_usd")).alias("pool"),
        F.coalesce("donations_end_time", "applications_start_time").alias("time"),
    )


@check(
    "f11_safe_div",
    "SELECT id, CAST(total_amount_donated_in_usd AS DOUBLE) / NULLIF(unique_donors_count, 0) AS per_donor FROM {order_rounds}",
)
def _(v):
    per_donor = values.safe_div(C("total_amount_donated_in_usd"), C("unique_donors_count"))
    return v.order_rounds.select("id", per_donor.alias("per_donor"))


@check("f12_concat_null", "SELECT id, donor_address || '/' || CAST(chain_id AS STRING) AS joined FROM {donations}")
def _(v):
    return v.donations.select("id", text.concat_text(C("donor_address"), F.lit("/"), C("chain_id")).alias("joined"))


@check("f13_concat_skip_null", "SELECT id, concat('donor ', donor_address) AS joined FROM {donations}")
def _(v):
    return v.donations.select("id", text.concat_skip_null(F.lit("donor "), C("donor_address")).alias("joined"))


@check(
    "f14_row_hash",
    "SELECT id, sha256(donor_address || CAST(amount_in_usd AS STRING) || recipient_address || CAST(timestamp AS STRING) || round_id || CAST(chain_id AS STRING)) AS row_hash FROM {donations}",
)
def _(v):
    parts = ["donor_address", "amount_in_usd", "recipient_address", "timestamp", "round_id", "chain_id"]
    return v.donations.select("id", text.row_hash(*parts).alias("row_hash"))


@check(
    "f15_match_arithmetic",
    "SELECT id, CASE WHEN id = '0xa1d52f9b5339792651861329a046dd912761e9a9' THEN CAST(total_donations_count AS DOUBLE) * CAST(match_amount_in_usd AS DOUBLE) / 1000000000000 "
    "ELSE CAST(total_donations_count AS DOUBLE) * CAST(match_amount_in_usd AS DOUBLE) END AS usd FROM {order_rounds}",
)
def _(v):
    usd = values.match_usd(C("total_donations_count"), C("match_amount_in_usd"), C("id"))
    return v.order_rounds.select("id", usd.alias("usd"))


@check(
    "f16_money",
    "SELECT \"desc\", CAST(replace(replace(amount_in_usd, '$', ''), ',', '') AS DOUBLE) AS usd FROM {external_rounds}",
)
def _(v):
    return v.external_rounds.select("desc", values.money(C("amount_in_usd")).alias("usd"))


@check("f17_normalize_title", f"SELECT doc_id, {title_sql('text')} AS title FROM {{documents}}")
def _(v):
    return v.documents.select("doc_id", text.normalize_title(C("text")).alias("title"))


@check("f18_repo_owner", f"SELECT grantid, {owner_sql('github')} AS owner FROM {{past_grants}}")
def _(v):
    return v.past_grants.select("grantid", text.repo_owner(C("github")).alias("owner"))


@check("f19_lenient_timestamp", "SELECT \"desc\", TRY_CAST(timestamp AS TIMESTAMP) AS seen, TRY_CAST(network_name AS TIMESTAMP) AS bad FROM {external_rounds}")
def _(v):
    return v.external_rounds.select(
        "desc", times.lenient_ts(C("timestamp")).alias("seen"), times.lenient_ts(C("network_name")).alias("bad")
    )


@check("f20_version_number", "SELECT o_orderkey, CAST(substr(schema_name, 12) AS INT) AS version FROM {schema_names}")
def _(v):
    return v.schema_names.select("o_orderkey", times.version_of(C("schema_name")).alias("version"))


@check("f21_current_time", "SELECT event_id, ts < CAST(now() AS TIMESTAMP) AS past FROM {events}")
def _(v):
    return v.events.select("event_id", (C("ts") < times.now()).alias("past"))
