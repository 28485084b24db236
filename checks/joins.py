"""Checks of J1-J14."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from fundlens import constants as K
from fundlens.functions.text import json_text
from fundlens.operators import groups, joins
from fundlens.plans import rounds as round_jobs
from fundlens.sources.readers import chain_mapping

SLUGS = "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in K.CHAIN_SLUGS) + ") AS slug(chain_id, chain_name)"
TITLES = "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in K.CHAIN_TITLES) + ") AS title(chain_id, chain_name)"


@check(
    "j1_join_applications",
    "SELECT d.id, d.amount_in_usd, a.project_id, a.status FROM {donations} d JOIN {applications} a "
    "ON (a.id, a.round_id, a.chain_id) = (d.application_id, d.round_id, d.chain_id)",
)
def _(v):
    grants = v.applications.select(F.col("id").alias("application_id"), "round_id", "chain_id", "project_id", "status")
    given = v.donations.select("id", "amount_in_usd", "application_id", "round_id", "chain_id")
    return joins.join_applications(given, grants).select("id", "amount_in_usd", "project_id", "status")


@check(
    "j2_registry_both_lowered",
    "SELECT a.id, a.round_id, a.chain_id, g.round_number AS round_num FROM {applications} a LEFT JOIN {registry} g "
    "ON lower(g.round_id) = lower(a.round_id) AND g.chain_id = a.chain_id",
)
def _(v):
    return joins.attach_registry(v.applications.select("id", "round_id", "chain_id"), v.registry)


@check(
    "j2_round_name_one_lowered",
    "SELECT a.id, a.round_id, a.chain_id, r.round_metadata->>'$.name' AS round_name FROM {applications} a "
    "LEFT JOIN {rounds} r ON r.id = lower(a.round_id) AND r.chain_id = a.chain_id",
)
def _(v):
    return joins.attach_round_name(v.applications.select("id", "round_id", "chain_id"), v.rounds)


@check(
    "j2_round_labels_in_one_join",
    "SELECT a.id, a.round_id, a.chain_id, g.round_number AS round_num, r.round_metadata->>'$.name' AS round_name FROM {applications} a "
    "LEFT JOIN {registry} g ON lower(g.round_id) = lower(a.round_id) AND g.chain_id = a.chain_id "
    "LEFT JOIN {rounds} r ON r.id = lower(a.round_id) AND r.chain_id = a.chain_id",
)
def _(v):
    return joins.attach_round_labels(v.applications.select("id", "round_id", "chain_id"), v.registry, v.rounds)


@check(
    "j3_chain_name",
    f"SELECT d.id, d.chain_id, slug.chain_name AS blockchain FROM {{donations}} d LEFT JOIN {SLUGS} ON slug.chain_id = d.chain_id",
)
def _(v):
    return joins.attach_chain_name(v.donations.select("id", "chain_id"), chain_mapping(v.spark))


@check(
    "j4_chain_id",
    f"SELECT e.tx_hash, e.blockchain, slug.chain_id FROM {{external_events}} e LEFT JOIN {SLUGS} ON slug.chain_name = e.blockchain",
)
def _(v):
    return joins.attach_chain_id(v.external_events.select("tx_hash", "blockchain"), chain_mapping(v.spark))


@check(
    "j5_range_join",
    "SELECT c.voter_address, c.grant_id, c.created_on, t.round_num FROM {past_contributions} c "
    "LEFT JOIN {timings} t ON c.created_on > t.start_date AND c.created_on < t.end_date",
)
def _(v):
    rows = v.past_contributions.select("voter_address", "grant_id", "created_on")
    return joins.assign_round_by_time(rows, v.timings, "created_on")


@check(
    "j6_attach_application",
    "SELECT p.id, p.application_id, a.metadata->>'$.application.project.title' AS project_name "
    "FROM {payouts} p LEFT JOIN {applications} a ON a.chain_id = p.chain_id AND a.round_id = p.round_id AND a.id = p.application_id",
)
def _(v):
    title = json_text(F.col("metadata"), "application", "project", "title")
    rows = joins.attach_application(v.payouts, v.applications, {"project_name": title}, "application_id")
    return rows.select("id", "application_id", "project_name")


@check(
    "j7_attach_aggregates",
    "SELECT r.id, r.chain_id, s.direct_grants_payout, s.last_payout_time FROM {rounds} r LEFT JOIN "
    "(SELECT chain_id, round_id, SUM(amount_in_usd) AS direct_grants_payout, MAX(timestamp) AS last_payout_time "
    "FROM {payouts} GROUP BY ALL) s ON s.chain_id = r.chain_id AND s.round_id = r.id",
)
def _(v):
    keys = {"chain_id": "chain_id", "id": "round_id"}
    return joins.attach_stats(v.rounds.select("id", "chain_id"), groups.payout_totals(v.payouts), keys)


@check(
    "j8_restrict_to_strategy",
    "SELECT d.id, d.round_id, d.amount_in_usd FROM {donations} d WHERE EXISTS (SELECT 1 FROM {rounds} r "
    "WHERE r.strategy_name = 'allov2.DirectAllocationStrategy' AND r.id = d.round_id AND r.chain_id = d.chain_id)",
)
def _(v):
    kept = joins.restrict_to_rounds(v.donations, v.rounds, K.DIRECT_ALLOCATION_V2)
    return kept.select("id", "round_id", "amount_in_usd")


@check(
    "j9_attach_program",
    "SELECT t.\"Chain ID\", t.\"Round ID\", p.program FROM (SELECT CAST(chain_id AS STRING) AS \"Chain ID\", id AS \"Round ID\" FROM {rounds} "
    "UNION ALL SELECT '0', '0' FROM {external_rounds}) t LEFT JOIN (SELECT program, chain_id, lower(round_id) AS round_id "
    "FROM {registry} WHERE round_number IS NOT NULL) p ON p.chain_id = CAST(t.\"Chain ID\" AS INT) AND p.round_id = t.\"Round ID\"",
)
def _(v):
    known = v.rounds.select(F.col("chain_id").cast("string").alias("Chain ID"), F.col("id").alias("Round ID"))
    unknown = v.external_rounds.select(F.lit("0").alias("Chain ID"), F.lit("0").alias("Round ID"))
    return joins.attach_program(known.unionByName(unknown), round_jobs.programs(v.registry))


@check(
    "j10_split_credit",
    "SELECT d.id, o.address, d.amount_in_usd, CAST(d.amount_in_usd AS DOUBLE) / o.n AS gmv FROM {donations} d LEFT JOIN "
    "(SELECT chain_id, round_id, address, COUNT(*) OVER (PARTITION BY chain_id, round_id) AS n "
    "FROM (SELECT DISTINCT chain_id, round_id, address FROM {roles})) o ON o.chain_id = d.chain_id AND o.round_id = d.round_id",
)
def _(v):
    shares = groups.round_operators(v.roles).drop("role")
    rows = joins.split_credit(v.donations, shares, ["chain_id", "round_id"], "amount_in_usd", "count_addresses")
    return rows.select("id", "address", "amount_in_usd", "gmv")


@check(
    "j11_explode_distribution",
    "SELECT r.id, e.applicationId AS application_id, e.matchPoolPercentage AS pct FROM {order_rounds} r, "
    "unnest(from_json(r.matching_distribution->'$.matchingDistribution', '[{{\"applicationId\":\"VARCHAR\",\"matchPoolPercentage\":\"VARCHAR\"}}]')) AS u(e)",
)
def _(v):
    rows = joins.explode_distribution(v.order_rounds)
    return rows.select("id", F.col("entry.applicationId").alias("application_id"), F.col("entry.matchPoolPercentage").alias("pct"))


@check(
    "j12_attach_names",
    "SELECT d.id, d.donor_address AS address, n.name FROM {donations} d LEFT JOIN {names} n ON n.address = d.donor_address",
)
def _(v):
    return joins.attach_names(v.donations.select("id", F.col("donor_address").alias("address")), v.names)


@check(
    "j13_group_totals",
    "SELECT id, donor_address, SUM(amount_in_usd) OVER (PARTITION BY donor_address) AS donor_total, "
    "COUNT(*) OVER (PARTITION BY donor_address) AS donor_rows FROM {donations}",
)
def _(v):
    aggs = {"donor_total": F.sum("amount_in_usd"), "donor_rows": F.count(F.lit(1))}
    return groups.with_group_totals(v.donations.select("id", "donor_address", "amount_in_usd"), ["donor_address"], aggs).drop(
        "amount_in_usd"
    )


@check(
    "j14_attach_payout_address",
    "SELECT d.title, d.usd_amount, a.address AS recipient_address FROM {alpha_donations} d LEFT JOIN {alpha_addresses} a ON a.title = d.title",
)
def _(v):
    rows = v.alpha_donations.select("title", "usd_amount")
    return joins.attach_payout_address(rows, v.alpha_addresses, "title", "title", {"recipient_address": "address"})
