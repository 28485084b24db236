"""Checks of A1-A9, D1-D3, E1-E6 and N1-N4."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from fundlens.functions.values import credits_to_usd
from fundlens.operators import dedup, groups, linking, numbering
from fundlens.plans import base, gmv, ingest, projects


@check(
    "a1_sum_max",
    "SELECT chain_id, round_id, SUM(amount_in_usd) AS direct_grants_payout, MAX(timestamp) AS last_payout_time FROM {payouts} GROUP BY ALL",
)
def _(v):
    return groups.payout_totals(v.payouts)


@check(
    "a2_contribution_stats",
    "SELECT round_id, chain_id, CAST(SUM(voice_credit_balance) AS DOUBLE) / 100000 * 3000 AS usd, COUNT(DISTINCT contributor_address) AS unique_donors, "
    "COUNT(DISTINCT transaction_hash) AS transactions, MAX(timestamp) AS latest_contribution FROM {contributions} GROUP BY round_id, chain_id",
)
def _(v):
    return groups.contribution_stats(v.contributions)


@check(
    "a3_group_by_expressions",
    "SELECT CASE WHEN strategy_name = '' THEN 'allov1.QF' ELSE strategy_name END AS strategy, round_metadata->>'$.name' AS name, chain_id, "
    "COUNT(*) AS n, SUM(total_amount_donated_in_usd) AS total FROM {order_rounds} GROUP BY 1, 2, 3",
)
def _(v):
    name = F.get_json_object("round_metadata", "$.name").alias("name")
    keys = [gmv.strategy_or_default(F.col("strategy_name")).alias("strategy"), name, "chain_id"]
    return v.order_rounds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount_donated_in_usd").alias("total")
    )


@check(
    "a4_credits_to_usd",
    "SELECT contributor_address, CAST(SUM(voice_credit_balance) AS DOUBLE) / 100000 * 3000 AS usd FROM {contributions} GROUP BY contributor_address",
)
def _(v):
    return v.contributions.groupBy("contributor_address").agg(
        credits_to_usd(F.sum("voice_credit_balance")).alias("usd")
    )


@check(
    "a5_control_total",
    "SELECT COALESCE(SUM(total_amount_donated_in_usd + CASE WHEN matching_distribution IS NOT NULL THEN match_amount_in_usd ELSE 0 END), 0) AS total FROM {order_rounds}",
)
def _(v):
    return groups.control_total(v.order_rounds, base.base_specs()["rounds"].amount)


@check("a6_row_count", "SELECT COUNT(*) AS row_count FROM {donations}")
def _(v):
    return groups.row_count(v.donations)


PROFILES = "SELECT CAST(p_size AS STRING) AS group_id, p_name AS project_id, CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS amount_donated, CASE WHEN p_size % 3 = 0 THEN NULL ELSE TIMESTAMP '2020-01-01 00:00:00' + DAYS_INTERVAL(p_partkey % 500) END AS created_at FROM {part}"


@check(
    "a7_group_summary",
    f"SELECT group_id, COALESCE(SUM(amount_donated), 0) AS total_amount_donated, MAX(created_at) AS latest_created_application, COUNT(project_id) AS application_count FROM ({PROFILES}) p GROUP BY group_id",
)
def _(v):
    return groups.group_summary(v.sql(PROFILES))


@check(
    "a8_historical_profile_totals",
    "SELECT CAST(g.grantid AS STRING) AS project_id, g.name AS title, SUM(c.amountUSD) AS amount_donated, MAX(c.created_on) AS last_donation "
    "FROM {past_grants} g LEFT JOIN {past_contributions} c ON c.grant_id = g.grantid GROUP BY g.grantid, g.name",
)
def _(v):
    rows = projects.historical_profiles(v.past_grants, v.past_contributions)
    return rows.select("project_id", "title", "amount_donated", "last_donation")


@check("a9_distinct_pairs", "SELECT DISTINCT donor_address, chain_id FROM {donations}")
def _(v):
    return v.donations.select("donor_address", "chain_id").distinct()


DEDUP = """
SELECT id, chain_id, round_id, application_id, donor_address, recipient_address, amount, token_address, amount_in_usd,
  transaction_hash, timestamp, source{extra}
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY source, chain_id NULLS LAST, round_id NULLS LAST, application_id NULLS LAST,
    donor_address NULLS LAST, recipient_address NULLS LAST, amount NULLS LAST, token_address NULLS LAST, amount_in_usd NULLS LAST,
    transaction_hash NULLS LAST, timestamp NULLS LAST) AS row_num
  FROM (SELECT *, 'indexer' AS source FROM {{donations}} WHERE chain_id <> 11155111
        UNION ALL SELECT *, 'static' FROM {{old_donations}} WHERE chain_id <> 11155111) both_sources
) ranked WHERE row_num = 1"""


def _sources(v):
    return {"indexer": v.donations, "static": v.old_donations}


@check("d1_priority_dedup", DEDUP.format(extra=""))
def _(v):
    kept = {name: df.where(F.col("chain_id") != 11155111) for name, df in _sources(v).items()}
    return dedup.dedup_by_priority(kept, ["id"], ["indexer", "static"])


@check("n1_rank_by_priority", DEDUP.format(extra=", row_num"))
def _(v):
    tagged = [df.where(F.col("chain_id") != 11155111).withColumn("source", F.lit(n)) for n, df in _sources(v).items()]
    return dedup.rank_by_priority(tagged[0].unionByName(tagged[1]), ["id"], ["indexer", "static"])


@check(
    "d2_latest_per_group",
    "SELECT p_brand, p_partkey, seen FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY seen DESC NULLS FIRST, p_partkey DESC) AS rn "
    "FROM (SELECT p_brand, p_partkey, CASE WHEN p_size % 45 = 0 THEN NULL ELSE p_size END AS seen FROM {part}) p) r WHERE rn = 1",
)
def _(v):
    seen = F.when(F.col("p_size") % 45 != 0, F.col("p_size")).alias("seen")
    return dedup.latest_per_group(v.part.select("p_brand", "p_partkey", seen), "p_brand", "seen", "p_partkey")


@check(
    "d3_duplicate_keys",
    "SELECT id, chain_id, COUNT(*) AS copies FROM {donations} GROUP BY id, chain_id HAVING COUNT(*) > 1",
)
def _(v):
    return dedup.duplicate_keys(v.donations, ["id", "chain_id"])


WS = r"\x09-\x0d\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}"


def title_sql(expr: str) -> str:
    kept = rf"regexp_replace(lower({expr}), '[^\p{{{{L}}}}\p{{{{N}}}}_{WS}]', '', 'g')"
    return f"trim(regexp_replace({kept}, '[{WS}]+', ' ', 'g'))"


def owner_sql(expr: str) -> str:
    return f"split_part(replace(replace(lower({expr}), 'https://github.com/', ''), 'http://github.com/', ''), '/', 1)"


def blank(expr: str) -> str:
    return f"CASE WHEN trim({expr}) <> '' THEN {expr} END"


PROFILE_SQL = f"""
SELECT project_id, {title_sql('title')} AS title, {blank('website')} AS website, payout_address,
  {blank('lower(project_twitter)')} AS project_twitter, {blank(owner_sql('project_github'))} AS project_github,
  created_at, amount_donated, last_donation, source
FROM (
  SELECT CAST(g.grantid AS STRING) AS project_id, g.name AS title, g.websiteurl AS website, lower(g.payoutaddress) AS payout_address,
    g.twitter AS project_twitter, g.github AS project_github, g.createdon AS created_at, CAST(c.total AS DOUBLE) AS amount_donated,
    c.latest AS last_donation, 'cGrants' AS source
  FROM {{past_grants}} g LEFT JOIN (SELECT grant_id, SUM(amountUSD) AS total, MAX(created_on) AS latest FROM {{past_contributions}} GROUP BY grant_id) c
    ON c.grant_id = g.grantid
  UNION ALL
  SELECT project_id, j->>'$.project.title', j->>'$.project.website', lower(j->>'$.recipient'), j->>'$.project.projectTwitter',
    j->>'$.project.projectGithub', make_timestamp(CAST(j->>'$.project.createdAt' AS BIGINT) // 1000 * 1000000), total_amount_donated_in_usd, NULL, 'indexer'
  FROM (SELECT *, metadata->'$.application' AS j FROM {{applications}} WHERE chain_id <> 11155111) a
) raw
WHERE regexp_matches(payout_address, '^0x[a-f0-9]{{{{40}}}}$') AND {title_sql('title')} <> ''"""


def profiles_of(v):
    return projects.normalize_projects(
        projects.historical_profiles(v.past_grants, v.past_contributions).withColumn(
            "amount_donated", F.col("amount_donated").cast("double")
        ),
        projects.indexed_profiles(v.applications),
    )


@check("e1_normalize_profiles", PROFILE_SQL)
def _(v):
    return profiles_of(v)


@check(
    "e2_shared_attribute_groups",
    "SELECT attribute, value, COUNT(*) AS members, COUNT(*) * (COUNT(*) - 1) // 2 AS pairs FROM ("
    "SELECT 'p_name' AS attribute, p_name AS value FROM {part} UNION ALL SELECT 'p_brand', p_brand FROM {part} "
    "UNION ALL SELECT 'p_type', p_type FROM {part} UNION ALL SELECT 'p_size', CAST(p_size AS STRING) FROM {part}) a "
    "WHERE value IS NOT NULL GROUP BY attribute, value HAVING COUNT(*) > 1",
)
def _(v):
    return linking.shared_attribute_groups(v.part, PART_ATTRIBUTES)


PART_ATTRIBUTES = ["p_name", "p_brand", "p_type", "p_size"]
PART_KEYS = """
keyed AS (
  SELECT p_partkey AS node, 1 AS kind, p_name AS a, p_brand AS b, p_type AS c FROM {part}
  UNION ALL SELECT p_partkey, 2, p_name, p_brand, CAST(p_size AS STRING) FROM {part}
  UNION ALL SELECT p_partkey, 3, p_name, p_type, CAST(p_size AS STRING) FROM {part}
  UNION ALL SELECT p_partkey, 4, p_brand, p_type, CAST(p_size AS STRING) FROM {part}
),
links AS (
  SELECT DISTINCT node AS src, least_node AS dst
  FROM (SELECT node, MIN(node) OVER (PARTITION BY kind, a, b, c) AS least_node FROM keyed) k WHERE node <> least_node
)"""


@check("e3_k_of_n_links", f"WITH {PART_KEYS} SELECT src, dst FROM links")
def _(v):
    return linking.k_of_n_links(v.part, PART_ATTRIBUTES, 3, "p_partkey")


REACH = """
both_ways AS (SELECT src, dst FROM links UNION SELECT dst, src FROM links),
reach AS (
  SELECT p_partkey AS node, p_partkey AS seen FROM {part}
  UNION SELECT r.node, e.dst FROM reach r JOIN both_ways e ON e.src = r.seen
),
components AS (SELECT node, MIN(seen) AS component FROM reach GROUP BY node)"""


@check(
    "e4_connected_components",
    f"WITH RECURSIVE {PART_KEYS}, {REACH} SELECT node AS p_partkey, component FROM components",
)
def _(v):
    edges = linking.k_of_n_links(v.part, PART_ATTRIBUTES, 3, "p_partkey")
    return linking.connected_components(edges, v.part, "p_partkey")


@check(
    "e5_group_ids",
    f"WITH RECURSIVE {PART_KEYS}, {REACH} SELECT node AS row_id, CAST(DENSE_RANK() OVER (ORDER BY component) - 1 AS STRING) AS group_id FROM components",
)
def _(v):
    edges = linking.k_of_n_links(v.part, PART_ATTRIBUTES, 3, "p_partkey")
    return projects.assign_group_ids(
        linking.connected_components(edges, v.part, "p_partkey").withColumnRenamed("p_partkey", "row_id")
    )


def grouped_sql(tail: str) -> str:
    """Project groups in SQL: distinct attribute tuples are the nodes, rows join back at the end."""
    subsets = [
        ("title", "website", "payout_address"), ("title", "website", "project_twitter"),
        ("title", "website", "project_github"), ("title", "payout_address", "project_twitter"),
        ("title", "payout_address", "project_github"), ("title", "project_twitter", "project_github"),
        ("website", "payout_address", "project_twitter"), ("website", "payout_address", "project_github"),
        ("website", "project_twitter", "project_github"), ("payout_address", "project_twitter", "project_github"),
    ]
    keyed = " UNION ALL ".join(
        f"SELECT node, {i} AS kind, {a} AS a, {b} AS b, {c} AS c FROM tuples "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {c} IS NOT NULL"
        for i, (a, b, c) in enumerate(subsets)
    )
    same = " AND ".join(
        f"p.{c} IS NOT DISTINCT FROM t.{c}"
        for c in ["title", "website", "payout_address", "project_twitter", "project_github"]
    )
    return f"""WITH RECURSIVE profiles AS ({PROFILE_SQL}),
numbered AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY source NULLS LAST, project_id NULLS LAST, title NULLS LAST, website NULLS LAST,
    payout_address NULLS LAST, project_twitter NULLS LAST, project_github NULLS LAST, created_at NULLS LAST,
    amount_donated NULLS LAST, last_donation NULLS LAST) AS row_id FROM profiles
),
tuples AS (
  SELECT title, website, payout_address, project_twitter, project_github, MIN(row_id) AS node FROM numbered GROUP BY ALL
),
keyed AS ({keyed}),
links AS (
  SELECT DISTINCT node AS src, least_node AS dst
  FROM (SELECT node, MIN(node) OVER (PARTITION BY kind, a, b, c) AS least_node FROM keyed) k WHERE node <> least_node
),
both_ways AS (SELECT src, dst FROM links UNION SELECT dst, src FROM links),
reach AS (SELECT node, node AS seen FROM tuples UNION SELECT r.node, e.dst FROM reach r JOIN both_ways e ON e.src = r.seen),
components AS (SELECT node, MIN(seen) AS component FROM reach GROUP BY node),
grouped AS (
  SELECT p.*, CAST(DENSE_RANK() OVER (ORDER BY k.component) - 1 AS STRING) AS group_id
  FROM numbered p JOIN tuples t ON {same} JOIN components k ON k.node = t.node
)
{tail}"""


def grouped_of(v):
    """Rows without three known attributes have no key, so equal ones stay apart; none occur in these views."""
    return projects.grouped_projects(profiles_of(v))


@check("e6_project_lookup", grouped_sql("SELECT group_id, project_id, source FROM grouped"))
def _(v):
    return projects.project_lookup(grouped_of(v))


@check(
    "n2_round_operators",
    "SELECT chain_id, round_id, address, 'round_operator' AS role, COUNT(address) OVER (PARTITION BY chain_id, round_id) AS count_addresses "
    "FROM (SELECT DISTINCT chain_id, round_id, address FROM {roles}) r",
)
def _(v):
    return groups.round_operators(v.roles)


@check(
    "n3_split_count",
    "SELECT strategy_name, chain_id, id, COUNT(*) OVER (PARTITION BY strategy_name, chain_id) AS address_count FROM {order_rounds}",
)
def _(v):
    return groups.with_split_count(v.order_rounds.select("strategy_name", "chain_id", "id"), ["strategy_name", "chain_id"])


@check(
    "n4_number_rows",
    "SELECT tx_timestamp, role, address, gmv, blockchain, tx_hash, strategy_name, ROW_NUMBER() OVER (ORDER BY tx_timestamp, role, address, gmv, "
    "blockchain, tx_hash, strategy_name NULLS LAST) AS row_number FROM {external_events}",
)
def _(v):
    return numbering.number_rows(v.external_events, ingest.EVENT_ORDER)
