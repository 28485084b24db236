"""Checks of T1-T9, C1-C4, V1 and V2."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.aggregates import DEDUP, grouped_of, grouped_sql
from checks.joins import SLUGS, TITLES
from checks.registry import check
from fundlens import constants as K
from fundlens.functions.text import json_text
from fundlens.operators import groups
from fundlens.plans import audit, base, donations, gmv, ingest, matching, projects, refresh, rounds
from fundlens.session import staging_path
from fundlens.sources.readers import chain_mapping
from fundlens.sources.writers import read_manifest

NOW = datetime(2030, 1, 1)

# --- T1: base tables -------------------------------------------------------------


@check("t1_base_donations", DEDUP.format(extra=""))
def _(v):
    return base.base_table("donations", {"indexer": v.donations, "static": v.old_donations})


ROUND_COLUMNS = [
    "id", "chain_id", "round_metadata", "strategy_id", "strategy_name", "matching_distribution", "match_amount_in_usd",
    "total_amount_donated_in_usd", "total_donations_count", "unique_donors_count", "donations_end_time",
    "applications_start_time",
]


BASE_ROUNDS = (
    f"SELECT {', '.join(ROUND_COLUMNS)}, 'indexer' AS source FROM {{rounds}} WHERE chain_id <> 11155111 "
    f"UNION ALL SELECT {', '.join('o.' + c for c in ROUND_COLUMNS)}, 'static' FROM {{old_rounds}} o "
    "WHERE chain_id <> 11155111 AND NOT EXISTS (SELECT 1 FROM {rounds} r WHERE r.id = o.id AND r.chain_id = o.chain_id)"
)


@check("t1_base_rounds", BASE_ROUNDS)
def _(v):
    return base.base_tables({"rounds": {"indexer": v.rounds, "static": v.old_rounds}})["rounds"]


BASE_APPLICATIONS = "SELECT *, 'indexer' AS source FROM {applications} WHERE chain_id <> 11155111"


@check("t1_base_applications", BASE_APPLICATIONS)
def _(v):
    # Same keys in both sources: every row of the preferred one stays, none of the other.
    return base.base_table("applications", {"static": v.applications.withColumn("status", F.lit("OLD")), "indexer": v.applications})


BASE_PAYOUTS = (
    "SELECT id, chain_id, round_id, application_id, amount_in_usd, timestamp, transaction_hash, source FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id "
    "ORDER BY source, chain_id, round_id, application_id, amount_in_usd, timestamp, transaction_hash) AS rn "
    "FROM (SELECT *, 'indexer' AS source FROM {payouts} UNION ALL SELECT *, 'static' FROM {old_payouts}) p WHERE chain_id <> 11155111) r WHERE rn = 1"
)


@check("t1_base_payouts", BASE_PAYOUTS)
def _(v):
    return base.base_table("applications_payouts", {"indexer": v.payouts, "static": v.old_payouts})


BASE_ROLES = (
    "SELECT chain_id, round_id, address, role, MIN(source) AS source FROM (SELECT *, 'indexer' AS source FROM {roles} UNION ALL SELECT *, 'static' FROM {old_roles}) r "
    "WHERE chain_id <> 11155111 GROUP BY chain_id, round_id, address, role"
)


@check("t1_base_round_roles", BASE_ROLES)
def _(v):
    return base.base_table("round_roles", {"indexer": v.roles, "static": v.old_roles})


# --- T2, T4, T6: matching --------------------------------------------------------


def payouts_sql(view: str) -> str:
    fields = [
        "projectId", "projectName", "applicationId", "contributionsCount", "matchAmountInToken", "matchPoolPercentage",
        "projectPayoutAddress", "originalMatchAmountInToken",
    ]
    shape = ",".join(f'"{f}":"VARCHAR"' for f in fields)
    return f"""
SELECT id AS round_id, chain_id, round_metadata->>'$.name' AS round_name,
  strptime(matching_distribution->>'$.blockTimestamp', '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp,
  e.projectId AS project_id, e.projectName AS project_name, e.applicationId AS application_id,
  e.contributionsCount AS contributions_count, e.matchAmountInToken AS match_amount_in_token,
  e.matchPoolPercentage AS match_pool_percentage, e.projectPayoutAddress AS project_payout_address,
  e.originalMatchAmountInToken AS original_match_amount_in_token,
  CAST(e.matchPoolPercentage AS DOUBLE) * CAST(match_amount_in_usd AS DOUBLE)
    / CASE WHEN id = '{K.RESCALED_ROUND_ID}' THEN 1000000000000 ELSE 1 END AS match_amount_in_usd
FROM (SELECT *, unnest(from_json(matching_distribution->'$.matchingDistribution', '[{{{{{shape}}}}}]')) AS e
      FROM {{{view}}} WHERE chain_id <> 11155111) x"""


@check("t2_matching_payouts", payouts_sql("rounds"))
def _(v):
    return matching.matching_payouts(v.rounds)


@check("t2_matching_payouts_per_order", payouts_sql("order_rounds"))
def _(v):
    return matching.matching_payouts(v.order_rounds)


HISTORICAL_MATCHING = """
SELECT m.round_num, m.title, m.match_amount_dai AS match_amount_usd, a.address AS payoutaddress, 'unknown' AS project_id,
  m.sub_round_slug AS round_id, 1 AS chain_id, TIMESTAMP '2023-04-01 00:00:00' AS timestamp
FROM {alpha_matching} m LEFT JOIN {alpha_addresses} a USING (title)
UNION
SELECT p.round_num, g.name, p.match_amount, g.payoutaddress, CAST(g.grantid AS STRING), p.sub_round_slug, 1, CAST(p.payout_tx_date AS TIMESTAMP)
FROM {past_matching} p LEFT JOIN {past_grants} g ON g.grantid = p.grant_id"""


@check("t6_historical_matching", HISTORICAL_MATCHING)
def _(v):
    return matching.historical_matching(v.alpha_matching, v.alpha_addresses, v.past_matching, v.past_grants)


MATCHING_HASH = (
    "sha256({lead}title || CAST(CAST(match_amount_in_usd AS DECIMAL(18,2)) AS STRING) || recipient_address || project_id "
    "|| round_id || CAST(chain_id AS STRING))"
)


def matching_sql(view: str) -> str:
    return f"""WITH paid AS ({payouts_sql(view)}),
past AS ({HISTORICAL_MATCHING}),
indexed AS (
  SELECT g.round_number AS round_num, p.project_name AS title, p.match_amount_in_usd, p.project_payout_address AS recipient_address,
    p.project_id, p.round_id, p.chain_id, p.timestamp
  FROM paid p LEFT JOIN {{registry}} g ON g.chain_id = p.chain_id AND lower(g.round_id) = p.round_id
),
historical AS (
  SELECT round_num, title, CAST(match_amount_usd AS DOUBLE) AS match_amount_in_usd, payoutaddress AS recipient_address, project_id,
    round_id, chain_id, timestamp FROM past
)
SELECT {MATCHING_HASH.format(lead='')} AS matching_id, * FROM indexed
UNION SELECT {MATCHING_HASH.format(lead='round_num || ')}, * FROM historical"""


@check("t4_all_matching", matching_sql("order_rounds"))
def _(v):
    past = matching.historical_matching(v.alpha_matching, v.alpha_addresses, v.past_matching, v.past_grants)
    return matching.all_matching(matching.matching_payouts(v.order_rounds), v.registry, past)


# --- T3, T5: donations -----------------------------------------------------------


ALL_DONATIONS = """WITH granted AS (
  SELECT a.id, a.round_id, a.chain_id, a.project_id, g.round_number AS num, r.round_metadata->>'$.name' AS round_name,
    a.metadata->>'$.application.project.title' AS project_name, a.metadata->>'$.application.recipient' AS recipient_address
  FROM {applications} a
  LEFT JOIN {registry} g ON lower(g.round_id) = lower(a.round_id) AND g.chain_id = a.chain_id
  LEFT JOIN {rounds} r ON r.id = lower(a.round_id) AND r.chain_id = a.chain_id
),
everything AS (
  SELECT CAST(g.num AS INT) AS round_num, g.round_name, d.donor_address, d.amount_in_usd, g.recipient_address, d.timestamp, g.project_name,
    g.project_id, g.round_id, g.chain_id, 'GrantsStack' AS source
  FROM {donations} d JOIN granted g ON g.id = d.application_id AND g.round_id = d.round_id AND g.chain_id = d.chain_id
  WHERE d.chain_id <> 11155111
  UNION SELECT round_num, round_name, donor_address, amount_in_usd, recipient_address, timestamp, project_name, project_id, round_id, chain_id, source
  FROM {static_donations}
)
SELECT sha256(CAST(round_num AS STRING) || donor_address || CAST(amount_in_usd AS STRING) || recipient_address || CAST(timestamp AS STRING)
  || project_id || round_id || CAST(chain_id AS STRING)) AS donation_id, * FROM everything"""


@check("t3_all_donations", ALL_DONATIONS)
def _(v):
    return donations.all_donations(v.donations, v.applications, v.rounds, v.registry, v.static_donations)


@check(
    "t5_historical_donations",
    f"""WITH given AS (
  SELECT c.*, t.round_num, g.name, g.payoutaddress FROM {{past_contributions}} c
  LEFT JOIN {{timings}} t ON t.start_date < c.created_on AND c.created_on < t.end_date
  LEFT JOIN {{past_grants}} g ON g.grantid = c.grant_id
)
SELECT round_num, concat('{K.CONTRIBUTION_ROUND_PREFIX}', round_num) AS round_name, lower(voter_address) AS donor_address, amountUSD AS amount_in_usd,
  payoutaddress AS recipient_address, created_on AS timestamp, name AS project_name, CAST(grant_id AS STRING) AS project_id,
  CAST(100000 + round_num AS STRING) AS round_id,
  COALESCE(CASE checkout_type WHEN 'eth_std' THEN 1 WHEN 'eth_polygon' THEN 137 WHEN 'eth_zksync' THEN 324 END, 0) AS chain_id, 'CGrants' AS source
FROM given
UNION
SELECT 16, d.round_name, concat('0', lower(substr(d.donor, 2))), d.usd_amount, a.address, d.block_time, d.title, 'unknown', '', 1, 'Alpha'
FROM {{alpha_donations}} d LEFT JOIN {{alpha_addresses}} a USING (title)""",
)
def _(v):
    return donations.historical_donations(
        v.alpha_donations, v.alpha_addresses, v.past_contributions, v.timings, v.past_grants
    )


# --- T7: attributed value --------------------------------------------------------

OPERATORS = """
SELECT chain_id, round_id, address, COUNT(address) OVER (PARTITION BY chain_id, round_id) AS n
FROM (SELECT DISTINCT chain_id, round_id, address FROM {%s}) people"""

BY_TX = f"""
SELECT d.chain_id, slug.chain_name AS blockchain, d.round_id,
  CASE WHEN r.strategy_name = '' THEN 'allov1.QF' ELSE r.strategy_name END AS strategy_name, r.round_metadata->>'$.name' AS round_name,
  d.transaction_hash AS tx_hash, d.timestamp AS tx_timestamp, SUM(d.amount_in_usd) AS total_amount_in_usd
FROM {{donations}} d LEFT JOIN {{rounds}} r ON r.id = d.round_id AND r.chain_id = d.chain_id LEFT JOIN {SLUGS} ON slug.chain_id = d.chain_id
GROUP BY ALL"""

DONATION_DEVS = f"""
SELECT strategy_name, blockchain, unnest(devs) AS dev_address, len(devs) AS address_count FROM (
  SELECT strategy_name, blockchain, list_concat(
    [CASE WHEN strategy_name IN ('allov2.DonationVotingMerkleDistributionDirectTransferStrategy', 'allov2.DirectAllocationStrategy') THEN '{K.DEV_V2}'
          WHEN strategy_name = 'allov1.QF' AND blockchain = 'optimism' THEN '{K.DEV_V1_OPTIMISM}' ELSE '{K.DEV_DEFAULT}' END],
    CASE WHEN strategy_name = 'allov2.DonationVotingMerkleDistributionDirectTransferStrategy' THEN ['{K.DEV_VOTING}']
         WHEN strategy_name = 'allov1.QF' AND blockchain = 'ethereum' THEN ['{K.DEV_V1_OPTIMISM}'] ELSE [] END) AS devs
  FROM (SELECT DISTINCT strategy_name, blockchain FROM by_tx) pairs WHERE blockchain IS NOT NULL AND strategy_name <> ''
) listed"""

DISTRIBUTION_DEVS = f"""
SELECT strategy_name, blockchain, unnest(devs) AS dev_address, len(devs) AS address_count FROM (
  SELECT strategy_name, blockchain, list_concat(
    [CASE WHEN strategy_name IN ('allov2.DonationVotingMerkleDistributionDirectTransferStrategy', 'allov2.DirectGrantsLiteStrategy') THEN '{K.DEV_V2}'
          WHEN strategy_name IN ('allov1.QF', 'allov1.Direct') AND blockchain = 'optimism' THEN '{K.DEV_V1_OPTIMISM}' ELSE '{K.DEV_DEFAULT}' END],
    CASE WHEN strategy_name IN ('allov1.QF', 'allov1.Direct') AND blockchain = 'ethereum' THEN ['{K.DEV_V1_OPTIMISM}'] ELSE [] END) AS devs
  FROM (SELECT DISTINCT strategy_name, blockchain FROM granted) pairs WHERE blockchain IS NOT NULL AND strategy_name IS NOT NULL
) listed"""

DISTRIBUTION = f"""
SELECT p.chain_id, p.round_id, p.round_name, COALESCE(p.timestamp, r.donations_end_time) AS timestamp, p.project_name,
  p.project_payout_address AS recipient_address, a.distribution_transaction AS transaction_hash,
  CAST(p.match_amount_in_usd AS DECIMAL(28,8)) AS amount_in_usd, r.strategy_id, r.strategy_name, 'matching' AS source_type
FROM ({payouts_sql('rounds')}) p JOIN {{rounds}} r ON r.id = p.round_id AND r.chain_id = p.chain_id
LEFT JOIN {{applications}} a ON a.chain_id = p.chain_id AND a.round_id = p.round_id AND a.id = p.application_id
UNION ALL
SELECT o.chain_id, o.round_id, r.round_metadata->>'$.name', o.timestamp, a.metadata->>'$.application.project.title',
  a.metadata->>'$.application.recipient', o.transaction_hash, CAST(o.amount_in_usd AS DECIMAL(28,8)), r.strategy_id, r.strategy_name, 'direct'
FROM {{payouts}} o LEFT JOIN {{rounds}} r ON r.id = o.round_id AND r.chain_id = o.chain_id
LEFT JOIN {{applications}} a ON a.chain_id = o.chain_id AND a.round_id = o.round_id AND a.id = o.application_id
WHERE o.amount_in_usd > 0"""

GRANTED = f"""
SELECT slug.chain_name AS blockchain, b.chain_id, b.round_name AS pool_name, b.round_id, b.timestamp AS tx_timestamp,
  b.transaction_hash AS tx_hash, b.recipient_address AS address, b.strategy_name, 'grantee' AS role, b.amount_in_usd AS gmv
FROM base b LEFT JOIN {SLUGS} ON slug.chain_id = b.chain_id"""

VOICE = f"""
SELECT c.round_id, c.chain_id, slug.chain_name AS blockchain, c.contributor_address, c.transaction_hash AS tx_hash, r.round_metadata->>'$.name' AS pool_name,
  SUM(c.voice_credit_balance) AS credits, MAX(c.timestamp) AS tx_timestamp
FROM {{contributions}} c LEFT JOIN {{maci_rounds}} r ON r.id = c.round_id AND r.chain_id = c.chain_id LEFT JOIN {SLUGS} ON slug.chain_id = c.chain_id
GROUP BY ALL"""

OUT = "blockchain, chain_id, pool_name, round_id, tx_timestamp, tx_hash, address, strategy_name, role, gmv"

DONATION_OPERATOR_ROWS = """
SELECT d.blockchain, d.chain_id, d.round_name AS pool_name, d.round_id, d.tx_timestamp, d.tx_hash, o.address, d.strategy_name,
  'round_operator' AS role, CAST(d.total_amount_in_usd AS DOUBLE) / o.n AS gmv
FROM by_tx d LEFT JOIN operators o ON o.chain_id = d.chain_id AND o.round_id = d.round_id"""

DONATION_DEV_ROWS = """
SELECT d.blockchain, d.chain_id, d.round_name AS pool_name, d.round_id, d.tx_timestamp, d.tx_hash, s.dev_address AS address, d.strategy_name,
  'contract_dev' AS role, CAST(d.total_amount_in_usd AS DOUBLE) / s.address_count AS gmv
FROM by_tx d LEFT JOIN donation_devs s ON s.strategy_name = d.strategy_name AND s.blockchain = d.blockchain"""

PARTY_ROWS = f"""
SELECT slug.chain_name AS blockchain, p.chain_id, r.round_metadata->>'$.name' AS pool_name, p.round_id, p.timestamp AS tx_timestamp,
  p.transaction_hash AS tx_hash, p.address, CASE WHEN r.strategy_name = '' THEN 'allov1.QF' ELSE r.strategy_name END AS strategy_name, p.role, p.gmv
FROM (
  SELECT chain_id, round_id, timestamp, transaction_hash, role, address, CAST(SUM(amount_in_usd) AS DOUBLE) AS gmv FROM (
    SELECT *, unnest(['donor', 'grantee']) AS role, unnest([donor_address, recipient_address]) AS address FROM {{donations}}
  ) u GROUP BY ALL
) p LEFT JOIN {{rounds}} r ON r.id = p.round_id AND r.chain_id = p.chain_id LEFT JOIN {SLUGS} ON slug.chain_id = p.chain_id"""

DISTRIBUTION_OPERATOR_ROWS = """
SELECT g.blockchain, g.chain_id, g.pool_name, g.round_id, g.tx_timestamp, g.tx_hash, o.address, g.strategy_name, 'round_operator' AS role,
  CAST(SUM(g.gmv) AS DOUBLE) / ANY_VALUE(o.n) AS gmv
FROM granted g LEFT JOIN operators o ON o.chain_id = g.chain_id AND o.round_id = g.round_id GROUP BY 1,2,3,4,5,6,7,8,9"""

DISTRIBUTION_DEV_ROWS = """
SELECT g.blockchain, g.chain_id, g.pool_name, g.round_id, g.tx_timestamp, g.tx_hash, s.dev_address AS address, g.strategy_name, 'contract_dev' AS role,
  CAST(SUM(g.gmv) AS DOUBLE) / ANY_VALUE(s.address_count) AS gmv
FROM granted g LEFT JOIN distribution_devs s ON s.strategy_name = g.strategy_name AND s.blockchain = g.blockchain GROUP BY 1,2,3,4,5,6,7,8,9"""

VOICE_DONOR_ROWS = """
SELECT blockchain, chain_id, pool_name, round_id, tx_timestamp, tx_hash, contributor_address AS address, 'MACIQF' AS strategy_name, 'donor' AS role,
  CAST(credits AS DOUBLE) / 100000 * 3000 AS gmv FROM voice"""

VOICE_OPERATOR_ROWS = """
SELECT m.blockchain, m.chain_id, m.pool_name, m.round_id, m.tx_timestamp, m.tx_hash, o.address, 'MACIQF' AS strategy_name, 'round_operator' AS role,
  CAST(SUM(m.credits) AS DOUBLE) / 100000 * 3000 / ANY_VALUE(o.n) AS gmv
FROM voice m LEFT JOIN maci_operators o ON o.chain_id = m.chain_id AND o.round_id = m.round_id GROUP BY 1,2,3,4,5,6,7"""

VOICE_DEV_ROWS = f"""
SELECT m.blockchain, m.chain_id, m.pool_name, m.round_id, m.tx_timestamp, m.tx_hash, s.address, 'MACIQF' AS strategy_name, 'contract_dev' AS role,
  CAST(SUM(m.credits) AS DOUBLE) / 100000 * 3000 / ANY_VALUE(s.n) AS gmv
FROM voice m LEFT JOIN (SELECT DISTINCT blockchain, unnest(['{K.DEV_V2}', '{K.DEV_MACI}']) AS address, 2 AS n FROM voice) s ON s.blockchain = m.blockchain
GROUP BY 1,2,3,4,5,6,7"""

EXTERNAL_ROWS = f"""
SELECT e.blockchain, slug.chain_id, '' AS pool_name, '' AS round_id, e.tx_timestamp, e.tx_hash, e.address, e.strategy_name, e.role, e.gmv
FROM {{external_events}} e LEFT JOIN {SLUGS} ON slug.chain_name = e.blockchain
WHERE e.strategy_name <> 'DonationVotingMerkleDistributionDirectTransferStrategy'"""


@check("t7a_round_operators", f"SELECT *, 'round_operator' AS role FROM ({OPERATORS % 'maci_roles'}) o".replace(" n\n", " count_addresses\n"))
def _(v):
    return groups.round_operators(v.maci_roles)


@check("t7b_donations_by_tx", BY_TX)
def _(v):
    return gmv.donations_by_tx(v.donations, v.rounds, chain_mapping(v.spark))


@check("t7c_donation_devs", f"WITH by_tx AS ({BY_TX}) {DONATION_DEVS}")
def _(v):
    return gmv.dev_shares(gmv.donations_by_tx(v.donations, v.rounds, chain_mapping(v.spark)), gmv.donation_devs)


@check("t7c_distribution_devs", f"WITH base AS ({DISTRIBUTION}), granted AS ({GRANTED}) {DISTRIBUTION_DEVS}")
def _(v):
    return gmv.dev_shares(_granted(v), gmv.distribution_devs)


@check(
    "t7c_voice_devs",
    f"WITH voice AS ({VOICE}) SELECT DISTINCT 'MACIQF' AS strategy_name, blockchain, unnest(['{K.DEV_V2}', '{K.DEV_MACI}']) AS dev_address, 2 AS address_count FROM voice WHERE blockchain IS NOT NULL",
)
def _(v):
    return gmv.dev_shares(_voice(v), gmv.maci_devs)


def _granted(v):
    base_rows = gmv.distribution_base(v.rounds, v.applications, v.payouts)
    return gmv.grantee_rows(base_rows, chain_mapping(v.spark))


def _voice(v):
    return gmv.maci_totals(v.contributions, v.maci_rounds, chain_mapping(v.spark))


def _donation_base(v):
    by_tx = gmv.donations_by_tx(v.donations, v.rounds, chain_mapping(v.spark))
    return by_tx.withColumnsRenamed({"round_name": "pool_name", "total_amount_in_usd": "gmv"})


@check("t7d_donation_operators", f"WITH by_tx AS ({BY_TX}), operators AS ({OPERATORS % 'roles'}) {DONATION_OPERATOR_ROWS}")
def _(v):
    return gmv.operator_share(_donation_base(v), groups.round_operators(v.roles))


@check(
    "t7d_distribution_operators",
    f"WITH base AS ({DISTRIBUTION}), granted AS ({GRANTED}), operators AS ({OPERATORS % 'roles'}) {DISTRIBUTION_OPERATOR_ROWS}",
)
def _(v):
    return gmv.operator_share(gmv.per_tx(_granted(v)), groups.round_operators(v.roles))


@check("t7d_voice_operators", f"WITH voice AS ({VOICE}), maci_operators AS ({OPERATORS % 'maci_roles'}) {VOICE_OPERATOR_ROWS}")
def _(v):
    return gmv.operator_share(gmv.maci_tx(_voice(v)), groups.round_operators(v.maci_roles))


@check("t7e_donation_dev_share", f"WITH by_tx AS ({BY_TX}), donation_devs AS ({DONATION_DEVS}) {DONATION_DEV_ROWS}")
def _(v):
    return gmv.dev_share(_donation_base(v), gmv.donation_devs)


@check(
    "t7e_distribution_dev_share",
    f"WITH base AS ({DISTRIBUTION}), granted AS ({GRANTED}), distribution_devs AS ({DISTRIBUTION_DEVS}) {DISTRIBUTION_DEV_ROWS}",
)
def _(v):
    return gmv.dev_share(gmv.per_tx(_granted(v)), gmv.distribution_devs)


@check("t7e_voice_dev_share", f"WITH voice AS ({VOICE}) {VOICE_DEV_ROWS}")
def _(v):
    return gmv.dev_share(gmv.maci_tx(_voice(v)), gmv.maci_devs)


@check("t7f_donor_grantee_share", PARTY_ROWS)
def _(v):
    return gmv.donor_grantee_share(v.donations, v.rounds, chain_mapping(v.spark))


@check("t7g_distribution_base", DISTRIBUTION)
def _(v):
    return gmv.distribution_base(v.rounds, v.applications, v.payouts)


@check("t7h_distribution_grantees", f"WITH base AS ({DISTRIBUTION}) {GRANTED}")
def _(v):
    return _granted(v)


@check("t7h_voice_donors", f"WITH voice AS ({VOICE}) {VOICE_DONOR_ROWS}")
def _(v):
    return gmv.donor_rows(_voice(v))


@check("t7i_external_rows", EXTERNAL_ROWS)
def _(v):
    return gmv.external_rows(v.external_events, chain_mapping(v.spark))


FINISH = """
SELECT g.blockchain, g.round_id, g.strategy_name, g.pool_name, g.tx_timestamp, g.tx_hash, g.address, g.role, g.gmv, g.data_source, n.name
FROM branches g LEFT JOIN {names} n ON n.address = g.address
WHERE g.address IS NOT NULL AND g.chain_id <> 11155111 AND g.gmv >= 0.5"""


@check(
    "t7j_finish_events",
    f"WITH branches AS (SELECT {OUT}, 'dune' AS data_source FROM ({EXTERNAL_ROWS}) e) {FINISH}",
)
def _(v):
    rows = gmv.external_rows(v.external_events, chain_mapping(v.spark)).withColumn("data_source", F.lit("dune"))
    return gmv.finish_gmv(rows, v.names)


def _branch(source: str, rows: str) -> str:
    return f"SELECT {OUT}, '{source}' AS data_source FROM ({rows}) x"


GMV_EVENTS = f"""WITH by_tx AS ({BY_TX}),
operators AS ({OPERATORS % 'roles'}),
maci_operators AS ({OPERATORS % 'maci_roles'}),
donation_devs AS ({DONATION_DEVS}),
base AS ({DISTRIBUTION}),
granted AS ({GRANTED}),
distribution_devs AS ({DISTRIBUTION_DEVS}),
voice AS ({VOICE}),
branches AS (
{_branch('donation', DONATION_OPERATOR_ROWS)}
UNION ALL {_branch('donation', DONATION_DEV_ROWS)}
UNION ALL {_branch('donation', PARTY_ROWS)}
UNION ALL {_branch('distribution', DISTRIBUTION_OPERATOR_ROWS)}
UNION ALL {_branch('distribution', DISTRIBUTION_DEV_ROWS)}
UNION ALL {_branch('distribution', 'SELECT * FROM granted')}
UNION ALL {_branch('maci_contribution', VOICE_DONOR_ROWS)}
UNION ALL {_branch('maci_contribution', VOICE_OPERATOR_ROWS)}
UNION ALL {_branch('maci_contribution', VOICE_DEV_ROWS)}
UNION ALL {_branch('dune', EXTERNAL_ROWS)}
) {FINISH}"""


def gmv_inputs(v):
    return (
        v.donations, v.rounds, v.applications, v.payouts, v.roles, v.contributions, v.maci_rounds, v.maci_roles,
        v.external_events, v.names,
    )


@check("t7_gmv_events", GMV_EVENTS)
def _(v):
    return gmv.gmv_events(*gmv_inputs(v))


# --- T8: round totals ------------------------------------------------------------

EXCLUDED = ", ".join(f"'{r}'" for r in K.EXCLUDED_PROGRAM_ROUNDS)

ROUND_TOTALS = f"""WITH paid AS (SELECT chain_id, round_id, SUM(amount_in_usd) AS amount, MAX(timestamp) AS latest FROM {{payouts}} GROUP BY ALL),
given AS (SELECT chain_id, round_id, MAX(timestamp) AS latest FROM {{donations}} GROUP BY ALL),
voices AS (
  SELECT chain_id, round_id, CAST(SUM(voice_credit_balance) AS DOUBLE) / 100000 * 3000 AS usd, COUNT(DISTINCT contributor_address) AS donors,
    COUNT(DISTINCT transaction_hash) AS txs FROM {{contributions}} GROUP BY ALL
),
listed AS (
  SELECT r.*, title.chain_name, r.strategy_name IS NOT DISTINCT FROM 'allov2.DirectAllocationStrategy' AS direct,
    COALESCE(r.total_amount_donated_in_usd, 0) AS crowd, COALESCE(r.unique_donors_count, 0) AS donors,
    COALESCE(CASE WHEN r.matching_distribution IS NOT NULL THEN r.match_amount_in_usd ELSE p.amount END, 0) AS pool,
    p.latest AS last_payout, d.latest AS last_donation
  FROM {{rounds}} r LEFT JOIN paid p ON p.chain_id = r.chain_id AND p.round_id = r.id
  LEFT JOIN given d ON d.chain_id = r.chain_id AND d.round_id = r.id LEFT JOIN {TITLES} ON title.chain_id = r.chain_id
  WHERE r.chain_id <> 11155111 AND (r.donations_end_time >= TIMESTAMP '2024-01-01' OR r.applications_start_time >= TIMESTAMP '2024-01-01'
    OR r.strategy_name = 'allov2.DirectAllocationStrategy')
),
report AS (
  SELECT "desc" AS "Name", usd AS "Total USD", 0.0 AS "Crowdfunding USD", usd AS "Matching USD", 0 AS "Donations", 0 AS "Donors",
    0.0 AS "Avg Donor Contribution", network_name AS "Chain", seen AS "Indexed Time", strategy_name AS "Strategy", '0' AS "Chain ID", '0' AS "Round ID"
  FROM (SELECT *, CAST(replace(replace(amount_in_usd, '$', ''), ',', '') AS DOUBLE) AS usd, CAST(timestamp AS TIMESTAMP) AS seen FROM {{external_rounds}}) e
  WHERE seen <= TIMESTAMP '2030-01-01'
  UNION ALL
  SELECT CASE WHEN direct THEN 'Direct Donations Round' ELSE round_metadata->>'$.name' END, CAST(crowd + pool AS DOUBLE), CAST(crowd AS DOUBLE), CAST(pool AS DOUBLE),
    COALESCE(total_donations_count, 0), donors, CASE WHEN donors = 0 THEN 0 ELSE CAST(crowd AS DOUBLE) / donors END, chain_name,
    COALESCE(CASE WHEN direct THEN last_donation ELSE COALESCE(donations_end_time, last_payout) END, applications_start_time),
    CASE strategy_name WHEN 'allov1.QF' THEN 'Allo QF' WHEN 'allov2.DonationVotingMerkleDistributionDirectTransferStrategy' THEN 'Allo QF'
      WHEN 'allov1.Direct' THEN 'Direct Grants' WHEN 'allov2.DirectGrantsLiteStrategy' THEN 'Direct Grants'
      WHEN 'allov2.DirectAllocationStrategy' THEN 'Direct Donations' ELSE strategy_name END,
    CAST(chain_id AS STRING), id
  FROM listed
  UNION ALL
  SELECT m.round_metadata->>'$.name', COALESCE(s.usd, 0), COALESCE(s.usd, 0), 0.0, COALESCE(s.txs, 0), COALESCE(s.donors, 0),
    COALESCE(s.usd / NULLIF(s.donors, 0), 0), title.chain_name, m.donations_end_time,
    CASE WHEN m.strategy_name = 'allov2.MACIQF' THEN 'MACI QF' ELSE m.strategy_name END, CAST(m.chain_id AS STRING), m.id
  FROM {{maci_rounds}} m LEFT JOIN voices s ON s.chain_id = m.chain_id AND s.round_id = m.id LEFT JOIN {TITLES} ON title.chain_id = m.chain_id
  WHERE m.chain_id <> 11155111
)
SELECT g.program, t.* FROM report t LEFT JOIN {{registry}} g ON g.chain_id = CAST(t."Chain ID" AS INT) AND lower(g.round_id) = t."Round ID"
  AND g.round_number IS NOT NULL AND lower(g.round_id) NOT IN ({EXCLUDED})
ORDER BY "Total USD" DESC NULLS FIRST"""


@check("t8_round_totals", ROUND_TOTALS)
def _(v):
    external = ingest.clean_external_rounds(v.external_rounds)
    return rounds.round_totals(
        v.rounds, v.payouts, v.donations, v.registry, external, v.maci_rounds, v.contributions, NOW
    )


# --- T9: project groups ----------------------------------------------------------


@check(
    "t9_project_groups_summary",
    grouped_sql(
        """SELECT n.group_id, n.title, n.project_id AS latest_created_project_id, n.website AS latest_website, n.payout_address AS latest_payout_address,
  n.project_twitter AS latest_project_twitter, n.project_github AS latest_project_github, n.source AS latest_source,
  CAST(s.total AS DECIMAL(18,2)) AS total_amount_donated, s.latest AS latest_created_application, s.members AS application_count
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id ORDER BY created_at DESC NULLS FIRST, row_id DESC) AS rn FROM grouped) n
JOIN (SELECT group_id, COALESCE(SUM(CAST(amount_donated AS DECIMAL(28,2))), 0) AS total, MAX(created_at) AS latest, COUNT(project_id) AS members
      FROM grouped GROUP BY group_id) s ON s.group_id = n.group_id
WHERE n.rn = 1"""
    ),
)
def _(v):
    grouped = grouped_of(v).withColumn("amount_donated", F.col("amount_donated").cast("decimal(18,2)"))
    summary = projects.project_groups_summary(grouped)
    return summary.withColumn("total_amount_donated", F.col("total_amount_donated").cast("decimal(18,2)"))


# --- C1-C4: ingest ---------------------------------------------------------------


@check(
    "c1_flatten_scores",
    "SELECT key_0 AS model, key_1 AS address, value->>'$.Status' AS status, CAST(value->'$.tags' AS BIGINT[]) AS tags, "
    "CAST(value->>'$.data.Human_Probability' AS DOUBLE) AS data_human_probability FROM {scores}",
)
def _(v):
    return ingest.clean_scores(v.scores)


@check("c1_flatten_event_props", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM {events}")
def _(v):
    return ingest.flatten_json_column(v.events.select("event_id", "props"), "props")


@check(
    "c2_clean_external_rounds",
    "SELECT \"desc\", CAST(replace(replace(amount_in_usd, '$', ''), ',', '') AS DOUBLE) AS amount_in_usd, network_name, CAST(timestamp AS TIMESTAMP) AS timestamp, strategy_name FROM {external_rounds}",
)
def _(v):
    return ingest.clean_external_rounds(v.external_rounds)


@check(
    "c3_sign_events",
    "SELECT *, sha256(COALESCE(CAST(tx_timestamp AS STRING), 'None') || COALESCE(tx_hash, 'None') || COALESCE(address, 'None') || "
    "COALESCE(CAST(CAST(gmv AS DECIMAL(18,2)) AS STRING), 'None') || COALESCE(role, 'None') || CAST(row_number AS STRING)) AS event_signature "
    "FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY tx_timestamp, role, address, gmv, blockchain, tx_hash, strategy_name) AS row_number FROM {external_events}) e",
)
def _(v):
    return ingest.sign_events(v.external_events)


@check(
    "c4_address_labels",
    "SELECT address, entity_name, label_name, entity_id, entity_type, entity_addresses, entity_twitter, contract, chain FROM {label_book} "
    "WHERE lower(address) IN ('0xc1', '0xc20', '0xc300', '0xc499') AND chain = 'ethereum'",
)
def _(v):
    return ingest.address_labels(v.label_book, ["0xc1", "0xc20", "0xc300", "0xc499"], "ethereum")


# --- V1, V2: audit and refresh ---------------------------------------------------


@check(
    "v1_audit_refresh",
    """WITH o AS (SELECT 'donations' AS t, CAST(SUM(amount_in_usd) AS DECIMAL(38,8)) AS x FROM {old_donations} UNION ALL SELECT 'payouts', CAST(SUM(amount_in_usd) AS DECIMAL(38,8)) FROM {payouts}
  UNION ALL SELECT 'rounds', CAST(SUM(match_amount_in_usd) AS DECIMAL(38,8)) FROM {old_rounds}),
n AS (SELECT 'donations' AS t, CAST(SUM(amount_in_usd) AS DECIMAL(38,8)) AS x FROM {donations} UNION ALL SELECT 'payouts', CAST(SUM(amount_in_usd) AS DECIMAL(38,8)) FROM {payouts}
  UNION ALL SELECT 'rounds', CAST(SUM(match_amount_in_usd) AS DECIMAL(38,8)) FROM {rounds})
SELECT n.t AS table_name, o.x AS old_total, n.x AS new_total, CASE WHEN n.x > o.x THEN 'increased' WHEN n.x < o.x THEN 'decreased' ELSE 'unchanged' END AS status
FROM n LEFT JOIN o ON o.t = n.t""",
)
def _(v):
    def totals(donated, paid, pools):
        return audit.table_totals(
            {
                "donations": (donated, "amount_in_usd"), "payouts": (paid, "amount_in_usd"),
                "rounds": (pools, "match_amount_in_usd"),
            }
        )

    old = totals(v.old_donations, v.payouts, v.old_rounds)
    return audit.audit_refresh(old, totals(v.donations, v.payouts, v.rounds))


def refresh_inputs(v):
    base_sources = {
        "applications": {"indexer": v.applications, "static": v.applications},
        "rounds": {"indexer": v.rounds, "static": v.old_rounds},
        "donations": {"indexer": v.donations, "static": v.old_donations},
        "applications_payouts": {"indexer": v.payouts, "static": v.old_payouts},
        "round_roles": {"indexer": v.roles, "static": v.old_roles},
    }
    others = {
        "registry": v.registry, "static_donations": v.static_donations,
        "static_matching": matching.historical_matching(
            v.alpha_matching, v.alpha_addresses, v.past_matching, v.past_grants
        ),
        "round_roles": v.roles, "maci_contributions": v.contributions, "maci_rounds": v.maci_rounds,
        "maci_round_roles": v.maci_roles, "external_events": v.external_events, "names": v.names,
    }
    return base_sources, others


BASES = {
    "applications": BASE_APPLICATIONS, "rounds": BASE_ROUNDS, "donations": DEDUP.format(extra=""), "payouts": BASE_PAYOUTS, "roles": BASE_ROLES,
}


def over_bases(sql: str) -> str:
    """The text of a derived table over the base tables; the roles are those of the live source."""
    for name in ["applications", "rounds", "donations", "payouts"]:
        sql = sql.replace(f"{{{name}}}", f"base_{name}")
    return sql


def _measured(table: str, rows: str, amount: str = "NULL") -> str:
    total = f"CAST(SUM(CAST({amount} AS DECIMAL(38,8))) AS DECIMAL(38,2))"
    return f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, {total} AS total FROM {rows}"


REFRESHED = "WITH " + ",\n".join(f"base_{name} AS ({sql})" for name, sql in BASES.items()) + "\n" + "\nUNION ALL ".join(
    [
        _measured("applications", "base_applications"),
        _measured("rounds", "base_rounds", "total_amount_donated_in_usd + CASE WHEN matching_distribution IS NOT NULL THEN match_amount_in_usd ELSE 0 END"),
        _measured("donations", "base_donations", "amount_in_usd"),
        _measured("applications_payouts", "base_payouts", "amount_in_usd"),
        _measured("round_roles", "base_roles"),
        _measured("allov2_distribution_events_for_leaderboard", "{external_events}"),
        _measured("indexer_matching", f"({over_bases(payouts_sql('rounds'))}) m", "match_amount_in_usd"),
        _measured("all_donations", f"({over_bases(ALL_DONATIONS)}) d", "amount_in_usd"),
        _measured("all_matching", f"({over_bases(matching_sql('rounds'))}) a", "match_amount_in_usd"),
        _measured("allo_gmv_leaderboard_events", f"({over_bases(GMV_EVENTS)}) g", "gmv"),
    ]
)


@check("v2_refresh_all", REFRESHED)
def _(v):
    root = staging_path(v.spark, "refresh")
    refresh.refresh_all(v.spark, *refresh_inputs(v), root)
    total = F.col("total").cast("decimal(38,8)").cast("decimal(38,2)").alias("total")
    return read_manifest(v.spark, root).select(F.col("table").alias("table_name"), "row_count", total)
