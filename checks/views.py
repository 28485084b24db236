"""Grants-shaped views over the given tables, one SQL text for Spark and for DuckDB.

``{name}`` stands for a given table or another view. Every view reads whole
tables. NULLs, blanks, mixed case, unmapped chains, repeated keys and unmatched
rows come from CASE and shifted keys, so that results exercise those rules.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, types as T

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def chain(n: str) -> str:
    return (
        f"CASE {n} % 6 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 137 WHEN 3 THEN 42161 "
        "WHEN 4 THEN 11155111 ELSE 777 END"
    )


def round_id(k: str, lower: bool = False) -> str:
    prefix = "'0xr'" if lower else f"CASE WHEN {k} % 5 = 0 THEN '0xR' ELSE '0xr' END"
    return f"CASE WHEN {k} = 3 THEN '0xa1d52f9b5339792651861329a046dd912761e9a9' ELSE concat({prefix}, {text(k)}) END"


def address(k: str) -> str:
    return f"concat('0x', lpad({text(k)}, 40, '0'))"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def entry(k: str, i: int) -> str:
    """One element of a matching distribution; braces doubled for the placeholder syntax."""
    part = f"(({k} * 7 + {i * 13}) % 200)"
    pct = (
        f"CASE WHEN {k} = 3 THEN concat({text(f'{i} + 1')}, '0000000000') "
        f"ELSE concat('0.', lpad({text(f'({k} * 31 + {i}) % 10000')}, 4, '0')) END"
    )
    return (
        f"concat('{{{{\"projectId\":\"p', {text(part)}, '\",\"projectName\":\"Project ', {text(part)}, "
        f"'\",\"applicationId\":\"', {text(part)}, '\",\"contributionsCount\":\"', {text(f'{k} % 50')}, "
        f"'\",\"matchAmountInToken\":\"', {text(f'{k} * 3')}, '\",\"matchPoolPercentage\":\"', {pct}, "
        f"'\",\"projectPayoutAddress\":\"', {address(part)}, '\",\"originalMatchAmountInToken\":null}}}}')"
    )


def distribution(k: str, entries: int) -> str:
    items = ", ',', ".join(entry(k, i) for i in range(entries))
    return (
        f"CASE WHEN {k} % 8 = 0 THEN NULL WHEN {k} % 8 = 1 THEN '{{{{\"matchingDistribution\":[]}}}}' "
        f"WHEN {k} % 8 = 2 THEN concat('{{{{\"matchingDistribution\":[', {items}, ']}}}}') "
        f"ELSE concat('{{{{\"blockTimestamp\":\"2024-05-01T10:11:12.345Z\",\"matchingDistribution\":[', {items}, ']}}}}') END"
    )


STRATEGY = """CASE {k} % 7 WHEN 0 THEN 'allov1.QF' WHEN 1 THEN 'allov2.DonationVotingMerkleDistributionDirectTransferStrategy'
  WHEN 2 THEN 'allov2.DirectAllocationStrategy' WHEN 3 THEN '' WHEN 4 THEN NULL
  WHEN 5 THEN 'allov2.DirectGrantsLiteStrategy' ELSE 'allov1.Direct' END"""

JOINED = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey"


def _donations(key: str, amount: str) -> str:
    return f"""
SELECT concat({text(key)}, '-', {text('l_linenumber')}) AS id, {chain('s_nationkey')} AS chain_id,
  {round_id('l_suppkey')} AS round_id, {text('l_partkey')} AS application_id,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('c', {text('o_custkey')}) END AS donor_address,
  {address('l_partkey')} AS recipient_address, {text(money('l_extendedprice'))} AS amount, 'token' AS token_address,
  {money(amount)} AS amount_in_usd, {text('l_orderkey')} AS transaction_hash, l_shipdate AS timestamp
FROM {JOINED}"""


def _rounds(k: str, nation: str, amount: str, entries: int, source: str) -> str:
    return f"""
SELECT {round_id(k, lower=True)} AS id, {chain(nation)} AS chain_id,
  concat('{{{{"name":"Round ', {text(k)}, '","eligibility":{{{{"description":null}}}}}}}}') AS round_metadata,
  concat('s', {text(f'{k} % 7')}) AS strategy_id, {STRATEGY.replace('{k}', k)} AS strategy_name,
  {distribution(k, entries)} AS matching_distribution,
  CASE WHEN {k} % 11 = 0 THEN NULL ELSE {money(amount)} END AS match_amount_in_usd,
  CASE WHEN {k} % 13 = 0 THEN NULL ELSE {money(amount)} END AS total_amount_donated_in_usd,
  CAST({k} % 100 AS INT) AS total_donations_count, CAST({k} % 10 AS INT) AS unique_donors_count,
  CASE WHEN {k} % 9 = 0 THEN NULL ELSE TIMESTAMP '2023-11-01 00:00:00' + DAYS_INTERVAL({k} % 120) END AS donations_end_time,
  CASE WHEN {k} % 17 = 0 THEN NULL ELSE TIMESTAMP '2023-10-01 00:00:00' + DAYS_INTERVAL({k} % 110) END AS applications_start_time
FROM {source}"""


VIEWS = {
    "rounds": _rounds("s_suppkey", "s_nationkey", "s_acctbal", 6, "{supplier}"),
    # Same shape with one round per order, for the JSON jobs.
    "order_rounds": _rounds("o_orderkey", "o_custkey", "o_totalprice", 2, "{orders}"),
    # Later state of the rounds in a second source: other amounts, shifted keys.
    "old_rounds": _rounds("(s_suppkey + 20)", "s_nationkey", "s_acctbal + 1", 3, "{supplier}"),
    "registry": f"""
SELECT CASE WHEN s_suppkey % 7 = 6 THEN NULL ELSE {text('s_suppkey % 20')} END AS round_number, 'QF' AS type,
  concat('chain ', {text('s_nationkey')}) AS chain_name, {chain('s_nationkey')} AS chain_id, s_name AS round_name,
  concat('0xR', {text('s_suppkey + 10')}) AS round_id, concat('GG', {text('s_suppkey % 20')}) AS program
FROM {{supplier}}""",
    "donations": _donations("l_orderkey", "l_extendedprice"),
    "old_donations": _donations("l_orderkey + 3000", "l_quantity"),
    "applications": f"""
SELECT DISTINCT {text('l_partkey')} AS id, {chain('s_nationkey')} AS chain_id, {round_id('l_suppkey')} AS round_id,
  concat('p', {text('l_partkey')}) AS project_id, CASE WHEN l_partkey % 3 = 0 THEN 'REJECTED' ELSE 'APPROVED' END AS status,
  concat('tx', {text('l_partkey % 10')}) AS distribution_transaction,
  concat('{{{{"application":{{{{"recipient":"', {address('l_partkey % 700')}, '","project":{{{{"title":"', p_name, ' #', {text('l_partkey % 700')},
    '!","website":"', CASE WHEN p_size % 3 = 0 THEN '' ELSE concat('https://', p_brand) END, '","projectTwitter":"', p_type,
    '","projectGithub":"https://github.com/', p_brand, '/main","createdAt":', {text('CAST(1700000000000 AS BIGINT) + l_suppkey * 1000 + 7')},
    '}}}}}}}}}}}}') AS metadata,
  CAST(l_partkey % 40 AS INT) AS total_donations_count, CAST({money('p_retailprice')} AS DOUBLE) AS total_amount_donated_in_usd
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{part}} ON l_partkey = p_partkey""",
    "payouts": f"""
SELECT CAST(l_orderkey * 8 + l_linenumber AS INT) AS id, {chain('s_nationkey')} AS chain_id, {round_id('l_suppkey')} AS round_id,
  {text('l_partkey')} AS application_id, {money('l_quantity - 10')} AS amount_in_usd, l_shipdate AS timestamp,
  concat('pay', {text('l_orderkey')}) AS transaction_hash
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "roles": f"""
SELECT DISTINCT {chain('s_nationkey')} AS chain_id,
  CASE WHEN l_suppkey % 10 = 9 THEN concat('0xq', {text('l_suppkey')}) ELSE {round_id('l_suppkey')} END AS round_id,
  concat('op', {text('least(l_linenumber, 1 + l_suppkey % 7)')}) AS address,
  CASE WHEN l_linenumber % 2 = 0 THEN 'ADMIN' ELSE 'MANAGER' END AS role
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    # Second sources: later keys, other amounts, some roles of the live one.
    "old_payouts": f"""
SELECT CAST(l_orderkey * 8 + l_linenumber + 4000 AS INT) AS id, {chain('s_nationkey + 1')} AS chain_id, {round_id('l_suppkey')} AS round_id,
  {text('l_partkey')} AS application_id, {money('l_quantity + 3')} AS amount_in_usd, l_shipdate AS timestamp,
  concat('old', {text('l_orderkey')}) AS transaction_hash
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "old_roles": f"""
SELECT DISTINCT {chain('s_nationkey')} AS chain_id, {round_id('l_suppkey')} AS round_id,
  concat('op', {text('least(l_linenumber, 2 + l_suppkey % 7)')}) AS address,
  CASE WHEN l_linenumber % 3 = 0 THEN 'ADMIN' ELSE 'MANAGER' END AS role
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "contributions": f"""
SELECT concat('m_', event_type) AS round_id, {chain('user_id')} AS chain_id, concat('c', {text('user_id')}) AS contributor_address,
  concat('mtx', {text('event_id - event_id % 3')}) AS transaction_hash, CAST(value * 100 AS DECIMAL(18,0)) AS voice_credit_balance,
  ts AS timestamp
FROM {{events}}""",
    "maci_rounds": f"""
SELECT DISTINCT CASE WHEN event_type = 'error' THEN 'm_other' ELSE concat('m_', event_type) END AS id, {chain('user_id')} AS chain_id,
  concat('{{{{"name":"Voice ', event_type, '"}}}}') AS round_metadata,
  CASE WHEN event_type = 'click' THEN 'other' ELSE 'allov2.MACIQF' END AS strategy_name,
  TIMESTAMP '2024-02-01 00:00:00' AS donations_end_time
FROM {{events}}""",
    "maci_roles": f"""
SELECT DISTINCT concat('m_', event_type) AS round_id, {chain('user_id')} AS chain_id,
  concat('op', {text('user_id % 4')}) AS address, CASE WHEN event_id % 2 = 0 THEN 'ADMIN' ELSE 'MANAGER' END AS role
FROM {{events}}""",
    "external_events": f"""
SELECT CASE user_id % 4 WHEN 0 THEN 'ethereum' WHEN 1 THEN 'celo' WHEN 2 THEN 'lukso' ELSE 'elsewhere' END AS blockchain,
  ts AS tx_timestamp, concat('ex', {text('event_id')}) AS tx_hash, concat('c', {text('user_id')}) AS address,
  CASE event_type WHEN 'click' THEN 'DonationVotingMerkleDistributionDirectTransferStrategy' WHEN 'error' THEN NULL ELSE event_type END AS strategy_name,
  'grantee' AS role, value AS gmv
FROM {{events}}""",
    "names": f"SELECT concat('c', {text('c_custkey * 2')}) AS address, c_name AS name FROM {{customer}}",
    "timings": """
SELECT n_nationkey + 1 AS round_num, TIMESTAMP '1992-01-01 00:00:00' + DAYS_INTERVAL(n_nationkey * 150) AS start_date,
  TIMESTAMP '1992-01-01 00:00:00' + DAYS_INTERVAL(n_nationkey * 150 + CASE WHEN n_nationkey % 5 = 0 THEN 140 ELSE 160 END) AS end_date
FROM {nation}""",
    "past_contributions": f"""
SELECT concat('V', {text('o_custkey')}) AS voter_address, l_partkey AS grant_id, l_shipdate AS created_on,
  {money('l_extendedprice')} AS amountUSD,
  CASE l_linenumber % 4 WHEN 0 THEN 'eth_std' WHEN 1 THEN 'eth_polygon' WHEN 2 THEN 'eth_zksync' ELSE 'card' END AS checkout_type
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "past_grants": f"""
SELECT p_partkey + 10 AS grantid, CASE WHEN p_size % 40 = 0 THEN '  !' ELSE p_name END AS name,
  CASE WHEN p_size % 20 = 1 THEN 'nowhere' ELSE upper(substring({address('p_partkey % 900')}, 3)) END AS payout_raw,
  CASE WHEN p_size % 20 = 1 THEN 'nowhere' ELSE {address('p_partkey % 900')} END AS payoutaddress,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE concat('https://', p_brand) END AS websiteurl, p_type AS twitter,
  CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN concat(p_brand, '/main') WHEN 2 THEN p_brand ELSE concat('http://github.com/', p_brand, '/x') END AS github,
  CASE WHEN p_size % 30 = 7 THEN NULL ELSE TIMESTAMP '2019-01-01 00:00:00' + DAYS_INTERVAL(p_size) END AS createdon
FROM {{part}}""",
    "past_matching": f"""
SELECT {text('p_size % 15')} AS round_num, p_partkey AS grant_id, p_type AS sub_round_slug, {money('p_retailprice')} AS match_amount,
  CAST(TIMESTAMP '2020-01-01 00:00:00' + DAYS_INTERVAL(p_size) AS DATE) AS payout_tx_date
FROM {{part}}""",
    "alpha_donations": f"""
SELECT concat('title ', {text('o_custkey % 100')}) AS title, o_orderpriority AS round_name, {money('o_totalprice')} AS usd_amount,
  o_orderdate AS block_time, CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE concat('OXAB', {text('o_custkey')}) END AS donor
FROM {{orders}}""",
    "alpha_addresses": f"SELECT concat('title ', {text('c_custkey * 2')}) AS title, {address('c_custkey')} AS address FROM {{customer}}",
    "alpha_matching": f"""
SELECT '16' AS round_num, concat('title ', {text('s_suppkey')}) AS title, {money('s_acctbal')} AS match_amount_dai,
  concat('slug', {text('s_nationkey')}) AS sub_round_slug
FROM {{supplier}}""",
    "static_donations": f"""
SELECT CASE WHEN o_orderkey % 30 = 0 THEN NULL ELSE CAST(o_orderkey % 20 AS INT) END AS round_num, o_orderpriority AS round_name,
  concat('c', {text('o_custkey')}) AS donor_address, {money('o_totalprice')} AS amount_in_usd, {address('o_custkey')} AS recipient_address,
  o_orderdate AS timestamp, o_orderstatus AS project_name, concat('p', {text('o_custkey')}) AS project_id, 'past' AS round_id,
  1 AS chain_id, 'CGrants' AS source
FROM {{orders}}""",
    "external_rounds": f"""
SELECT c_name AS desc, concat('$', {text('c_custkey % 9 + 1')}, ',', lpad({text('c_custkey % 1000')}, 3, '0'), '.50') AS amount_in_usd,
  c_mktsegment AS network_name, {text("TIMESTAMP '2023-01-01 08:30:00' + DAYS_INTERVAL(c_custkey % 4000)")} AS timestamp,
  'Retro' AS strategy_name
FROM {{customer}}""",
    "label_book": f"""
SELECT concat('0xC', {text('c_custkey % 500')}) AS address, c_name AS entity_name, c_mktsegment AS label_name,
  {text('c_custkey')} AS entity_id, 'person' AS entity_type, {text('c_nationkey')} AS entity_addresses,
  concat('@', c_name) AS entity_twitter, 'false' AS contract,
  CASE WHEN c_nationkey % 2 = 0 THEN 'ethereum' ELSE 'polygon' END AS chain
FROM {{customer}}""",
    "scores": f"""
SELECT event_type AS key_0, concat('c', {text('user_id')}) AS key_1,
  concat('{{{{"data":{{{{"meta":{{{{"version":"v', {text('user_id % 3')}, '","training_date":"2024-01-01"}}}},"gas_spent":', {text('event_id % 10')},
    ',"n_days_active":', {text('user_id')}, ',"n_transactions":5,"has_safe_nft":true,"Human_Probability":', {text('event_id % 100')},
    '.5}}}},"Status":"', event_type, '","tags":[', {text('user_id')}, ',1]}}}}') AS value
FROM {{events}}""",
    "schema_names": f"""
SELECT concat('chain_data_', {text('10 + o_orderkey % 95')}) AS schema_name, o_orderkey, {money('o_totalprice')} AS amount
FROM {{orders}}""",
}

# Texts for Spark alone, with the rows of the view of that name: an application's text is a function of its part and
# supplier, so the distinct is taken over their keys, and each text is made once, behind every shuffle. Part and
# supplier are distinct in what they give, so no row comes twice. The parts' texts are not sent through the driver.
SPARK_SQL = {
    "applications": f"""
SELECT /*+ MERGE(p) */ {text('l_partkey')} AS id, chain_id, {round_id('l_suppkey')} AS round_id,
  concat('p', {text('l_partkey')}) AS project_id, CASE WHEN l_partkey % 3 = 0 THEN 'REJECTED' ELSE 'APPROVED' END AS status,
  concat('tx', {text('l_partkey % 10')}) AS distribution_transaction,
  concat(head, {text('CAST(1700000000000 AS BIGINT) + l_suppkey * 1000 + 7')}, '}}}}}}}}}}}}') AS metadata,
  CAST(l_partkey % 40 AS INT) AS total_donations_count, total_amount_donated_in_usd
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM {{lineitem}}) l
JOIN (SELECT DISTINCT s_suppkey, {chain('s_nationkey')} AS chain_id FROM {{supplier}}) s ON l_suppkey = s_suppkey
JOIN (
  SELECT DISTINCT p_partkey, CAST({money('p_retailprice')} AS DOUBLE) AS total_amount_donated_in_usd,
    concat('{{{{"application":{{{{"recipient":"', {address('p_partkey % 700')}, '","project":{{{{"title":"', p_name, ' #', {text('p_partkey % 700')},
      '!","website":"', CASE WHEN p_size % 3 = 0 THEN '' ELSE concat('https://', p_brand) END, '","projectTwitter":"', p_type,
      '","projectGithub":"https://github.com/', p_brand, '/main","createdAt":') AS head
  FROM {{part}}
) p ON l_partkey = p_partkey""",
}


def _names(sql: str) -> list[str]:
    bare = sql.replace("{{", "").replace("}}", "")
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", bare)))


class Views:
    """Spark frames of the given tables and of the views above, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS and name not in TABLES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in TABLES:
            path = f"{self._dir}/{name}.parquet"
            fields = self.spark.read.parquet(path).schema.fields
            # The files hold times without a zone; the session zone is UTC.
            zoned = [
                T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
                for f in fields
            ]
            return self.spark.read.schema(T.StructType(zoned)).parquet(path)
        return self.sql(SPARK_SQL.get(name, VIEWS[name]))

    def sql(self, sql: str) -> DataFrame:
        sql = sql.replace("DAYS_INTERVAL(", "make_dt_interval(")
        return self.spark.sql(sql, **{n: getattr(self, n) for n in _names(sql)})


def duckdb_sql(sql: str) -> str:
    """The text for DuckDB, with the views it needs as common table expressions."""
    needed: dict[str, str] = {}

    def collect(part: str) -> None:
        for name in _names(part):
            if name in VIEWS and name not in needed:
                collect(VIEWS[name])
                needed[name] = VIEWS[name]

    collect(sql)
    names = {n: n for n in [*TABLES, *VIEWS]}
    body = sql.strip().format(**names)
    if needed:
        ctes = ",\n".join(f"{n} AS ({v.strip().format(**names)})" for n, v in needed.items())
        recursive = body.upper().startswith("WITH RECURSIVE ")
        if body.upper().startswith("WITH "):
            body = ",\n" + body[len("WITH RECURSIVE ") if recursive else len("WITH "):]
        else:
            body = "\n" + body
        body = f"WITH {'RECURSIVE ' if recursive else ''}{ctes}{body}"
    return body.replace("DAYS_INTERVAL(", "to_days(")
