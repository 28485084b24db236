"""Checks of R1-R8 and W1-W5."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import chain
from fundlens.plans.refresh import publish
from fundlens.session import staging_path
from fundlens.sources import files, readers, writers

PER_DAY = "SELECT l_shipdate AS day, COUNT(*) AS n, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM {lineitem} GROUP BY l_shipdate"


@check("r1_table_scan", PER_DAY)
def _(v):
    rows = readers.read_table(v.spark, v._dir, "lineitem.parquet", "l_shipdate TIMESTAMP, l_extendedprice DOUBLE")
    return rows.groupBy(F.col("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total")
    )


NEWEST = (
    "SELECT schema_name, o_orderkey, amount FROM {schema_names} WHERE CAST(substr(schema_name, 12) AS INT) = "
    "(SELECT MAX(CAST(substr(schema_name, 12) AS INT)) FROM {schema_names})"
)


@check("r3_latest_version", NEWEST)
def _(v):
    return readers.latest_version(v.schema_names, "schema_name")


@check("r3_newest_folder", NEWEST)
def _(v):
    root = staging_path(v.spark, "schemas")
    # One folder per schema version, each with a table of orders.
    named = v.schema_names.withColumn("folder", F.col("schema_name")).withColumn("table", F.lit("orders"))
    named.write.partitionBy("folder", "table").parquet(root)
    for path in [p for p in files.list_folder(v.spark, root) if "/folder=" in p]:
        files.rename(v.spark, path, path.replace("folder=", ""))
    return readers.read_newest(v.spark, root, "table=orders")


@check("r4_parquet_source", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}")
def _(v):
    return readers.read_parquet(v.spark, f"{v._dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


@check("r5_csv_records", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM {customer}")
def _(v):
    path = staging_path(v.spark, "csv")
    v.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.option("header", True).csv(path)
    return readers.read_csv_records(
        v.spark, path, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING"
    )


@check("r6_require_non_empty", "SELECT event_type, COUNT(*) AS n FROM {events} GROUP BY event_type")
def _(v):
    events = readers.require_non_empty(v.events.select("event_type"), "event set")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


CHAIN_COUNTS = f"""
SELECT {chain('c_nationkey')} AS chain_id, COUNT(*) AS customers,
  SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS balance
FROM {{customer}} GROUP BY {chain('c_nationkey')}"""


# Both lists, whole.
SLUG_ROWS = """(1,'ethereum'),(10,'optimism'),(137,'polygon'),(250,'fantom'),(324,'zksync'),(424,'pgn'),(8453,'base'),(42161,'arbitrum'),
(43114,'avalanche'),(534352,'scroll'),(1329,'sei'),(11155111,'sepolia'),(42220,'celo'),(56,'binance'),(100,'gnosis'),(1284,'moonbeam'),
(1285,'moonriver'),(25,'cronos'),(128,'huobi'),(1666600000,'harmony'),(2222,'kava'),(30,'rsk'),(288,'boba network'),(1313161554,'aurora'),
(42262,'oasis emerald'),(1088,'metis andromeda'),(66,'okexchain'),(1101,'polygon zkevm'),(592,'astar'),(42,'lukso')"""
TITLE_ROWS = """(1,'Ethereum'),(10,'Optimism'),(137,'Polygon'),(250,'Fantom'),(324,'zkSync'),(424,'PGN'),(8453,'Base'),(42161,'Arbitrum One'),
(43114,'Avalanche'),(534352,'Scroll'),(1329,'SEI'),(11155111,'Sepolia')"""


@check(
    "r7_chain_lists",
    f"""
SELECT slug.chain_id, slug.chain_name AS slug, title.chain_name AS title, b.customers, b.balance
FROM (VALUES {SLUG_ROWS}) AS slug(chain_id, chain_name)
FULL JOIN (VALUES {TITLE_ROWS}) AS title(chain_id, chain_name) ON title.chain_id = slug.chain_id
LEFT JOIN ({CHAIN_COUNTS}) b ON b.chain_id = slug.chain_id""",
)
def _(v):
    counts = v.sql(CHAIN_COUNTS)
    slugs = readers.chain_mapping(v.spark).withColumnRenamed("chain_name", "slug")
    titles = readers.chain_names(v.spark).withColumnRenamed("chain_name", "title")
    return slugs.join(titles, "chain_id", "full").join(counts, "chain_id", "left")


BIG = "SELECT o_custkey, MAX(o_totalprice) AS largest FROM {orders} GROUP BY o_custkey"


@check("r8_adhoc_sql", BIG)
def _(v):
    return readers.run_query(v.spark, BIG, orders=v.orders)


@check("w1_overwrite_table", PER_DAY)
def _(v):
    path = staging_path(v.spark, "overwrite")
    writers.write_files(v.lineitem.select("l_shipdate"), path)
    return writers.write_files(v.sql(PER_DAY), path)


@check(
    "w2_publish_together",
    "SELECT 'orders' AS table_name, COUNT(*) AS row_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total FROM {orders} "
    "UNION ALL SELECT 'customer', COUNT(*), CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) FROM {customer}",
)
def _(v):
    root = staging_path(v.spark, "publish")
    orders = v.orders.select(F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    customer = v.customer.select(F.col("c_acctbal").cast("decimal(18,2)").alias("amount"))
    for version in (1, 2):
        tables = {"orders": orders, "customer": customer}
        rows = publish(v.spark, tables, root, version, {"orders": "amount", "customer": "amount"})
        writers.switch_manifest(v.spark, root, rows)
    manifest = writers.read_manifest(v.spark, root).where(F.col("version") == 2)
    return manifest.select(
        F.col("table").alias("table_name"), "row_count", F.col("total").cast("decimal(38,2)").alias("total")
    )


@check("w3_snapshot", "SELECT o_orderkey, o_orderstatus, 'frozen' AS tag FROM {orders}")
def _(v):
    root = staging_path(v.spark, "snapshot")
    return writers.snapshot(v.orders.select("o_orderkey", "o_orderstatus"), root, "frozen").withColumn(
        "tag", F.lit("frozen")
    )


@check("w4_materialize", PER_DAY)
def _(v):
    return writers.materialize(v.spark, PER_DAY, staging_path(v.spark, "materialize"), lineitem=v.lineitem)


@check("w5_sample_cap", "SELECT LEAST(1000, COUNT(*)) AS sampled FROM {orders}")
def _(v):
    return writers.sample_cap(v.orders, 1000).agg(F.count(F.lit(1)).alias("sampled"))
