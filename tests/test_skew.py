"""A key that holds a third of the rows is split, not gathered in one task."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fundlens.plans import donations, gmv, projects
from fundlens.sources import schemas


@pytest.fixture
def small_splits(spark):
    """Thresholds of the run-time skew split lowered to the size of test data; no size-based broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        # Otherwise so little data is written by one task, and one task's output is never split.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "2000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot_donations(spark, n=12_000):
    """A third of the rows in round r0 and application 0, and all of those from one donor."""
    hot = F.col("i") % 3 == 0
    key = F.when(hot, 0).otherwise(1 + F.col("i") % 400)
    return spark.range(n, numPartitions=6).withColumnRenamed("id", "i").select(
        F.col("i").cast("string").alias("id"), F.lit(1).alias("chain_id"), F.concat(F.lit("r"), key).alias("round_id"),
        key.cast("string").alias("application_id"), F.when(hot, "whale").otherwise(F.concat(F.lit("d"), "i")).alias("donor_address"),
        F.lit("g").alias("recipient_address"), F.lit("1").alias("amount"), F.lit("t").alias("token_address"),
        F.lit(Decimal("5.00")).cast("decimal(18,2)").alias("amount_in_usd"), F.sha2(F.col("i").cast("string"), 256).alias("transaction_hash"),
        (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(secs=F.col("i"))).alias("timestamp"),
    )


def hot_rounds(spark, strategy="allov1.QF"):
    return spark.range(401).select(
        F.concat(F.lit("r"), "id").alias("id"), F.lit(1).alias("chain_id"), F.lit('{"name":"n"}').alias("round_metadata"),
        F.lit("s").alias("strategy_id"), F.lit(strategy).alias("strategy_name"), F.lit(None).cast("string").alias("matching_distribution"),
        F.lit(None).cast("decimal(18,2)").alias("match_amount_in_usd"), F.lit(None).cast("timestamp").alias("donations_end_time"),
    )


def test_hot_application_is_split(spark, rows, small_splits):
    apps = spark.range(401).select(
        F.col("id").cast("string").alias("id"), F.lit(1).alias("chain_id"), F.concat(F.lit("r"), "id").alias("round_id"),
        F.lit("p").alias("project_id"), F.lit("{}").alias("metadata"),
    )
    got = donations.all_donations(
        hot_donations(spark), apps, hot_rounds(spark), rows([], schemas.REGISTRY), rows([], schemas.STATIC_DONATIONS)
    )
    assert "skew=true" in final_plan(got)
    assert got.count() == 12_000


def test_hot_round_is_split_when_value_is_shared_out(spark, rows, small_splits):
    roles = spark.range(401).select(
        F.lit(1).alias("chain_id"), F.concat(F.lit("r"), "id").alias("round_id"), F.lit("op").alias("address"), F.lit("ADMIN").alias("role")
    )
    names = spark.range(50).select(F.concat(F.lit("d"), "id").alias("address"), F.lit("n").alias("name"))
    empty = lambda ddl: rows([], ddl)
    got = gmv.gmv_events(
        hot_donations(spark), hot_rounds(spark), empty(schemas.APPLICATIONS), empty(schemas.APPLICATIONS_PAYOUTS), roles,
        empty(schemas.MACI_CONTRIBUTIONS), empty(schemas.MACI_ROUNDS), empty(schemas.ROUND_ROLES), empty(schemas.EXTERNAL_EVENTS), names,
    )
    plan = final_plan(got)
    # By round for the shares, by round for the parties' round, by address for the donors' names.
    assert plan.count("skew=true") >= 3
    # Per donation: an operator, two developers, a donor and a grantee.
    assert got.count() == 12_000 * 5


def test_hot_group_is_split_when_totals_go_back_to_rows(spark, small_splits):
    from fundlens.operators.groups import with_group_totals

    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(90_000, numPartitions=6).select(key.alias("k"), F.xxhash64("id").alias("v"))
    got = with_group_totals(df, ["k"], {"n": F.count(F.lit(1))})
    assert "skew=true" in final_plan(got)
    assert got.where("k = 0").agg(F.count(F.lit(1)), F.min("n"), F.max("n")).first() == (30_000, 30_000, 30_000)


def test_hot_tuple_is_split_when_components_go_back_to_rows(spark, rows, small_splits):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(60_000, numPartitions=6).select(F.col("id").alias("row_id"), *[F.concat(F.lit(c), hot).alias(c) for c in "abc"])
    got = projects.tuple_components(df, ["a", "b", "c"], 3)
    assert "skew=true" in final_plan(got)
    assert got.where("component = 0").count() == 20_000 and got.count() == 60_000


def test_hot_component_is_split_when_ids_are_assigned(spark, small_splits):
    component = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    components = spark.range(60_000, numPartitions=6).select(F.col("id").alias("row_id"), component.alias("component"))
    got = projects.assign_group_ids(components)
    assert "skew=true" in final_plan(got)
    assert got.select("group_id").distinct().count() == 40_001


def test_hot_sort_key_is_split(spark):
    from fundlens.operators.sets import order_lookup

    key = F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string"))
    got = order_lookup(spark.range(40_000, numPartitions=4).select(key.alias("group_id"), F.lit("x").alias("y")))
    assert got.columns == ["group_id", "y"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = got.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.group_id for r in placed] == sorted(r.group_id for r in placed)
    assert len({r.part for r in placed if r.group_id == "7"}) > 1
