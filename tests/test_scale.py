"""What is shuffled, grouped and sent to the driver stays narrow."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.views import VIEWS, Views
from fundlens import constants as K, session
from fundlens.llm import jaccard
from fundlens.operators import groups
from fundlens.plans import donations, gmv, projects, refresh
from fundlens.sources import schemas


def tables(spark, root, **frames):
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return Views(spark, str(root))


@pytest.fixture
def item_views(spark, rows, tmp_path):
    """Copies, missing keys, a supplier in two nations of one chain and two of another, parts that differ in hidden columns only."""
    return tables(
        spark, tmp_path,
        lineitem=rows([(1, 1), (1, 1), (1, 3), (2, 3), (2, 5), (None, 3), (2, None), (9, 3), (3, 5)], "l_partkey long, l_suppkey long"),
        supplier=rows([(1, 0), (1, 6), (3, 4), (3, 4), (5, 1), (5, 2), (None, 1)], "s_suppkey long, s_nationkey int"),
        part=rows(
            [(1, "n", 3, "b", "t", 1.0), (1, "n", 6, "b", "t", 1.001), (2, None, 1, "b", "t", 2.0), (2, None, 1, "c", "t", 2.0),
             (3, "m", None, "b", "t", None), (None, "x", 1, "b", "t", 1.0)],
            "p_partkey long, p_name string, p_size int, p_brand string, p_type string, p_retailprice double",
        ),
    )


def test_applications_are_distinct_over_keys_not_texts(item_views):
    got, plain = item_views.applications, item_views.sql(VIEWS["applications"])
    assert got.schema == plain.schema
    key = lambda r: tuple(map(str, r))
    assert sorted(got.collect(), key=key) == sorted(plain.collect(), key=key)
    narrow = got._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in narrow.split("\n") if "Aggregate [l_partkey" in line]
    assert grouped and all(line.count("#") == 4 for line in grouped)


def test_group_totals_do_not_pass_the_driver(spark):
    df = spark.range(2_000).select((F.col("id") % 7).alias("k"), "id")
    got = groups.with_group_totals(df, ["k"], {"n": F.count(F.lit(1))})
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_profiles_are_parsed_and_normalized_once(rows):
    text = '{"application":{"recipient":"0x%s","project":{"title":"%s"}}}'
    apps = rows(
        [("a", 1, 1.0, text % ("A" * 40, " Big,  One! ")), ("b", 1, 1.0, text % ("A" * 39, "x")), ("c", 1, 1.0, text % ("b" * 40, "!")), ("d", 1, 1.0, None)],
        "project_id string, chain_id int, total_amount_donated_in_usd double, metadata string",
    )
    past = apps.select("project_id", F.lit(None).cast("string").alias("title")).where("false")
    got = projects.normalize_projects(past, projects.indexed_profiles(apps))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("p{N}") == 1
    assert [(r.project_id, r.title, r.payout_address) for r in got.collect()] == [("a", "big one", "0x" + "a" * 40)]


def test_tuples_collapse_without_a_sort_of_all_rows(rows, monkeypatch):
    numbered = rows([(1, "a", "b", None), (2, "a", "b", None), (3, "a", "b", ""), (4, "a", None, None)], "row_id long, x string, y string, z string")
    plans = []
    cut = projects.cut_lineage
    monkeypatch.setattr(projects, "cut_lineage", lambda df, tag: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, tag))
    got = projects.tuple_components(numbered, ["x", "y", "z"], 2)
    assert "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_historical_donations_are_distinct_before_their_texts(rows):
    day = datetime(2020, 1, 2)
    given = rows(
        [("V1", 1, day, Decimal(5), "card"), ("v1", 1, day, Decimal(5), "cash"), ("v1", 2, day, Decimal(5), None), ("v1", None, None, None, None)],
        "voter_address string, grant_id long, created_on timestamp, amountUSD decimal(18,2), checkout_type string",
    )
    timings = rows([(7, datetime(2020, 1, 1), datetime(2020, 1, 9))], "round_num int, start_date timestamp, end_date timestamp")
    grants = rows([(1, "n", "0x1"), (1, "n", "0x1"), (1, "m", None)], "grantid long, name string, payoutaddress string")
    alpha = rows([("t", "r", Decimal(1), day, None)] * 2, "title string, round_name string, usd_amount decimal(18,2), block_time timestamp, donor string")
    places = rows([("t", "0x9"), ("t", "0x9"), ("t", "0x8")], "title string, address string")
    got = donations.historical_donations(alpha, places, given, timings, grants)
    short = lambda r: (r.round_num, r.round_name, r.donor_address, r.recipient_address, r.project_name, r.project_id, r.round_id, r.source)
    name = K.CONTRIBUTION_ROUND_PREFIX
    base = str(K.CONTRIBUTION_ROUND_ID_BASE + 7)
    cgrants, old = K.CONTRIBUTION_SOURCE, K.ALPHA_SOURCE
    assert sorted(map(short, got.collect()), key=str) == sorted(
        [
            (7, name + "7", "v1", "0x1", "n", "1", base, cgrants), (7, name + "7", "v1", None, "m", "1", base, cgrants),
            (7, name + "7", "v1", None, None, "2", base, cgrants), (None, name, "v1", None, None, None, None, cgrants),
            (16, "r", "0", "0x9", "t", "unknown", "", old), (16, "r", "0", "0x8", "t", "unknown", "", old),
        ],
        key=str,
    )
    grouped = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [" in line]
    # Payout details are grouped by themselves, never in the rows of the contributions.
    assert not any("payoutaddress" in line and "amount" in line for line in grouped)


def test_frames_that_events_read_twice_are_built_once(rows):
    empty = lambda ddl: rows([], ddl)
    got = gmv.gmv_events(
        empty(schemas.DONATIONS), empty(schemas.ROUNDS), empty(schemas.APPLICATIONS), empty(schemas.APPLICATIONS_PAYOUTS),
        empty(schemas.ROUND_ROLES), empty(schemas.MACI_CONTRIBUTIONS), empty(schemas.MACI_ROUNDS), empty(schemas.ROUND_ROLES),
        empty(schemas.EXTERNAL_EVENTS), empty("address STRING, name STRING"),
    )
    sources = [line for line in got._jdf.queryExecution().analyzed().toString().split("\n") if "LogicalRDD" in line or "LocalRelation" in line]
    # Donations once more for the grantees; payouts, and through them applications, not at all.
    assert sum("donor_address#" in line for line in sources) == 1
    assert not any("distribution_transaction#" in line for line in sources)


@pytest.fixture
def paid(rows):
    """Direct payouts with their applications: a copy, a missing key, an unknown round, a chain apart, amounts to drop."""
    at = datetime(2024, 2, 1)
    text = '{"application":{"recipient":"0xa","project":{"title":"%s"}}}'
    stages = rows([("r", 1, '{"name":"R"}', "s", "x", None, None, None)], "id string, chain_id int, round_metadata string, strategy_id string, "
                  "strategy_name string, matching_distribution string, match_amount_in_usd decimal(18,2), donations_end_time timestamp")
    apps = rows([("1", c, "r", "tx", text % t) for c, t in ((1, "T"), (1, "U"), (None, "N"))],
                "id string, chain_id int, round_id string, distribution_transaction string, metadata string")
    payouts = rows(
        [("1", "r", 1, Decimal("1.25"), at, "a"), ("1", "r", 10, Decimal("2.00"), at, "b"), ("1", "r", None, Decimal("3.00"), at, "c"),
         (None, "r", 1, Decimal("4.00"), at, "d"), ("1", "q", 1, Decimal("5.00"), at, "e"), ("1", "r", 1, Decimal("0.00"), at, "f"), ("1", "r", 1, None, at, "g")],
        "application_id string, round_id string, chain_id int, amount_in_usd decimal(18,2), timestamp timestamp, transaction_hash string",
    )
    return gmv.distribution_base(stages, apps, payouts)


def test_payouts_are_shuffled_as_narrow_as_they_are_read(paid):
    assert paid.schema["amount_in_usd"].dataType.simpleString() == gmv.AMOUNT
    got = sorted((r.transaction_hash, r.project_name or "", r.round_name or "", str(r.amount_in_usd)) for r in paid.collect())
    wide = lambda n: f"{n}000000"
    assert got == [
        ("a", "T", "R", wide("1.25")), ("a", "U", "R", wide("1.25")), ("b", "", "", wide("2.00")), ("c", "", "", wide("3.00")),
        ("d", "", "R", wide("4.00")), ("e", "", "", wide("5.00")),
    ]
    plan = paid._jdf.queryExecution().optimizedPlan().toString().split("\n")
    casts = [n for n, line in enumerate(plan) if "cast(amount_in_usd" in line]
    joins = [n for n, line in enumerate(plan) if "Join" in line and "application_id" in line]
    assert casts and joins and max(casts) < max(joins)


def test_token_steps_go_with_their_last_reader(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda spark: str(tmp_path))
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:40]), " ".join(words[:39]), " ".join(words[1:41]), " ".join(words[20:]), "alone", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similar_components(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5}
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "fundlens").iterdir()}
    assert "rows" in left and not left & {"heads", "shared", "texts", "nodes", "spread", "able", "stars", "members"}


def test_texts_without_links_are_not_shuffled(spark, tmp_path, monkeypatch):
    """However long the list of hashes is; a bitmap that is too small lets more rows pass and loses none."""
    monkeypatch.setattr(session, "checkpoint_root", lambda spark: str(tmp_path))
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 0, F.concat(F.lit("text "), F.col("id"))).alias("text"))
    docs = docs.unionByName(docs.where("doc_id = 50"))
    hashes = docs.where("doc_id % 50 = 0 and text is not null").select(F.xxhash64("text").alias("text_hash")).distinct()
    texts = session.Step(hashes, "texts", texts=F.count(F.lit(1)))
    wanted = sorted([50, *range(50, 5_000, 50)])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard._texts_of(docs, texts)
        assert sorted(r.doc_id for r in found.collect()) == wanted
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[1]
        # Deeper lines are read first: the bitmap is met before the rows are shuffled.
        assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning(text_hash") < plan.index("BroadcastHashJoin")
        for bits in (1, 2, 64, 2**16):
            monkeypatch.setattr(jaccard, "MOST_FILTER_BITS", bits)
            assert sorted(r.doc_id for r in jaccard._texts_of(docs, texts).collect()) == wanted
        none = session.Step(hashes.limit(0), "texts", texts=F.count(F.lit(1)))
        assert jaccard._texts_of(docs, none).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_shuffles_of_steps_go_with_their_write(spark, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(key), []
    search = jaccard._similar_components
    monkeypatch.setattr(jaccard, "_similar_components", lambda *args: seen.append(spark.conf.get(key)) or search(*args))
    docs = spark.createDataFrame([(2, "a b c d e f"), (1, "A b c d e f"), (3, None)], "doc_id long, text string")
    assert {tuple(r) for r in jaccard.similar_components(docs).collect()} == {(1, 2, 1), (2, 2, 1), (3, 0, 3)}
    assert seen == ["true"] and spark.conf.get(key) == before
    with pytest.raises(ValueError), session.shuffles_cleaned(spark):
        raise ValueError
    assert spark.conf.get(key) == before


def test_grants_on_test_chains_go_before_the_join(spark, rows, tmp_path):
    """Also where the chain is derived: Spark then infers no filter of the grants from that of the donations."""
    chain = F.when(F.col("net") == "main", 1).when(F.col("net") == "test", K.TEST_CHAIN_ID).alias("chain_id")
    text = '{"application":{"recipient":"0xa","project":{"title":"T"}}}'
    rows([("1", net, "r", "p", text) for net in ("main", "test", None)], "id string, net string, round_id string, project_id string, metadata string").write.parquet(f"{tmp_path}/apps")
    apps = spark.read.parquet(f"{tmp_path}/apps").select("id", chain, "round_id", "project_id", "metadata")
    at = datetime(2024, 2, 1)
    given = rows(
        [("1", "r", net, "d", Decimal("1.00"), at) for net in ("main", "test", None)],
        "application_id string, round_id string, net string, donor_address string, amount_in_usd decimal(18,2), timestamp timestamp",
    ).select("application_id", "round_id", chain, "donor_address", "amount_in_usd", "timestamp")
    rounds = rows([("r", 1, '{"name":"R"}')], "id string, chain_id int, round_metadata string")
    registry = rows([(1, "R", "3")], "chain_id int, round_id string, round_number string")
    past = rows([], "round_num int, round_name string, donor_address string, amount_in_usd decimal(18,2), recipient_address string, timestamp timestamp, "
                "project_name string, project_id string, round_id string, chain_id int, source string")
    got = donations.all_donations(given, apps, rounds, registry, past)
    assert [(r.round_num, r.round_name, r.project_name, r.chain_id) for r in got.collect()] == [(3, "R", "T", 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    (scan,) = [n for n, line in enumerate(plan) if "Relation" in line and "metadata" in line]
    # The test of the chain itself, which Spark folds into the cases, beside the one that it is known.
    assert "Filter (NOT CASE WHEN (net" in plan[scan - 1]


def test_published_tables_are_compressed(spark, tmp_path):
    (row,) = refresh.publish(spark, {"t": spark.range(10)}, str(tmp_path), 1, {"t": "id"})
    files = list((tmp_path / "version=1").rglob("*.parquet"))
    assert any(f.name.endswith(".zstd.parquet") for f in files)
    assert row[3:] == (10, "45.00000000") and spark.read.parquet(row[2]).count() == 10


def test_events_wait_for_few_shuffles(rows, spark):
    """Frames that are read again, and finished parts but the donors', are written; each write's shuffles go with it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    empty = lambda ddl: rows([], ddl)
    before, seen = spark.conf.get(key), {}

    def stage(df, name):
        seen[name] = spark.conf.get(key), df._jdf.queryExecution().analyzed().toString()
        return session.cut_lineage(df, name)

    got = gmv.gmv_events(
        empty(schemas.DONATIONS), empty(schemas.ROUNDS), empty(schemas.APPLICATIONS), empty(schemas.APPLICATIONS_PAYOUTS),
        empty(schemas.ROUND_ROLES), empty(schemas.MACI_CONTRIBUTIONS), empty(schemas.MACI_ROUNDS), empty(schemas.ROUND_ROLES),
        empty(schemas.EXTERNAL_EVENTS), empty("address STRING, name STRING"), stage,
    )
    assert {on for on, _ in seen.values()} == {"true"} and spark.conf.get(key) == before
    assert {"gmv_donated", "gmv_distributed", "gmv_events_of_grantees", "gmv_events_of_others"} <= set(seen)
    plan = got._jdf.queryExecution().analyzed().toString()
    # Donors are summed here; the totals that are shared out, except the voice credits, were summed before.
    assert plan.count("sum(amount_in_usd") == 1 and "sum(total" not in plan
    # Payouts on test chains go before they are joined.
    paid = seen["gmv_distributions"][1].split("\n")
    (read,) = [n for n, line in enumerate(paid) if "LogicalRDD" in line and "amount_in_usd#" in line and "transaction_hash#" in line]
    assert str(K.TEST_CHAIN_ID) in paid[read - 1]


def test_names_meet_parties_while_they_are_narrow(rows):
    at = datetime(2024, 2, 1)
    parties = rows(
        [(1, "r", "t", at, "a", Decimal("5.00")), (1, "r", "t", at, "b", Decimal("0.10")), (1, "q", "t", at, "c", Decimal("7.00")),
         (1, "r", "t", at, None, Decimal("9.00")), (None, "r", "t", at, "a", Decimal("9.00"))],
        "chain_id int, round_id string, tx_hash string, tx_timestamp timestamp, address string, total decimal(28,2)",
    )
    labelled = rows([(1, "r", "s", "pool")], "chain_id int, round_id string, strategy_name string, pool_name string")
    names = rows([("a", "one"), ("a", "uno")], "address string, name string")
    chains = rows([(1, "ethereum")], "chain_id int, chain_name string")
    got = gmv._party_events(parties, "donor", labelled, names, chains)
    assert got.columns == gmv.EVENT_COLUMNS
    assert sorted((r.address, r.name or "", r.pool_name or "", r.blockchain, r.gmv) for r in got.collect()) == [
        ("a", "one", "pool", "ethereum", 5.0), ("a", "uno", "pool", "ethereum", 5.0), ("c", "", "", "ethereum", 7.0),
    ]
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [line for line in plan if "Join LeftOuter" in line]
    # Deeper lines are read first.
    assert "address#" in joins[-1] and "round_id#" in joins[-2]
