from collections import Counter, defaultdict
from datetime import datetime, timedelta
from itertools import combinations
from pathlib import Path
import random

import pytest
from pyspark.sql import functions as F

from fundlens import session
from fundlens.operators import dedup, filters, groups, joins, linking, numbering, sets
from fundlens.plans import projects


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dedup_prefers_source_then_smallest_row(rows):
    schema = "id STRING, v INT"
    live = rows([("a", 5), ("a", 3), ("b", None), ("b", 9)], schema)
    old = rows([("a", 1), ("c", 2), ("c", 2)], schema)
    got = dedup.dedup_by_priority({"static": old, "indexer": live}, ["id"], ["indexer", "static"])
    assert tuples(got) == [("a", 3, "indexer"), ("b", 9, "indexer"), ("c", 2, "static")]


def test_dedup_drops_copies_before_the_shuffle(rows):
    df = dedup.dedup_by_priority({"indexer": rows([("a", 1)], "id STRING, v INT")}, ["id"], ["indexer"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_counts_a_missing_time_as_newest(rows):
    data = [("g", 1, None), ("g", 2, datetime(2024, 1, 1)), ("h", 3, datetime(2024, 1, 1)), ("h", 4, datetime(2024, 1, 1))]
    got = dedup.latest_per_group(rows(data, "g STRING, id INT, ts TIMESTAMP"), "g", "ts", "id")
    assert [r[1] for r in tuples(got)] == [1, 4]


def test_uniqueness_ignores_null_keys(rows):
    ok = rows([("a", 1), (None, 1), (None, 1)], "k STRING, v INT")
    assert dedup.assert_unique(ok, ["k"]) is ok
    with pytest.raises(ValueError, match="not unique"):
        dedup.assert_unique(rows([("a", 1), ("a", 2)], "k STRING, v INT"), ["k"])


def test_group_totals_equal_a_window(rows):
    data = [("hot", i) for i in range(20)] + [("b", 1), ("b", 2), ("c", 7), (None, 4), (None, 5)]
    df = rows(data, "k STRING, v INT")
    got = groups.with_group_totals(df, ["k"], {"s": F.sum("v"), "n": F.count(F.lit(1))})
    want = {k: (sum(v for kk, v in data if kk == k), sum(kk == k for kk, _ in data)) for k, _ in data}
    assert Counter(map(tuple, got.collect())) == Counter((k, v, *want[k]) for k, v in data)


def test_group_totals_hint_no_broadcast(rows):
    df = rows([("hot", i) for i in range(50)], "k STRING, v INT")
    plan = groups.with_group_totals(df, ["k"], {"s": F.sum("v")})._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan and "_place" in plan, "the extra key keeps the join on two shuffles"


def test_round_operators_count_an_address_once(rows):
    data = [(1, "r", "a", "ADMIN"), (1, "r", "a", "MANAGER"), (1, "r", "b", "ADMIN"), (2, "r", "a", "ADMIN")]
    got = groups.round_operators(rows(data, "chain_id INT, round_id STRING, address STRING, role STRING"))
    assert sorted((r.chain_id, r.address, r.count_addresses) for r in got.collect()) == [(1, "a", 2), (1, "b", 2), (2, "a", 1)]


def test_control_total_of_nothing_is_zero(rows):
    assert groups.control_total(rows([(None,)], "x DECIMAL(18,2)"), "x").first()[0] == 0


def test_blocks_cover_an_interval_once(spark):
    rng = random.Random(6)
    spans = [(0, 0), (-1, 0), (5, 4), (0, 18_262), (-9_000, 9_261), (1, 2**21)] + [
        (a, a + rng.choice([0, 1, 2, 7, 150, 4000])) for a in (rng.randrange(-500, 500) for _ in range(60))
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i INT, a BIGINT, b BIGINT")
    for r in df.select("i", joins.interval_blocks(F.col("a"), F.col("b")).alias("blocks")).collect():
        a, b = spans[r.i]
        parts = sorted((x.block << x.level, (x.block + 1) << x.level) for x in r.blocks)
        assert len(parts) <= 64, "also for a window of fifty years and more"
        assert not parts if a > b else (parts[0][0], parts[-1][1]) == (a, b + 1)
        assert all(x[1] == y[0] for x, y in zip(parts, parts[1:]))


def test_windows_of_any_length(spark):
    rng = random.Random(8)
    second = lambda: datetime(1960, 1, 1) + timedelta(seconds=rng.randrange(75 * 366 * 86_400))
    windows = [(i, *sorted([second(), second()])) for i in range(40)] + [(90, datetime(1969, 12, 31, 23), datetime(1970, 1, 1, 1))]
    events = [(i, second()) for i in range(300)] + [(900, datetime(1970, 1, 1)), (901, windows[0][1]), (902, None)]
    got = joins.assign_round_by_time(
        spark.createDataFrame(events, "id INT, ts TIMESTAMP"), spark.createDataFrame(windows, "round_num INT, start_date TIMESTAMP, end_date TIMESTAMP"), "ts"
    )
    want = Counter()
    for i, t in events:
        inside = [n for n, a, b in windows if t is not None and a < t < b]
        want.update((i, n) for n in inside or [None])
    assert Counter((r.id, r.round_num) for r in got.collect()) == want


def test_range_join_edges_overlap_and_gaps(rows):
    day = lambda d, h=0: datetime(2024, 1, d, h)
    windows = rows(
        [(1, day(1), day(5)), (2, day(4), day(9, 12)), (3, day(9), day(9)), (4, None, day(9))],
        "round_num INT, start_date TIMESTAMP, end_date TIMESTAMP",
    )
    events = rows([(i, t) for i, t in enumerate([day(1), day(1, 1), day(4, 12), day(5), day(9, 12), day(20), None])], "id INT, ts TIMESTAMP")
    got = joins.assign_round_by_time(events, windows, "ts").select("id", "round_num")
    assert tuples(got) == sorted([(0, None), (1, 1), (2, 1), (2, 2), (3, 2), (4, None), (5, None), (6, None)], key=repr)


def test_registry_joins_keep_their_case_rules(rows):
    apps = rows([("1", "0xAB", 1), ("2", "0xab", 1), ("3", "0xAB", 2)], "id STRING, round_id STRING, chain_id INT")
    registry = rows([("7", "0XaB", 1)], "round_number STRING, round_id STRING, chain_id INT")
    assert [r.round_num for r in joins.attach_registry(apps, registry).orderBy("id").collect()] == ["7", "7", None]
    rounds = rows([("0xAB", 1, '{"name":"n"}')], "id STRING, chain_id INT, round_metadata STRING")
    assert [r.round_name for r in joins.attach_round_name(apps, rounds).orderBy("id").collect()] == [None, None, None]


def test_explode_drops_missing_and_empty_lists(rows):
    docs = ['{"matchingDistribution":[{"projectId":"p"},{"projectId":null}]}', '{"matchingDistribution":[]}', "{}", None]
    df = rows([(i, d) for i, d in enumerate(docs)], "id INT, matching_distribution STRING")
    assert [(r.id, r.entry.projectId) for r in joins.explode_distribution(df).collect()] == [(0, "p"), (0, None)]


def test_lookup_join_is_broadcast_and_others_are_not_hinted(spark, rows):
    from fundlens.sources.readers import chain_mapping

    named = joins.attach_chain_name(rows([(1,), (5,), (None,)], "chain_id INT"), chain_mapping(spark))
    assert {(r.chain_id, r.blockchain) for r in named.collect()} == {(1, "ethereum"), (5, None), (None, None)}


def test_order_totals_puts_null_first(rows):
    got = sets.order_totals(rows([(1.0,), (None,), (3.0,)], "`Total USD` DOUBLE"))
    assert [r[0] for r in got.collect()] == [None, 3.0, 1.0]


def test_union_distinct_treats_nulls_as_equal(rows):
    a = rows([(None, 1), ("x", 1)], "a STRING, b INT")
    b = rows([(1, None), (1, "x"), (2, "y")], "b INT, a STRING")
    assert tuples(sets.union_distinct(a, b)) == sorted([(None, 1), ("x", 1), ("y", 2)], key=repr)


def test_filters_drop_null_chain_and_strategy(rows):
    df = rows([(1, "a"), (11155111, "a"), (None, "a"), (1, None), (1, "b")], "chain_id INT, strategy_name STRING")
    kept = filters.drop_strategy(filters.drop_test_chains(df), "b")
    assert tuples(kept) == [(1, "a")]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_number_rows_in_order_with_copies_and_nulls(rows, partitions):
    data = [("b", 2), ("a", 1), (None, 0), ("a", 1), ("a", 0)] + [("hot", 5)] * 40
    got = numbering.number_rows(rows(data, "k STRING, v INT"), ["k"], "n", partitions).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, len(data) + 1))
    assert [(r.k, r.v) for r in got] == sorted(data, key=lambda d: (d[0] is None, d[0] or "", d[1]))


def brute_force_components(people, attributes, k):
    shared = Counter()
    for name in attributes:
        by_value = defaultdict(list)
        for i, p in enumerate(people):
            if p[name] is not None:
                by_value[p[name]].append(i)
        for members in by_value.values():
            shared.update(combinations(members, 2))
    label = list(range(len(people)))
    changed = True
    while changed:
        changed = False
        for (a, b), n in shared.items():
            low = min(label[a], label[b])
            if n >= k and (label[a] != low or label[b] != low):
                label[a] = label[b] = low
                changed = True
    return dict(enumerate(label))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_pair_counting(rows, seed):
    rng = random.Random(seed)
    attributes = ["a", "b", "c", "d", "e"]
    people = [{x: rng.choice([None, "u", "v", "w", "x", "y"]) for x in attributes} for _ in range(60)]
    df = rows([(i, *[p[x] for x in attributes]) for i, p in enumerate(people)], "row_id BIGINT, a STRING, b STRING, c STRING, d STRING, e STRING")
    edges = linking.k_of_n_links(df, attributes, 3)
    got = {r.row_id: r.component for r in linking.connected_components(edges, df).collect()}
    assert got == brute_force_components(people, attributes, 3)


@pytest.mark.parametrize("seed", [3, 4])
def test_components_over_tuples_equal_those_over_rows(rows, seed):
    rng = random.Random(seed)
    attributes = ["a", "b", "c", "d", "e"]
    people = [{x: rng.choice([None, None, "", "u", "v"]) for x in attributes} for _ in range(90)]
    df = rows([(i, *[p[x] for x in attributes]) for i, p in enumerate(people)], "row_id BIGINT, a STRING, b STRING, c STRING, d STRING, e STRING")
    got = {r.row_id: r.component for r in projects.tuple_components(df, attributes, 3).collect()}
    assert got == brute_force_components(people, attributes, 3)
    assert projects.tuple_components(df.limit(0), attributes, 3).count() == 0


def test_component_rounds_are_removed(spark, rows):
    folder = Path(session.staging_path(spark, "x")).parent
    before = set(folder.glob("*")) if folder.exists() else set()
    edges = rows([(i, i + 1) for i in range(30)], "src BIGINT, dst BIGINT")
    got = linking.connected_components(edges, rows([(i,) for i in range(31)], "row_id BIGINT"))
    left = [p.name for p in set(folder.glob("*")) - before]
    assert len(left) == 1 and left[0].startswith("components-"), "the last round alone is kept"
    assert {r.component for r in got.collect()} == {0}


def test_components_of_long_paths_and_two_minima(spark, rows):
    path = [(i, i + 1) for i in range(40)]
    random.Random(3).shuffle(path)
    edges = rows(path + [(103, 101), (103, 102)], "src BIGINT, dst BIGINT")
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 101, 102, 103, 200]], "row_id BIGINT")
    got = {r.row_id: r.component for r in linking.connected_components(edges, nodes).collect()}
    assert got == {**{i: 0 for i in range(41)}, 101: 101, 102: 101, 103: 101, 200: 200}


def test_links_do_not_list_pairs(rows):
    df = rows([(i, "t", "w", "p") for i in range(50)], "row_id BIGINT, a STRING, b STRING, c STRING")
    assert linking.k_of_n_links(df, ["a", "b", "c"], 3).count() == 49
    groups_found = linking.shared_attribute_groups(df, ["a"]).collect()
    assert [(r.value, r.members, r.pairs) for r in groups_found] == [("t", 50, 1225)]


def test_stack_widens_and_never_narrows(rows):
    cents, exact = rows([(1, "a")], "v INT, k STRING"), rows([(2, "b")], "v INT, k STRING")
    cents, exact = (df.withColumn("v", F.lit(x).cast(t)) for df, x, t in [(cents, "1.5", "decimal(18,2)"), (exact, "2.0049", "decimal(18,4)")])
    assert [str(r.v) for r in sets.stack([cents, exact]).orderBy("v").collect()] == ["1.5000", "2.0049"]
    with pytest.raises(ValueError, match="extra"):
        sets.stack([cents, exact.withColumn("extra", F.lit(1))])
    with pytest.raises(TypeError):
        sets.stack([cents, exact.withColumn("k", F.lit(1))])


def test_literals_of_time_are_in_the_session_zone(rows):
    """The plan holds midnight in UTC, whatever the zone of the system is."""
    data = [(datetime(2024, 1, 1), None, "x")]
    df = rows(data, "donations_end_time TIMESTAMP, applications_start_time TIMESTAMP, strategy_name STRING")
    plan = filters.active_since(df, "2024-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-01 00:00:00" in plan or "1704067200000000" in plan
    limit = filters.until(df, "donations_end_time", datetime(2024, 1, 1))._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-01 00:00:00" in limit or "1704067200000000" in limit
