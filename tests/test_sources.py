from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier
from time import sleep
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.jobs import refresh_inputs
from checks.views import Views
from fundlens import refresh as command, session
from fundlens.plans import graph, refresh
from fundlens.sources import files, readers, writers
from fundlens.sources.schemas import SCHEMAS

SMALL = "/root/testdata/sf0.001"


def test_csv_records(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('desc,amount_in_usd,timestamp\nRound,"$1,234.50",2024-01-01\n')
    got = readers.read_csv_records(spark, str(path), "desc STRING, amount_in_usd STRING, timestamp STRING")
    assert got.first().asDict() == {"desc": "Round", "amount_in_usd": "$1,234.50", "timestamp": "2024-01-01"}


def test_csv_columns_go_by_header_name(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("b,more,a\n2,x,1\n")
    assert readers.read_csv_records(spark, str(path), "a INT, b INT").first() == (1, 2)
    with pytest.raises(ValueError, match="missing"):
        readers.read_csv_records(spark, str(path), "a INT, c INT")
    path.write_text("a,b\n1,no number\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        readers.read_csv_records(spark, str(path), "a INT, b INT").collect()


def test_remote_tables_state_their_division(spark):
    with pytest.raises(ValueError, match="partition column"):
        readers.read_jdbc(spark, "jdbc:x:", {"t": []})


def test_publishes_of_other_tables_stay_visible(spark, tmp_path):
    root = str(tmp_path / "both")

    def put(live, *names):
        rows = refresh.publish(spark, {n: spark.range(3) for n in names}, root, writers.following_version(live), {})
        writers.switch_manifest(spark, root, rows, live)

    put(writers.current_manifest(spark, root), "a", "b")
    start = writers.current_manifest(spark, root)
    put(start, "c")
    put(start, "a")  # another run published c meanwhile, which is not a table of this one
    assert {r["table"]: r["version"] for r in writers.current_manifest(spark, root)} == {"a": 2, "b": 1, "c": 2}
    with pytest.raises(RuntimeError, match="another run"):
        put(start, "a")
    assert {n: df.count() for n, df in writers.current_tables(spark, root).items()} == {"a": 3, "b": 3, "c": 3}


def test_one_of_two_publishes_from_one_state_wins(spark, tmp_path):
    root = str(tmp_path / "race")
    start = writers.current_manifest(spark, root)
    staged = [refresh.publish(spark, {"a": spark.range(n)}, root, 1, {}) for n in (3, 4, 5, 6)]
    together = Barrier(len(staged))

    def switch(rows):
        together.wait()
        try:
            writers.switch_manifest(spark, root, rows, start)
        except RuntimeError:
            return None
        return rows[0][2]

    with ThreadPoolExecutor(len(staged)) as pool:
        winners = [path for path in pool.map(switch, staged) if path]
    assert len(winners) == 1 and [r["path"] for r in writers.current_manifest(spark, root)] == winners
    assert len(writers.manifest_files(spark, root)) == 1


def test_files_are_put_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/once/x.json"
    assert files.put_if_absent(spark, path, "first\n") and not files.put_if_absent(spark, path, "second\n")
    assert files.read_text(spark, path) == "first\n"
    assert [p.rsplit("/", 1)[1] for p in files.list_folder(spark, f"{tmp_path}/once") if not p.endswith(".crc")] == ["x.json"]
    assert files.list_folder(spark, f"{tmp_path}/nothing") == []


def test_old_versions_go_and_live_ones_stay(spark, tmp_path):
    root = str(tmp_path / "kept")
    for n in (1, 2, 3, 4):
        live = writers.current_manifest(spark, root)
        names = ["a", "b"] if n < 3 else ["a"]
        rows = refresh.publish(spark, {name: spark.range(n) for name in names}, root, writers.following_version(live), {})
        writers.switch_manifest(spark, root, rows, live)
    refresh.publish(spark, {"a": spark.range(9)}, root, 5, {})  # a run that failed before its switch
    listed = {(r["table"], r["version"]): r["path"] for r in writers.read_manifest(spark, root).collect()}
    assert writers.clean_versions(spark, root, keep=2, older_than_seconds=3600) == []
    gone = writers.clean_versions(spark, root, keep=2, older_than_seconds=-1)
    assert len(gone) == 3 and {p for p in listed.values() if not Path(p).exists()} == {listed["a", 1], listed["a", 2]}
    assert {n: df.count() for n, df in writers.current_tables(spark, root).items()} == {"a": 4, "b": 2}
    assert writers.clean_versions(spark, root, keep=1, older_than_seconds=-1) != []
    assert {n: df.count() for n, df in writers.current_tables(spark, root).items()} == {"a": 4, "b": 2}
    rows = refresh.publish(spark, {"b": spark.range(7)}, root, writers.next_version(spark, root), {})
    writers.switch_manifest(spark, root, rows)
    assert {n: df.count() for n, df in writers.current_tables(spark, root).items()} == {"a": 4, "b": 7}
    with pytest.raises(ValueError, match="live"):
        writers.clean_versions(spark, root, keep=0, older_than_seconds=-1)


def test_old_steps_go(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "checkpoint_root", lambda spark: str(tmp_path))
    step = session.Step(spark.range(5), "mine", n=F.count(F.lit(1)))
    assert step.seen == {"n": 5}
    assert session.clean_steps(spark, 3600) == [] and step.frame.count() == 5
    assert len(session.clean_steps(spark, -1)) == 1 and not Path(step.path).exists()
    empty = session.Step(spark.range(0), "none", n=F.count(F.lit(1)))
    assert empty.seen == {"n": 0}
    empty.remove()
    assert session.clean_steps(spark, -1) == []


def test_latest_version_reads_only_the_newest_directory(spark, tmp_path):
    for name in ["chain_data_86", "chain_data_93", "chain_data_100", "chain_data_9"]:
        spark.range(2).withColumn("n", F.lit(name)).write.parquet(f"{tmp_path}/schema={name}")
    got = readers.latest_version(spark.read.parquet(str(tmp_path)), "schema")
    assert {r.n for r in got.collect()} == {"chain_data_100"}
    assert "PartitionFilters: [(cast(substring(" in got._jdf.queryExecution().executedPlan().toString()


def test_newest_schema_folder_alone_is_opened(spark, tmp_path):
    for name in ["chain_data_86", "chain_data_93", "chain_data_100", "chain_data_9", "chain_data_x1", "chain_data_1000", "other_200"]:
        (tmp_path / name / "donations").mkdir(parents=True)
        (tmp_path / name / "donations" / "part-0.parquet").write_text("not readable")
    with pytest.raises(Exception, match="not a Parquet|FAILED_READ|CANNOT_READ"):
        readers.read_newest(spark, str(tmp_path), "donations")
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/chain_data_100/donations")
    got = readers.read_newest(spark, str(tmp_path), "donations", "id BIGINT")
    assert got.count() == 4 and all("/chain_data_100/" in f for f in got.inputFiles())
    with pytest.raises(ValueError, match="no folder"):
        readers.newest_schema(spark, str(tmp_path), "absent_")


def test_jdbc_options():
    got = readers.jdbc_options("jdbc:x:", "s.t", "id", (1, 9), 4, user="u")
    assert got["dbtable"] == "s.t" and got["numPartitions"] == "4" and got["user"] == "u"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x:", "t", "id")


def test_scan_reads_named_columns_only_and_pushes_filters(spark):
    rows = readers.read_table(spark, SMALL, "lineitem.parquet", "l_orderkey BIGINT, l_quantity DOUBLE, l_tax DOUBLE")
    plan = rows.where("l_quantity > 49").select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_catalog_table_is_replaced(spark):
    writers.write_replace(spark.range(3), "replaced")
    assert writers.write_replace(spark.range(5).withColumn("x", F.lit(1)), "replaced").columns == ["id", "x"]
    assert readers.run_query(spark, "SELECT COUNT(*) AS n FROM {t}", t=spark.table("replaced")).first().n == 5


def test_snapshot_is_never_overwritten(spark, tmp_path):
    writers.snapshot(spark.range(3), str(tmp_path), "v1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.snapshot(spark.range(4), str(tmp_path), "v1")


def test_shuffles_grow_with_the_input():
    assert [session.shuffle_partitions(n) for n in (0, 10**12, 10**14, 10**16)] == [200, 1863, 50_000, 50_000]


def test_shared_folder_comes_from_the_session(spark):
    assert session.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    path = session.staging_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != session.staging_path(spark, "x")


def test_refresh_publishes_all_tables_at_once(spark, tmp_path):
    root = str(tmp_path / "published")
    base_sources, others = refresh_inputs(Views(spark, SMALL))
    first = {r.table_name: r for r in refresh.refresh_all(spark, base_sources, others, root).collect()}
    assert len(first) == 7 and all(r.old_total is None and r.status is None for r in first.values())
    before = writers.current_tables(spark, root)
    assert set(before) == {
        "applications", "rounds", "donations", "applications_payouts", "round_roles", "indexer_matching", "all_donations",
        "all_matching", "allo_gmv_leaderboard_events", "allov2_distribution_events_for_leaderboard",
    }
    counts = {n: df.count() for n, df in before.items()}

    # A failed run leaves the published version as it was.
    with pytest.raises(ValueError, match="empty"):
        refresh.refresh_all(spark, base_sources, others | {"external_events": others["external_events"].limit(0)}, root)
    assert {r["version"] for r in writers.current_manifest(spark, root)} == {1}

    fewer = base_sources | {"donations": {"indexer": base_sources["donations"]["indexer"].where("amount_in_usd < 500")}}
    second = {r.table_name: r.status for r in refresh.refresh_all(spark, fewer, others, root).collect()}
    assert second["donations"] == "decreased" and second["rounds"] == "unchanged"
    assert {n: df.count() for n, df in before.items()} == counts, "readers of the first version still see it whole"
    assert {r["version"] for r in writers.current_manifest(spark, root)} == {2}


def test_project_refresh_publishes_both_tables(spark, tmp_path):
    root = str(tmp_path / "projects")
    v = Views(spark, SMALL)
    first = refresh.refresh_projects(spark, v.past_grants, v.past_contributions, v.applications, root).collect()
    assert [(r.table_name, r.status) for r in first] == [("project_groups_summary", None)]
    tables = writers.current_tables(spark, root)
    lookup, summary = tables["project_lookup"], tables["project_groups_summary"]
    assert lookup.select("group_id").distinct().count() == summary.count()
    assert summary.agg(F.sum("application_count")).first()[0] == lookup.count()
    again = refresh.refresh_projects(spark, v.past_grants, v.past_contributions, v.applications, root).collect()
    assert [r.status for r in again] == ["unchanged"]


def test_a_stopped_refresh_goes_on_from_its_staged_tables(spark, tmp_path):
    root = str(tmp_path / "published")
    base_sources, others = refresh_inputs(Views(spark, SMALL))
    broken = others | {"names": others["names"].select("address")}
    with pytest.raises(Exception, match="name"):
        refresh.refresh_all(spark, base_sources, broken, root, run="monday")
    assert writers.current_manifest(spark, root) == []
    half = refresh.Staging(spark, root, 1, {}, "monday")
    assert {"rounds", "donations", "applications", "applications_payouts"} <= half.taken_over
    assert "allo_gmv_leaderboard_events" not in half.taken_over
    # Sources that cannot be read any more show that nothing staged is built again.
    gone = {name: {"indexer": spark.range(1)} for name in half.taken_over & set(base_sources)}
    refresh.refresh_all(spark, base_sources | gone, others, root, run="monday")
    paths = {r["table"]: r["path"] for r in writers.current_manifest(spark, root)}
    assert len(paths) == 10 and all(paths[name] == half.rows[name][2] for name in half.taken_over)
    # The next version begins anew under the same name, and agrees with a run without one.
    refresh.refresh_all(spark, base_sources, others, root, run="monday")
    again = {r["table"]: (r["version"], r["row_count"], r["total"]) for r in writers.current_manifest(spark, root)}
    refresh.refresh_all(spark, base_sources, others, root)
    for row in writers.current_manifest(spark, root):
        assert (row["row_count"], row["total"]) == again[row["table"]][1:] and again[row["table"]][0] == 2


def test_jobs_run_at_once_and_in_order(spark):
    together = Barrier(2, timeout=60)
    order = []

    def side(tables):
        together.wait()  # passes only while both sides run
        return spark.range(2)

    jobs = {
        "last": graph.Job(lambda t: t["a"].join(t["b"], "id"), ("a", "b")),
        "a": graph.Job(side), "b": graph.Job(side),
    }

    def write(name, build):
        frame = build()
        order.append(name)
        return frame

    done = graph.run_jobs(spark, jobs, write, at_once=2)
    assert order[2] == "last" and done["last"].count() == 2
    assert graph.run_jobs(spark, {}, write) == {}
    for wrong, message in [({"a": graph.Job(side, ("x",))}, "no job makes"), ({"a": graph.Job(side, ("a",))}, "each other")]:
        with pytest.raises(ValueError, match=message):
            graph.run_jobs(spark, wrong, write)


def test_no_job_starts_after_a_failure(spark):
    started = []

    def write(name, build):
        started.append(name)
        return build()

    def fail(tables):
        raise OSError("no space")

    jobs = {"a": graph.Job(fail)} | {f"b{i}": graph.Job(lambda t: spark.range(1), ("a",)) for i in range(3)}
    with pytest.raises(OSError, match="no space"):
        graph.run_jobs(spark, jobs, write, at_once=1)
    assert started == ["a"]


def test_the_command_publishes_landed_tables(spark, tmp_path, capsys, monkeypatch):
    base_sources, others = refresh_inputs(Views(spark, SMALL))
    inputs, root = tmp_path / "landed", str(tmp_path / "published")

    def whole(name, frame):
        """With the columns that the test views leave out."""
        missing = [f for f in StructType.fromDDL(SCHEMAS[name]) if f.name not in frame.columns]
        return frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})

    for name, sources in base_sources.items():
        for source, frame in sources.items():
            whole(name, frame).write.parquet(f"{inputs}/{source}/{name}")
    for name in set(command.OTHERS) - {"round_roles"}:
        whole(name, others[name]).withColumn("unknown_column", F.lit(1)).write.parquet(f"{inputs}/others/{name}")
    command.main(["--inputs", str(inputs), "--root", root, "--run", "one", "--keep", "1"])
    lines = capsys.readouterr().out.splitlines()
    assert any(line.startswith("donations\t") for line in lines)
    by_hand = str(tmp_path / "by_hand")
    refresh.refresh_all(spark, base_sources, others, by_hand)
    expected = {r["table"]: (r["row_count"], r["total"]) for r in writers.current_manifest(spark, by_hand)}
    assert {r["table"]: (r["row_count"], r["total"]) for r in writers.current_manifest(spark, root)} == expected
    spark.range(1).write.mode("overwrite").parquet(f"{inputs}/others/names")
    with pytest.raises(ValueError, match="lacks columns"):
        command.landed_inputs(spark, str(inputs))


def test_one_large_table_at_a_time(spark):
    large, most, order = [], [], []

    def build(name):
        def run(tables):
            large.append(name)
            most.append(len(large))
            sleep(0.3)
            large.remove(name)
            order.append(name)
            return spark.range(1)

        return run

    jobs = {n: graph.Job(build(n), large=True) for n in ("c", "a", "b")} | {"d": graph.Job(build("d"), ("a",), large=True)}
    graph.run_jobs(spark, jobs, lambda name, build: build())
    assert max(most) == 1 and order[0] == "c" and sorted(order) == ["a", "b", "c", "d"]


def test_a_table_in_parts_has_the_totals_of_all(spark, tmp_path):
    staging = refresh.Staging(spark, str(tmp_path), 1, {"t": "x", "z": "x"})
    parts = [spark.range(n).select(F.lit(0.25).alias("x"), F.col("id")) for n in (3, 0, 2)]
    assert staging.write("t", lambda: iter(parts)).count() == 5
    assert staging.rows["t"][3:] == (5, "1.25000000")
    assert staging.write("z", lambda: iter([parts[1]])).count() == 0 and staging.rows["z"][3:] == (0, "0.00000000")


def test_pieces_of_the_rounds_add_up(spark, tmp_path, monkeypatch):
    base_sources, others = refresh_inputs(Views(spark, SMALL))
    shared = tmp_path / "shared"
    monkeypatch.setattr(refresh, "staging_path", lambda spark, tag: f"{shared}/{tag}-{uuid4().hex}")
    manifests, seen = [], []
    write = refresh.write_files
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    monkeypatch.setattr(refresh, "write_files", lambda df, *args: seen.append(spark.conf.get(key)) or write(df, *args))
    for size in (refresh.ROWS_PER_PIECE, 2_000):
        monkeypatch.setattr(refresh, "ROWS_PER_PIECE", size)
        root = str(tmp_path / f"by_{size}")
        refresh.refresh_all(spark, base_sources, others, root)
        manifests.append({r["table"]: (r["row_count"], r["total"]) for r in writers.current_manifest(spark, root)})
        # What the events were built from is gone.
        assert list(shared.iterdir()) == []
        tables = writers.current_tables(spark, root)
        for name in ("all_donations", "allo_gmv_leaderboard_events"):
            assert tables[name].count() == manifests[-1][name][0]
    assert manifests[0] == manifests[1] and set(seen) == {"true"}
    assert refresh.round_pieces(tables["donations"]) > 1


def test_each_row_is_in_one_piece(rows):
    df = rows([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v int")
    pieces = [{r.v for r in refresh.piece_of(df, "k", 3, i).collect()} for i in range(3)]
    assert sorted(v for p in pieces for v in p) == [1, 2, 3, 4] and any({1, 2} <= p for p in pieces)
