from collections import Counter, defaultdict
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fundlens import constants as K
from fundlens.operators import groups, sets
from fundlens.plans import base, donations, gmv, ingest, matching, projects
from fundlens.plans import rounds as round_jobs
from fundlens.sources import schemas
from fundlens.sources.readers import chain_mapping

D = Decimal
T0 = datetime(2024, 5, 1)


def table(rows, schema, *records):
    """Rows from dicts; columns that a dict leaves out are NULL."""
    names = rows([], schema).columns
    return rows([tuple(r.get(n) for n in names) for r in records], schema)


def round_row(rid, chain=1, **more):
    return {"id": rid, "chain_id": chain, "round_metadata": f'{{"name":"{rid}"}}', "strategy_name": K.QF_V1} | more


def donation(i, rid="0xr", **more):
    return {
        "id": str(i), "chain_id": 1, "round_id": rid, "application_id": "7", "donor_address": "d", "amount": "1",
        "recipient_address": "g", "amount_in_usd": D("10.00"), "transaction_hash": "t", "timestamp": T0,
    } | more


APPLICATION = {
    "id": "7", "chain_id": 1, "round_id": "0xR", "project_id": "p",
    "metadata": '{"application":{"recipient":"g","project":{"title":"Title"}}}',
}


# --- base tables -----------------------------------------------------------------


def test_base_table_drops_test_chain_and_keeps_source(rows):
    live = table(rows, schemas.ROUNDS, round_row("a"), round_row("t", K.TEST_CHAIN_ID), round_row("n", None))
    old = table(rows, schemas.ROUNDS, round_row("a", strategy_name="old"), round_row("b"))
    got = base.base_tables({"rounds": {"indexer": live, "static": old}})["rounds"]
    assert "row_num" not in got.columns
    assert {(r.id, r.source, r.strategy_name) for r in got.collect()} == {
        ("a", "indexer", K.QF_V1), ("b", "static", K.QF_V1),
    }


def test_sample_applies_to_the_large_tables_only(rows):
    many = table(rows, schemas.DONATIONS, *[donation(i) for i in range(9)])
    assert base.base_table("donations", {"indexer": many}, sample=4).count() == 4
    many = table(rows, schemas.ROUNDS, *[round_row(str(i)) for i in range(9)])
    assert base.base_table("rounds", {"indexer": many}, sample=4).count() == 9


# --- donations -------------------------------------------------------------------


def unified(rows, given, registry):
    empty = table(rows, schemas.STATIC_DONATIONS)
    apps = table(rows, schemas.APPLICATIONS, APPLICATION)
    return donations.all_donations(
        table(rows, schemas.DONATIONS, *given), apps, table(rows, schemas.ROUNDS, round_row("0xr")),
        table(rows, schemas.REGISTRY, *registry), empty,
    ).collect()


def test_equal_donations_collapse_and_unregistered_rounds_have_no_id(rows):
    given = [donation(i, "0xR", transaction_hash=str(i)) for i in range(3)] + [donation(9, "0xR", donor_address="e")]
    got = unified(rows, given, [])
    assert len(got) == 2 and all(r.donation_id is None and r.round_num is None for r in got)
    assert {r.round_name for r in got} == {"0xr"}, "the round name is found by the lower-cased id"


def test_registered_donation_has_an_id_of_its_parts(rows):
    import hashlib

    got = unified(rows, [donation(1, "0xR")], [{"round_number": "19", "chain_id": 1, "round_id": "0XR"}])
    text = "19" + "d" + "10.00" + "g" + "2024-05-01 00:00:00" + "p" + "0xR" + "1"
    assert [(r.round_num, r.donation_id) for r in got] == [(19, hashlib.sha256(text.encode()).hexdigest())]


def test_historical_donations(rows):
    day = lambda d: datetime(2024, 1, d)
    contributions = rows(
        [("V", 1, day(2), D(5), "eth_std"), ("V", 1, day(1), D(5), "x"), ("V", 9, day(2), D(5), "eth_zksync")],
        "voter_address STRING, grant_id BIGINT, created_on TIMESTAMP, amountUSD DECIMAL(18,2), checkout_type STRING",
    )
    timings = rows([(3, day(1), day(5))], "round_num INT, start_date TIMESTAMP, end_date TIMESTAMP")
    grants = rows([(1, "G", "0xg")], "grantid BIGINT, name STRING, payoutaddress STRING")
    alpha = rows(
        [("A", "R", D(2), day(3), "OXAB"), ("B", "R", D(2), day(3), None)],
        "title STRING, round_name STRING, usd_amount DECIMAL(18,2), block_time TIMESTAMP, donor STRING",
    )
    addresses = rows([("A", "0x1"), ("A", "0x2")], "title STRING, address STRING")
    got = donations.historical_donations(alpha, addresses, contributions, timings, grants).collect()
    seen = {(r.round_num, r.round_name, r.round_id, r.donor_address, r.recipient_address, r.chain_id) for r in got}
    prefix = K.CONTRIBUTION_ROUND_PREFIX
    assert seen == {
        (3, prefix + "3", "100003", "v", "0xg", 1),
        (None, prefix, None, "v", "0xg", 0),
        (3, prefix + "3", "100003", "v", None, 324),
        (16, "R", "", "0xab", "0x1", 1),
        (16, "R", "", "0xab", "0x2", 1),
        (16, "R", "", "0", None, 1),
    }


# --- matching --------------------------------------------------------------------

DISTRIBUTION = '{"blockTimestamp":"2024-05-01T10:11:12.345Z","matchingDistribution":[{"projectId":"p1","projectName":"A","applicationId":"7","matchPoolPercentage":"0.25","projectPayoutAddress":"g"}]}'


def test_matching_ids_differ_between_branches(rows):
    rounds = table(rows, schemas.ROUNDS, round_row("0xr", matching_distribution=DISTRIBUTION, match_amount_in_usd=D(100)))
    paid = matching.matching_payouts(rounds)
    row = paid.first()
    assert (row.match_amount_in_usd, row.timestamp) == (25.0, datetime(2024, 5, 1, 10, 11, 12, 345000))
    past = table(
        rows, schemas.STATIC_MATCHING,
        {"title": "A", "match_amount_usd": D(25), "payoutaddress": "g", "project_id": "p1", "round_id": "0xr",
         "chain_id": 1, "timestamp": row.timestamp, "round_num": "5"},
    )
    registry = table(rows, schemas.REGISTRY, {"round_number": "5", "chain_id": 1, "round_id": "0xR"})
    got = matching.all_matching(paid, registry, past).collect()
    assert len(got) == 2 and len({r.matching_id for r in got}) == 2
    assert {tuple(r)[1:] for r in got} == {("5", "A", 25.0, "g", "p1", "0xr", 1, row.timestamp)}


# --- attributed value ------------------------------------------------------------


def inputs(rows):
    """A round with operators, one without, an unlisted round, a test chain, and an unmapped chain."""
    rounds = table(
        rows, schemas.ROUNDS,
        round_row("a", matching_distribution=DISTRIBUTION, match_amount_in_usd=D(100), strategy_name=K.VOTING_V2),
        round_row("b", strategy_name=""), round_row("c", 777), round_row("d", K.TEST_CHAIN_ID),
        round_row("e", 10, strategy_name=K.QF_V1, matching_distribution='{"matchingDistribution":[]}'),
    )
    given = table(
        rows, schemas.DONATIONS,
        donation(1, "a"), donation(2, "a"), donation(3, "a", donor_address="e", amount_in_usd=D("0.40")),
        donation(4, "b", transaction_hash="u"), donation(5, "c", chain_id=777), donation(6, "d", chain_id=K.TEST_CHAIN_ID),
        donation(7, "unlisted"), donation(8, "e", chain_id=10, donor_address=None), donation(9, "a", amount_in_usd=None),
    )
    roles = table(
        rows, schemas.ROUND_ROLES,
        *[{"chain_id": 1, "round_id": r, "address": a, "role": k} for r, a, k in [
            ("a", "o1", "ADMIN"), ("a", "o1", "MANAGER"), ("a", "o2", "ADMIN"), ("unlisted", "o3", "ADMIN")]],
    )
    apps = table(rows, schemas.APPLICATIONS, APPLICATION | {"round_id": "a", "distribution_transaction": "dt"})
    payouts = table(
        rows, schemas.APPLICATIONS_PAYOUTS,
        *[{"id": i, "chain_id": 1, "round_id": r, "application_id": "7", "amount_in_usd": D(x), "timestamp": T0,
           "transaction_hash": "pay"} for i, (r, x) in enumerate([("a", 4), ("a", 6), ("a", 0), ("b", 3)])],
    )
    voices = table(
        rows, schemas.MACI_CONTRIBUTIONS,
        *[{"round_id": r, "chain_id": 1, "contributor_address": c, "transaction_hash": "m", "voice_credit_balance": D(v),
           "timestamp": T0} for r, c, v in [("m1", "x", 100), ("m1", "x", 100), ("m1", "y", 50), ("m2", "x", 100), ("m1", "z", 1)]],
    )
    maci_rounds = table(rows, schemas.MACI_ROUNDS, {"id": "m1", "chain_id": 1, "round_metadata": '{"name":"M"}'})
    maci_roles = table(rows, schemas.ROUND_ROLES, {"chain_id": 1, "round_id": "m1", "address": "o9", "role": "ADMIN"})
    event = {"tx_timestamp": T0, "tx_hash": "ex", "address": "d", "role": "grantee", "gmv": 2.0, "strategy_name": "s"}
    external = table(
        rows, schemas.EXTERNAL_EVENTS,
        event | {"blockchain": "ethereum"}, event | {"blockchain": "nowhere"}, event | {"blockchain": "base", "gmv": 0.5},
        event | {"blockchain": "base", "gmv": 0.49}, event | {"blockchain": "base", "strategy_name": None},
        event | {"blockchain": "base", "strategy_name": K.EXTERNAL_VOTING},
    )
    names = table(rows, schemas.NAMES, {"address": "d", "name": "donor.eth"}, {"address": K.DEV_V2, "name": "dev.eth"},
                  {"address": "o1", "name": "one"}, {"address": "o1", "name": "uno"}, {"address": "D", "name": "other"})
    return given, rounds, apps, payouts, roles, voices, maci_rounds, maci_roles, external, names


def branch_union(given, rounds, apps, payouts, roles, voices, maci_rounds, maci_roles, external, names):
    """The events from the single branches, as the report defines them."""
    chains = chain_mapping(given.sparkSession)
    by_tx = gmv.donations_by_tx(given, rounds, chains).withColumnsRenamed(
        {"round_name": "pool_name", "total_amount_in_usd": "gmv"}
    )
    granted = gmv.grantee_rows(gmv.distribution_base(rounds, apps, payouts), chains)
    credits = gmv.maci_totals(voices, maci_rounds, chains)
    operators, maci_operators = groups.round_operators(roles), groups.round_operators(maci_roles)
    branches = [
        (K.FROM_DONATION, gmv.operator_share(by_tx, operators)),
        (K.FROM_DONATION, gmv.dev_share(by_tx, gmv.donation_devs)),
        (K.FROM_DONATION, gmv.donor_grantee_share(given, rounds, chains)),
        (K.FROM_DISTRIBUTION, gmv.operator_share(gmv.per_tx(granted), operators)),
        (K.FROM_DISTRIBUTION, gmv.dev_share(gmv.per_tx(granted), gmv.distribution_devs)),
        (K.FROM_DISTRIBUTION, granted),
        (K.FROM_MACI, gmv.donor_rows(credits)),
        (K.FROM_MACI, gmv.operator_share(gmv.maci_tx(credits), maci_operators)),
        (K.FROM_MACI, gmv.dev_share(gmv.maci_tx(credits), gmv.maci_devs)),
        (K.FROM_EXTERNAL, gmv.external_rows(external, chains)),
    ]
    return gmv.finish_gmv(sets.stack([df.withColumn("data_source", F.lit(name)) for name, df in branches]), names)


def test_events_equal_the_union_of_the_branches(rows):
    given = inputs(rows)
    got = Counter(map(tuple, gmv.gmv_events(*given).collect()))
    assert got == Counter(map(tuple, branch_union(*given).collect()))
    assert len(got) > 25


def test_event_rules(rows):
    got = gmv.gmv_events(*inputs(rows)).collect()
    donated = [r for r in got if r.data_source == K.FROM_DONATION]
    by = lambda role, rid: sorted((r.address, r.gmv, r.name) for r in donated if (r.role, r.round_id) == (role, rid))
    # Two names of one address give two rows; o2 has none. The value is split two ways whatever the roles.
    assert by("round_operator", "a") == [("o1", 10.2, "one"), ("o1", 10.2, "uno"), ("o2", 10.2, None)]
    assert by("round_operator", "b") == [], "a share without operators is not redistributed"
    assert by("round_operator", "unlisted") == [("o3", 10.0, None)]
    assert by("contract_dev", "unlisted") == [], "no strategy, no developers"
    assert by("contract_dev", "a") == [(K.DEV_VOTING, 10.2, None), (K.DEV_V2, 10.2, "dev.eth")]
    assert sorted(a for a, _, _ in by("contract_dev", "b")) == sorted([K.DEV_DEFAULT, K.DEV_V1_OPTIMISM])
    assert by("contract_dev", "c") == [], "unmapped chain"
    assert [a for a, _, _ in by("contract_dev", "e")] == [K.DEV_V1_OPTIMISM]
    assert by("donor", "a") == [("d", 20.0, "donor.eth")], "0.40 is below the least value"
    assert by("donor", "e") == [] and by("grantee", "e") == [("g", 10.0, None)]
    assert not [r for r in got if r.round_id == "d"], "test chain"
    external = sorted((r.blockchain, r.gmv) for r in got if r.data_source == K.FROM_EXTERNAL)
    assert external == [("base", 0.5), ("ethereum", 2.0)]
    voice = {(r.role, r.round_id, r.address): r.gmv for r in got if r.data_source == K.FROM_MACI}
    assert voice[("donor", "m1", "x")] == 6.0 and ("donor", "m1", "z") not in voice
    assert voice[("round_operator", "m1", "o9")] == pytest.approx(7.53)
    assert voice[("contract_dev", "m2", K.DEV_MACI)] == 1.5, "also in rounds that are not listed"


def test_shares_add_up(rows):
    given, rounds, *_ = inputs(rows)
    chains = chain_mapping(given.sparkSession)
    by_tx = gmv.donations_by_tx(given, rounds, chains).withColumnsRenamed(
        {"round_name": "pool_name", "total_amount_in_usd": "gmv"}
    )
    operators = groups.round_operators(inputs(rows)[4])
    totals = {(r.chain_id, r.round_id, r.tx_hash): r.gmv for r in by_tx.collect()}
    shared = defaultdict(float)
    for r in gmv.operator_share(by_tx, operators).where("address is not null").collect():
        shared[(r.chain_id, r.round_id, r.tx_hash)] += r.gmv
    assert shared and all(v == pytest.approx(float(totals[k])) for k, v in shared.items())
    sides = defaultdict(float)
    for r in gmv.donor_grantee_share(given, rounds, chains).collect():
        sides[r.role] += r.gmv or 0
    assert sides["donor"] == pytest.approx(sides["grantee"]) == pytest.approx(float(sum(v or 0 for v in totals.values())))


def test_fan_out_is_not_followed_by_an_aggregate(rows):
    plan = gmv.operator_share(
        gmv.per_tx(gmv.grantee_rows(gmv.distribution_base(*inputs(rows)[1:4]), chain_mapping(inputs(rows)[0].sparkSession))),
        groups.round_operators(inputs(rows)[4]),
    )._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


# --- round totals ----------------------------------------------------------------


def test_round_totals(rows):
    start = {"applications_start_time": T0}
    rounds = table(
        rows, schemas.ROUNDS,
        round_row("nullpool", **start, matching_distribution="{}", total_amount_donated_in_usd=D(5)),
        round_row("direct", **start, strategy_name=K.DIRECT_LITE_V2),
        round_row("gift", strategy_name=K.DIRECT_ALLOCATION_V2, total_amount_donated_in_usd=D(9), unique_donors_count=2),
        round_row("old", applications_start_time=datetime(2023, 1, 1)),
    )
    pay = {"chain_id": 1, "application_id": "7", "timestamp": T0, "transaction_hash": "p", "amount_in_usd": D(7)}
    payouts = table(rows, schemas.APPLICATIONS_PAYOUTS, *[pay | {"id": i, "round_id": r} for i, r in enumerate(["nullpool", "direct"])])
    late = datetime(2024, 6, 1)
    given = table(rows, schemas.DONATIONS, donation(1, "gift", timestamp=late), donation(2, "nullpool", timestamp=late))
    registry = table(
        rows, schemas.REGISTRY,
        {"round_number": "1", "chain_id": 1, "round_id": "GIFT", "program": "P"},
        {"round_number": None, "chain_id": 1, "round_id": "direct", "program": "Q"},
    )
    external = rows(
        [("past", None, "net", datetime(2024, 1, 1), "s"), ("future", 1.0, "net", datetime(2031, 1, 1), "s")],
        "desc STRING, amount_in_usd DOUBLE, network_name STRING, timestamp TIMESTAMP, strategy_name STRING",
    )
    maci = table(rows, schemas.MACI_ROUNDS, {"id": "m", "chain_id": 10, "round_metadata": '{"name":"M"}', "strategy_name": K.MACI_V2})
    voices = table(rows, schemas.MACI_CONTRIBUTIONS)
    got = round_jobs.round_totals(rounds, payouts, given, registry, external, maci, voices, datetime(2030, 1, 1)).collect()
    assert [(r["Name"], r["Total USD"], r["Matching USD"], r["program"]) for r in got[:4]] == [
        ("past", None, None, None),
        (K.DIRECT_ALLOCATION_ROUND_NAME, 9.0, 0.0, "P"),
        ("direct", 7.0, 7.0, None),
        ("nullpool", 5.0, 0.0, None),
    ]
    assert got[1]["Indexed Time"] == late and got[1]["Avg Donor Contribution"] == 4.5
    assert got[2]["Indexed Time"] == T0 and got[4]["Strategy"] == K.MACI_TITLE and len(got) == 5


# --- project groups --------------------------------------------------------------

PAST = "grantid INT, name STRING, payoutaddress STRING, websiteurl STRING, twitter STRING, github STRING, createdon TIMESTAMP"
A, B = "0x" + "a" * 40, "0x" + "b" * 40


def profile(pid, title, recipient, website="", twitter="", created=1):
    return {
        "id": pid, "chain_id": 1, "round_id": "r", "project_id": pid, "total_amount_donated_in_usd": 1.5,
        "metadata": f'{{"application":{{"recipient":"{recipient}","project":{{"title":"{title}","website":"{website}","projectTwitter":"{twitter}","createdAt":{created}}}}}}}',
    }


def grouped(rows, blank_is_value=False):
    past = rows([(1, "My App!", A.upper().replace("X", "x"), "w", "T", None, datetime(2020, 1, 1)), (2, "!!", A, "w", "t", None, None), (3, "x", "bad", "w", "t", None, None)], PAST)
    gifts = rows([(1, D(5), T0)], "grant_id INT, amountUSD DECIMAL(18,2), created_on TIMESTAMP")
    apps = table(
        rows, schemas.APPLICATIONS,
        profile("p1", "my  app", A, "w", "", 1_700_000_000_000), profile("p2", "solo", B), profile("p3", "solo2", B),
        profile("p4", "twin", B), profile("p5", "twin", B),
    )
    profiles = projects.normalize_projects(
        projects.historical_profiles(past, gifts), projects.indexed_profiles(apps), blank_is_value
    )
    return projects.grouped_projects(profiles)


def test_profiles_group_by_three_attributes(rows):
    got = grouped(rows)
    group = {r.project_id: r.group_id for r in got.collect()}
    assert set(group) == {"1", "p1", "p2", "p3", "p4", "p5"}, "bad address and empty title go"
    assert group["1"] == group["p1"] == "0" and len(set(group.values())) == 5
    top = projects.project_groups_summary(got).first()
    assert (top.latest_created_project_id, top.total_amount_donated, top.application_count) == ("p1", 6.5, 2)
    assert [r.group_id for r in projects.project_lookup(got).collect()] == ["0", "0", "1", "2", "3", "4"]


def test_blank_values_can_link(rows):
    group = {r.project_id: r.group_id for r in grouped(rows, blank_is_value=True).collect()}
    # Address, blank website and blank handle: all that share the address are one project then.
    assert group["p2"] == group["p3"] == group["p4"] == group["p5"] != group["p1"]


# --- ingest ----------------------------------------------------------------------


def test_flatten_covers_keys_of_all_rows(rows):
    docs = ['{"Data":{"Meta":{"V":1}},"n":1}', '{"Data":{"Meta":{"V":2.5},"list":[1]},"m":null}', '{"n":{}}'][:2]
    got = ingest.flatten_json_column(rows([(i, d) for i, d in enumerate(docs)], "id INT, value STRING"), "value")
    assert sorted(got.columns) == ["data_list", "data_meta_v", "id", "m", "n"]
    assert {(r.id, r.data_meta_v, r.n, str(r.data_list)) for r in got.collect()} == {(0, 1.0, 1, "None"), (1, 2.5, None, "[1]")}


def test_scores_need_the_columns_they_drop(rows):
    raw = rows([("m", "a", '{"data":{"gas_spent":1,"score":2}}')], "key_0 STRING, key_1 STRING, value STRING")
    with pytest.raises(ValueError, match="data_meta_version"):
        ingest.clean_scores(raw)
    got = ingest.clean_scores(raw, drops=["data_gas_spent"])
    assert got.columns == ["model", "address", "data_score"]


def test_signatures(rows):
    import hashlib

    events = table(
        rows, schemas.EXTERNAL_EVENTS,
        {"tx_timestamp": T0, "tx_hash": "h", "address": "b", "gmv": 1.5, "role": "r"},
        {"tx_timestamp": T0, "tx_hash": "h", "address": None, "gmv": 2.0, "role": "r"},
    )
    got = {r.row_number: r for r in ingest.sign_events(events).collect()}
    want = hashlib.sha256(b"2024-05-01 00:00:00hb1.50r1").hexdigest()
    assert got[1].event_signature == want and got[2].address is None and got[2].event_signature
    with pytest.raises(ValueError, match="empty event set"):
        ingest.sign_events(events.limit(0))
