import random
from datetime import datetime, timedelta

from podium.operators.bitemporal import Timeline, as_of, as_recorded, bitemporal_ledger
from pyspark.sql import functions as F

SCHEMA = "account_id bigint, scan_id string, commander string, alliance string, server string, ingested_at timestamp"
NAMES = ["commander", "alliance", "server"]
T0 = datetime(2027, 1, 1)


def versions(rows):
    """Brute force: the versions of one key by what ``rows`` (valid, recorded, reading) say, the last recorded of a valid time counting."""
    latest = {}
    for v, r, x in sorted(rows, key=lambda f: f[1]):
        latest[v] = x
    out, state = [], None
    for v in sorted(latest):
        new = tuple(n if n is not None else o for n, o in zip(latest[v], state or (None,) * len(latest[v])))
        if state is None or new != state:
            if out:
                out[-1] = (*out[-1][:2], v)
            out.append((new, v, None))
        state = new
    return out


def test_timeline_matches_brute_force_at_every_recorded_time():
    rng = random.Random(3)
    for _ in range(200):
        facts = [(rng.randint(1, 6), r, tuple(rng.choice([None, "a", "b"]) for _ in range(2))) for r in range(12)]
        line, closed = Timeline(2), []
        for v, r, x in facts:
            closed += [(s, e, state, since, r) for s, e, state, since in line.add(v, r, x)]
            now = {(state, s, e) for s, e, state, _ in line.current()}
            assert now == set(versions([f for f in facts if f[1] <= r]))
        ledger = closed + [(s, e, state, since, None) for s, e, state, since in line.current()]
        for at in range(12):
            held = {(state, s, e) for s, e, state, since, until in ledger if since <= at and (until is None or until > at)}
            assert held == set(versions([f for f in facts if f[1] <= at]))


def test_ledger_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (1, "s1", "A", "x", "7", T0), (1, "s1", "A", "x", "7", T0), (1, "s2", "", None, "7", T0 + timedelta(1)), (1, "s3", "B", "x", "7", T0 + timedelta(2)),
        (1, "s4", "A", "x", "7", T0 + timedelta(3)), (1, "s2", "C", "x", "7", T0 + timedelta(9)), (None, "s1", "N", "x", "7", T0), (2, None, "N", "x", "7", T0), (3, "s1", None, None, None, T0),
        (4, "s1", "P", "x", "7", T0), (4, "s1", "Q", "x", "7", T0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("_k", F.lit("clash")).withColumn("valid_from", F.lit("clash"))
    ledger = bitemporal_ledger(df, "account_id", "scan_id", "ingested_at", NAMES)
    now = {(r.account_id, r.commander, r.valid_from, r.valid_to) for r in as_recorded(ledger).collect()}
    assert now == {(1, "A", "s1", "s2"), (1, "C", "s2", "s3"), (1, "B", "s3", "s4"), (1, "A", "s4", None), (3, None, "s1", None), (4, "Q", "s1", None)}
    before = {(r.commander, r.valid_from, r.valid_to) for r in as_recorded(ledger, F.lit(T0 + timedelta(5))).where("account_id = 1").collect()}
    assert before == {("A", "s1", "s3"), ("B", "s3", "s4"), ("A", "s4", None)}
    assert [r.commander for r in as_of(ledger, F.lit("s2"), F.lit(T0 + timedelta(5))).where("account_id = 1").collect()] == ["A"]
    assert all(r.recorded_to is None or r.recorded_to > r.recorded_from for r in ledger.collect())


def test_ledger_of_an_empty_table(spark):
    assert bitemporal_ledger(spark.createDataFrame([], SCHEMA), "account_id", "scan_id", "ingested_at", NAMES).count() == 0


def test_hot_key_of_most_rows(spark):
    rows = spark.range(20000).selectExpr("1L as account_id", "format_string('s%05d', id % 500) as scan_id", "format_string('n%d', (id % 500) div 100) as commander", "'x' as alliance", "'7' as server", "timestamp_seconds(id) as ingested_at")
    now = as_recorded(bitemporal_ledger(rows, "account_id", "scan_id", "ingested_at", NAMES)).orderBy("valid_from").collect()
    assert [(r.commander, r.valid_from, r.valid_to) for r in now] == [("n0", "s00000", "s00100"), ("n1", "s00100", "s00200"), ("n2", "s00200", "s00300"), ("n3", "s00300", "s00400"), ("n4", "s00400", None)]


def test_keys_cut_into_ranges_give_the_same_ledger(spark):
    rng = random.Random(11)
    for seed in range(3):
        rows = []
        for key in range(6):
            for n in range(60):
                late = rng.choice([0, 0, 0, 5, 40])
                value = lambda: rng.choice([None, "", "a", "b", "c"])
                rows.append((key, "s%03d" % rng.randint(0, 40) if seed else "s%03d" % n, value(), rng.choice([None, "x", "y"]), None if key == 5 else "7", T0 + timedelta(hours=n + late)))
        df = spark.createDataFrame(rows, SCHEMA)
        whole, cut = (sorted(map(tuple, bitemporal_ledger(df, "account_id", "scan_id", "ingested_at", NAMES, long_rows=n).collect()), key=repr) for n in (10**6, 20))
        assert cut == whole


def test_a_key_with_a_third_of_all_rows_is_spread_over_tasks(spark):
    rows = spark.range(30000).selectExpr("if(id % 3 = 0, 1L, id) as account_id", "format_string('s%05d', id div 3) as scan_id", "format_string('n%d', id div 5000) as commander", "'x' as alliance", "'7' as server", "timestamp_seconds(id) as ingested_at")
    ledger = bitemporal_ledger(rows, "account_id", "scan_id", "ingested_at", NAMES, long_rows=2000)
    now = as_recorded(ledger).where("account_id = 1").orderBy("valid_from").collect()
    assert [r.commander for r in now] == [f"n{i}" for i in range(6)] and now[0].valid_from == "s00000" and now[-1].valid_to is None
    assert all(a.valid_to == b.valid_from for a, b in zip(now, now[1:]))
    dealt = rows.where("account_id = 1").repartitionByRange(5, "account_id", "scan_id")
    assert dealt.rdd.getNumPartitions() == 5 and max(dealt.rdd.glom().map(len).collect()) < 4000
