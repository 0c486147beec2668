"""Cleaning as a batch, publishing as one operation, rounds of repair, and frames that come in parts."""

import datetime
import os

import pytest
from podium.functions.text import LABEL_FIXES
from podium.operators import clean, evidence, frames, history, legacy, publish, quality, vote
from podium.sources import readers, sinks
from podium.streaming import capture
from pyspark.sql import functions as F

PLAYERS = "event_id string, pos bigint, rank int, commander string, alliance string, alliance_tag string, alliance_name string, server string, points bigint"
META = "event_id string, title string, event_date string, home_server string, opponent_server string, home_role string"


def players(spark, event, *rows):
    return spark.createDataFrame([(event, n, n, c, a, None, None, s, p) for n, (c, a, s, p) in enumerate(rows, 1)], PLAYERS)


def test_publishing_updates_in_place_and_keeps_the_latest(spark, tmp_path):
    root = str(tmp_path / "out")
    meta = spark.createDataFrame([("e1", "First", "2027-01-01", "1", "2", "attacking"), ("e2", "Second", "2027-02-01", "1", "3", None)], META)
    one, two = players(spark, "e1", ("Ann", "[A] Alpha", "1", 10), ("Bob", "[A] Alpha", None, None)), players(spark, "e2", ("Cem", "No Alliance", "3", 7))
    sinks.publish(meta, two, root)
    registry = sinks.publish(meta, one, root)
    assert [r.event_id for r in registry.orderBy("pos").collect()] == ["e1", "e2"]  # a new event comes first
    assert {r.event_id for r in spark.read.parquet(f"{root}/latest").collect()} == {"e2"}  # an older event moves no pointer
    before = {r.event_id: r.data_version for r in registry.collect()}
    again = sinks.publish(meta, one.unionByName(two), root)
    assert [r.event_id for r in again.orderBy("pos").collect()] == ["e1", "e2"] and {r.event_id: r.data_version for r in again.collect()} == before
    got = {(r.event_id, r["rank"]): (r.commander, r.server, r.points, r.server_rank) for r in readers.players(spark, f"{root}/rankings/*").collect()}
    assert got == {("e1", 1): ("Ann", "1", 10, 1), ("e1", 2): ("Bob", None, None, 1), ("e2", 1): ("Cem", "3", 7, 1)}
    alpha = readers.standings(spark, f"{root}/alliances/*").where("alliance = '[A] Alpha'").first()
    assert [(m["rank"], m.commander, m.points, m.server) for m in alpha.members] == [(1, "Ann", 10, "1"), (2, "Bob", 0, None)] and alpha.tag == "A"
    assert readers.bundle(spark, f"{root}/bundle/*", "alliances").count() == 2
    servers = readers.event_documents(spark, f"{root}/event/*").where("id = 'e1'").first().servers
    assert servers["1"].name == "Server 1 (Attacking)" and servers["home"].name == "Server home (Cross-server)"
    sinks.publish(meta.limit(0), one.limit(0), str(tmp_path / "empty"))


def test_scan_ids_and_stamps(spark):
    at = datetime.datetime(2027, 1, 2, 3, 4, 5)
    rows = spark.createDataFrame([("given", at, None), (None, at, None), ("", None, at), (None, None, None)], "g string, f timestamp, s timestamp")
    got = [r.i for r in rows.select(publish.scan_id(F.col("g"), F.col("f"), F.col("s")).alias("i")).collect()]
    assert got[:3] == ["given", "20270102T030405", "20270102T030405"] and got[3].endswith("Z") and len(got[3]) == 16
    page = spark.createDataFrame([('<a src="e.1/x.js"><b src="e.1/x.js?v=0a"><c src="e_1/x.js">', "e.1/x.js")], "p string, n string")
    assert page.select(publish.stamped(F.col("p"), F.col("n"), F.lit("ff")).alias("p")).first().p == '<a src="e.1/x.js?v=ff"><b src="e.1/x.js?v=ff"><c src="e_1/x.js">'


def test_corrections_need_evidence(spark):
    table = clean.corrections_table(spark, LABEL_FIXES)
    assert table.count() == len(LABEL_FIXES)
    safe = {r.before for r in clean.safe_corrections(table, spark.createDataFrame([("[JQK] JQKKK",)], "label string")).collect()}
    assert "[P1MP] JU1CER" in safe and "UJQK] JQKKK" in safe  # the latter's result is known
    assert "USMF] forte" not in safe and "[19o] CandyClub" not in safe  # no known label; only a look-alike tag
    rows = players(spark, "e", ("Ann", "[P1MP] JU1CER S113", None, 1), ("Bob", "USMF] forte", "S9", 1), ("Cem", None, "", 1), ("Dan", "［ＡＢ］ x", "1", 1))
    got = [(r.alliance, r.server) for r in clean.clean_players(rows, "7", LABEL_FIXES).orderBy("rank").collect()]
    assert got == [("[P1MP] JU1CE", "113"), ("USMF] forte", "9"), ("No Alliance", "7"), ("[ＡＢ] x", "1")]
    nothing = clean.clean_players(rows.limit(0), "7")
    assert nothing.count() == 0


def test_batch_applies_overrides_and_only_reports_near_names(spark):
    earlier = players(spark, "d", ("Wulfgar", "[AB] Team", "1", 1), ("Ørvald", "[AB] Team", "1", 1)).withColumn("row_id", F.col("pos"))
    now = players(spark, "e", ("Wulfgat", "[AB] Team", "1", 9), ("oRVald2", "[AB] Team", "1", 8), ("Old", "[A8] Team", "1", 7), (None, "[AB] Team", "1", 6))
    overrides = spark.createDataFrame([("1", "oRVald2", "Ørvald")], "server string, observed string, canonical string")
    done, changes, reviews = clean.clean_batch(now, "1", clean.known_labels(earlier), clean.known_names(earlier), clean.known_name_labels(earlier), overrides=overrides, group=["event_id"])
    assert [r.commander for r in done.orderBy("rank").collect()] == ["Wulfgat", "Ørvald", "Old", None]
    assert {(r["rank"], r.field, r.before, r.after, r.reason) for r in changes.collect()} == {(2, "commander", "oRVald2", "Ørvald", "manual override")}
    assert {(r["rank"], r.field, r.observed, r.known) for r in reviews.collect()} == {(1, "commander", "Wulfgat", "Wulfgar")}


READINGS = "event_id string, rank int, commander string, alliance string, server string, points bigint, y double, seq bigint, complete boolean, tainted boolean, name_unreadable boolean"


def reading(rank, points, seq, complete=True, name="Ann"):
    return ("e", rank, f"{name}{rank}", "[A] a", "1", points, 0.45, seq, complete, False, False)


def test_rounds_of_repair_only_look_at_doubtful_ranks(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), READINGS)
    first = make(reading(1, 100, 1), reading(1, 100, 2), reading(2, 90, 3), reading(4, 70, 4), reading(4, 70, 5))
    merged, targets = quality.repaired(first, [make(reading(1, 999, 6), reading(2, 91, 7), reading(2, 91, 8), reading(3, 80, 9)), make(reading(3, 80, 10), reading(4, 1, 11))], ["event_id", "rank"])
    assert {r["rank"]: (r.points, r.n_obs) for r in merged.collect()} == {1: (100, 2), 2: (91, 3), 3: (80, 1), 4: (70, 2)}
    assert {r["rank"] for r in targets.collect()} == {2, 3}


def test_stops_and_plans(spark):
    shown = spark.createDataFrame([("c", n, m) for n, m in enumerate([30, 60, 60, 60, 60, 60, 60, 60])] + [("d", n, 40) for n in range(9)], "capture_id string, frame_no int, max_rank int")
    assert {r.capture_id: r.stop_frame for r in evidence.bottom_stop_v1(shown).collect()} == {"c": 7, "d": None}
    targets = spark.createDataFrame([("c", r) for r in (10, 100, 130, 90, 5)] + [("d", 70), ("d", 200), ("e", None)], "capture_id string, rank int")
    starts = spark.createDataFrame([("c", 100.0)], "capture_id string, centre double")
    got = [(r.capture_id, r["rank"]) for r in evidence.repair_plan(targets, starts).orderBy("capture_id", "step").collect()]
    assert got == [("c", 100), ("c", 90), ("c", 130), ("c", 5), ("c", 10), ("d", 200), ("d", 70)]


def test_first_versions_labels(spark):
    labels = ["[A B] Team S113", "Team S9", "", None, "[X]", " S1"]
    rows = spark.createDataFrame([(n, x) for n, x in enumerate(labels)], "n int, l string")
    got = [tuple(r)[1:] for r in rows.select("n", *legacy.label_parts(F.col("l"))).orderBy("n").collect()]
    assert got == [("A B", "Team", "[A B] Team"), ("", "Team", "Team"), ("", "No Alliance", "No Alliance"), ("", "No Alliance", "No Alliance"), ("X", "", "[X]"), ("", "", "No Alliance")]


def test_ranks_before_are_carried_from_frame_to_frame(spark):
    boxes = "frame string, seq int, text string, x double, y double, width double, height double"
    row = lambda f, n, rank, y: [(f, 10 * n, rank, 0.1, y, 0.08, 0.02), (f, 10 * n + 1, "Name", 0.4, y + 0.02, 0.08, 0.02), (f, 10 * n + 2, "1,000", 0.8, y, 0.08, 0.02)]
    shown = row("a", 0, "98", 0.7) + row("a", 1, "99", 0.7 - frames.PITCH) + row("b", 0, "?", 0.7) + row("c", 0, "5", 0.7) + row("c", 1, "102", 0.7 - frames.PITCH) + [("d", 0, "Loading", 0.4, 0.5, 0.1, 0.02)]
    df = spark.createDataFrame(shown, boxes)
    order = spark.createDataFrame([(f, "k", n) for n, f in enumerate("abcd")], "frame string, capture_id string, frame_no int")
    before = frames.ranks_before(df, order)
    assert {r.frame: r.prev_max_rank for r in before.collect()} == {"a": None, "b": 99, "c": 100, "d": 102}
    assert {r.frame: r.offset for r in frames.frame_fits(df, before).collect()} == {"a": 98, "b": 100, "c": 101, "d": None}


def test_a_frame_in_two_batches_counts_once(spark, tmp_path):
    schema = "capture_id string, frame_no bigint, rank int"
    parts = [[("c", 1, r) for r in range(50, 61)], *[[("c", f, r) for r in half] for f in (2, 3, 4) for half in (range(58, 60), range(60, 61))]]
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = capture.read_frames(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    query = capture.running_progress(stream).writeStream.outputMode("append").format("memory").queryName("halves").start()
    query.processAllAvailable()
    query.stop()
    last = spark.table("halves").where("frame_no = 4").orderBy(F.desc("identical")).first()
    assert last.stalled == 3 and last.identical == 2 and not spark.table("halves").where("at_end").count()


def test_shares_and_profiles_with_nulls(spark):
    rows = players(spark, "e", ("Ann", "[A] a", "1", None), ("Bob", None, None, 30), ("Cem", "[A] a", "1", 10))
    sides = {r.server: (r.players, r.points, r.points_share, r.roster_share, r.avg_points) for r in history.side_shares(rows).collect()}
    assert sides == {"1": (2, 10, 25.0, 66.67, 5), None: (1, 30, 75.0, 33.33, 30)}
    assert history.side_shares(rows.limit(0)).count() == 0 and vote.merge_readings(spark.createDataFrame([], READINGS), ["event_id", "rank"]).count() == 0


def test_a_broken_language_package_is_no_silent_loss(monkeypatch):
    import importlib.util

    import __spark_entry__ as entry_point

    if importlib.util.find_spec("podium.llm") is None:
        pytest.skip("no language package here")
    monkeypatch.setattr(entry_point, "_LLM_PLANS", "podium.llm.missing_module")
    with pytest.raises(ModuleNotFoundError):
        entry_point.queries()
    assert os.path.exists(entry_point.__file__)
