import json
import os
import time

from podium.operators import frames
from podium.operators.components import connected_components
from podium.sources import readers, sinks
from podium.streaming import capture
from pyspark.sql import functions as F

BOXES = "frame string, seq int, text string, x double, y double, width double, height double"


def row(frame, n, rank, y, name="Name", label="[T] Team", server="S113", points="1,000"):
    parts = [(str(rank), 0.1, y), (name, 0.4, y + 0.02), (label, 0.4, y), (server, 0.4, y - 0.02), (points, 0.8, y)]
    return [(frame, 10 * n + k, t, x, yy, 0.08, 0.02) for k, (t, x, yy) in enumerate(parts) if t]


def parse(spark, boxes, before=None):
    return {r["rank"]: r for r in frames.parse_frames(spark.createDataFrame(boxes, BOXES), before).collect()}


def test_rows_of_a_frame(spark):
    boxes = row("f", 0, 51, 0.7) + row("f", 1, 52, 0.7 - frames.PITCH, server="") + row("f", 2, 53, 0.06)
    got = parse(spark, boxes)
    assert sorted(got) == [51, 52, 58] or sorted(got)[:2] == [51, 52]
    assert (got[51].commander, got[51].alliance, got[51].server, got[51].points, got[51].complete) == ("Name", "[T] Team", "113", 1000, True)
    assert got[52].server is None and got[52].alliance == "[T] Team"
    edge = max(got)
    assert not got[edge].complete


def test_unreadable_name_banner_and_empty_frames(spark):
    boxes = row("f", 0, 9, 0.6, name="")
    got = parse(spark, [b for b in boxes if b[2] != "S113"])
    assert got[9].name_unreadable and got[9].commander == "" and got[9].alliance == "[T] Team"
    banner = row("f", 0, 1, 0.78) + row("f", 1, 2, 0.78 - frames.PITCH) + [("f", 99, "X", 0.85, 0.76, 0.02, 0.02)]
    tainted = parse(spark, banner)
    assert tainted[1].tainted and not tainted[2].tainted
    assert frames.banner_close(spark.createDataFrame(banner, BOXES)).count() == 1
    assert parse(spark, [("f", 0, "nothing", 0.4, 0.5, 0.1, 0.02)]) == {}
    assert frames.parse_frames(spark.createDataFrame([], BOXES)).count() == 0


def test_rank_far_behind_does_not_count(spark):
    boxes = row("f", 0, 5, 0.7) + row("f", 1, 101, 0.7 - frames.PITCH)
    before = spark.createDataFrame([("f", 99)], "frame string, prev_max_rank int")
    assert sorted(parse(spark, boxes, before)) == [100, 101]


def test_fit_is_invariant_to_scale_and_shift(spark):
    head = [("f", i, t, x - 0.04, (frames.TITLE_Y if t == "RANKINGS" else frames.COLUMN_Y) - 0.01, 0.08, 0.02) for i, (t, x) in enumerate(frames.HEADER_X.items())]
    boxes = head + row("f", 3, 7, 0.7)
    moved = [(f, s, t, 0.08 + 0.83 * x, 0.13 + 0.7 * y, 0.83 * w, 0.7 * h) for f, s, t, x, y, w, h in boxes]
    plain = frames.fit_screen(spark.createDataFrame(boxes, BOXES))
    fitted = frames.fit_screen(spark.createDataFrame(moved, BOXES))
    key = lambda df: sorted((r["seq"], round(r.x, 6), round(r.y, 6)) for r in df.collect())
    assert key(plain) == key(fitted)


def test_matchup_screen(spark):
    def screen(*more):
        base = [("Defender", 0.2, 0.8), ("S117", 0.2, 0.7), ("Invader", 0.7, 0.8), ("S119", 0.7, 0.7), ("Defeat", 0.2, 0.75), ("Battle Over", 0.45, 0.4)]
        return spark.createDataFrame([("f", i, t, x, y, 0.1, 0.02) for i, (t, x, y) in enumerate([*base, *more])], BOXES)

    got = frames.screen_matchup(screen(), "117").first()
    assert (got.home_role, got.opponent, got.battle_over, got.home_result) == ("defending", "119", True, "defeat")
    assert frames.screen_matchup(screen(("S200", 0.2, 0.69)), "117").count() == 0
    assert frames.screen_matchup(screen(("Defender", 0.2, 0.5)), "117").count() == 0


def test_nearest_slot_takes_the_lower_on_ties(spark):
    points = spark.createDataFrame([("f", 1, 0.5), ("f", 2, 5.0), ("g", 3, 0.5)], "frame string, id int, y double")
    slots = spark.createDataFrame([("f", 0, 1.0), ("f", 1, 0.0)], "frame string, slot int, sy double")
    got = frames.nearest_slot(points, slots, "frame", "y", "slot", "sy", 1.0).collect()
    assert [(r.id, r.slot) for r in got] == [(1, 1)]


def test_sources_round_trip(spark, tmp_path):
    root = tmp_path / "events" / "2027-01-01-s1-vs-s2"
    root.mkdir(parents=True)
    (root / "rankings.json").write_text(json.dumps([{"rank": 1, "commander": "Ä", "alliance": "[T] N", "server": "1", "points": 3_000_000_000}, {"rank": 2, "commander": "b", "points": None}]))
    rows = readers.players(spark, f"{tmp_path}/events/*/rankings.json")
    assert [(r.event_id, r.pos, r.commander, r.points) for r in rows.orderBy("pos").collect()] == [("2027-01-01-s1-vs-s2", 0, "Ä", 3_000_000_000), ("2027-01-01-s1-vs-s2", 1, "b", None)]
    sinks.write_players(rows, f"{tmp_path}/lake")
    assert readers.earlier_players(spark, f"{tmp_path}/lake", "other").count() == 2
    assert readers.earlier_players(spark, f"{tmp_path}/lake", "2027-01-01-s1-vs-s2").count() == 0
    assert readers.json_map(spark, f"{tmp_path}/none.json").count() == 0
    (tmp_path / "map.json").write_text('{"a": "b"}')
    assert [tuple(r) for r in readers.json_map(spark, f"{tmp_path}/map.json").collect()] == [("a", "b")]
    (tmp_path / "broken.json").write_text("[{")
    assert readers.registry(spark, f"{tmp_path}/broken.json").count() == readers.registry(spark, f"{tmp_path}/none").count() == 0
    for body in ('{"scans": [{"scan_id": "x", "total_points": 5}]}', '[{"scan_id": "x", "total_points": 5}]'):
        (tmp_path / "index.json").write_text(body)
        assert [(r.scan_id, r.total_points) for r in readers.scans(spark, f"{tmp_path}/index.json").collect()] == [("x", 5)]
    meta = spark.createDataFrame([("e-1", "T")], "event_id string, title string")
    value = sinks.script_bundle(meta, spark.createDataFrame([("e-1", 1, "A")], "event_id string, rank int, alliance string"), rows.withColumn("event_id", F.lit("e-1"))).first().value
    (tmp_path / "e-1").mkdir()
    (tmp_path / "e-1" / "event_data.js").write_text(value)
    assert len(value.split("\n")) == 5 and value.startswith("window.EVENT_e_1 =")
    assert readers.bundle(spark, f"{tmp_path}/e-1/event_data.js", "rankings").count() == 2


def test_boxes_and_images(spark, tmp_path):
    (tmp_path / "f1.json").write_text(json.dumps([{"text": "1", "x": 0.1, "y": 0.2, "width": 0.1, "height": 0.1, "confidence": 1}, {"y": 0.3, "text": "é"}]))
    assert [(r.frame, r.seq, r.text) for r in readers.boxes(spark, f"{tmp_path}/*.json").orderBy("seq").collect()] == [("f1", 0, "1"), ("f1", 1, "é")]
    for name in ("Screenshot_20270101_120000.png", "Screenshot_bad.png", "note.txt"):
        (tmp_path / name).write_bytes(b"x")
    got = readers.images(spark, str(tmp_path)).collect()
    assert os.path.basename(got[-1].path) == "Screenshot_20270101_120000.png" or len(got) == 2
    os.utime(tmp_path / "note.txt", (time.time() - 10 * 86400,) * 2)
    assert [os.path.basename(r.path) for r in readers.expired(spark, str(tmp_path), 3).collect()] == ["note.txt"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (None, 5), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 102)} == {100} and got[200] == 200
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_stream_votes_and_progress(spark, tmp_path):
    schema = "capture_id string, frame_no bigint, rank int, points bigint, y double, seq bigint"
    frames_ = [[("c", f, r, r if f != 2 else 99, 0.4, 100 * f + r) for r in range(10 * f, 10 * f + 12)] for f in range(1, 7)] + [[("c", f, 71, 71, 0.4, 1000 + f)] for f in range(7, 12)]
    for i, rows in enumerate(frames_):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = capture.read_frames(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, per_batch=100)
    votes = capture.running_votes(stream, ["rank"], "points").writeStream.outputMode("complete").format("memory").queryName("votes").start()
    votes.processAllAvailable()
    votes.stop()
    won = {r["rank"]: r.points for r in capture.winners(spark.table("votes"), ["rank"], "points").collect()}
    assert won[30] == 99 and won[25] == 99 and won[45] == 45  # the earlier of two equal votes
    stream = capture.read_frames(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, per_batch=100)
    progress = capture.running_progress(stream).writeStream.outputMode("append").format("memory").queryName("progress").start()
    progress.processAllAvailable()
    progress.stop()
    ends = [r.frame_no for r in spark.table("progress").where("at_end").orderBy("frame_no").collect()]
    assert ends == [10, 11] or ends == [11]


def test_first_version_rows(spark):
    from podium.operators import legacy

    boxes = row("f", 0, "1", 0.7) + [("f", 50, "3", 0.1, 0.5, 0.05, 0.02), ("f", 51, "news", 0.1, 0.6, 0.8, 0.02)]
    got = {r["rank"]: r for r in legacy.parse_frames_v1(spark.createDataFrame(boxes, BOXES)).collect()}
    assert (got[1].commander, got[1].alliance, got[1].points) == ("Name", "[T] Team S113", 1000)
    assert (got[2].commander, got[2].points, round(got[2].y, 3)) == ("", None, 0.6)
    assert legacy.parse_frames_v1(spark.createDataFrame([], BOXES)).count() == 0


def test_matchup_given_or_detected(spark):
    import pytest
    from podium.operators import publish

    rows = spark.createDataFrame([("119", None, False), (None, "113", False), ("119", "113", True)], "g string, d string, f boolean")
    assert [r.v for r in rows.select(publish.resolve_matchup(F.col("g"), F.col("d"), F.col("f")).alias("v")).collect()] == ["119", "113", "119"]
    for bad in ((None, None), ("119", "113")):
        with pytest.raises(Exception):
            spark.createDataFrame([bad], "g string, d string").select(publish.resolve_matchup(F.col("g"), F.col("d"))).collect()
    words = spark.createDataFrame([(["a", "b"], ["x", "y"])], "k array<string>, v array<string>").select(publish.messages(F.col("k"), F.col("v")).alias("m")).first().m
    assert words == {"a": "x", "b": "y"}
