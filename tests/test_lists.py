from podium.functions.text import confusable_key, label_key, label_name, label_tag, name_key, normal_label, server_code
from podium.operators import clean, early, evidence, history, legacy, publish, quality, rollup, vote
from pyspark.sql import functions as F

PLAYERS = "event_id string, pos bigint, rank int, commander string, alliance string, server string, points bigint"
READINGS = "event_id string, rank int, commander string, alliance string, server string, points bigint, y double, seq bigint, complete boolean, tainted boolean, name_unreadable boolean"
KEYS = ["event_id", "rank"]


def players(spark, *rows):
    return spark.createDataFrame([("e", i + 1, *r) if len(r) == 5 else r for i, r in enumerate(rows)], PLAYERS)


def readings(spark, *rows):
    """rows: (rank, commander, alliance, server, points, y, complete, tainted)."""
    return spark.createDataFrame([("e", *r[:6], i, r[6] if len(r) > 6 else True, r[7] if len(r) > 7 else False, False) for i, r in enumerate(rows)], READINGS)


def column(spark, values, function):
    return [r.v for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", function(F.col("x")).alias("v")).orderBy("i").collect()]


def test_keys(spark):
    assert column(spark, ["Ａlpha-1 ß", None, "★", "É"], name_key) == ["alpha1ss", "", "", "é"]
    assert column(spark, ["I1l|", "Мах0", None], confusable_key) == ["llll", "maxo", ""]
    assert column(spark, ["[AB I0] x!"], label_key) == ["abloxl"]
    assert column(spark, ["［ A B C ］ Alliance", "", None, "Alone", "[] X"], normal_label) == ["[ABC] Alliance", "No Alliance", "No Alliance", "Alone", "X"]
    assert column(spark, ["[A B] Name", "Name", None], label_tag) == ["AB", "", ""]
    assert column(spark, ["[A B]  Name ", "Name", None], label_name) == ["Name", "Name", "No Alliance"]


def test_server_codes(spark):
    rows = [("113", "[A] B"), ("S113", "[A] B"), (None, "[113] PANAMA113"), (None, "[FERN] Alliance S113"), ("", "x")]
    got = spark.createDataFrame(rows, "s string, l string").select(server_code(F.col("s"), F.col("l"), "117").alias("v")).collect()
    assert [r.v for r in got] == ["113", "113", "117", "113", "117"]


def test_standings_ties_nulls_and_order_of_rows(spark):
    df = players(spark, (1, "a", "X", "1", 10), (2, "b", "Y", "2", 10), (3, "c", "X", None, None), (4, "d", "Y", "1", 10), (5, "e", None, "1", 3))
    for physical in (df, df.orderBy(F.rand(1)).repartition(3)):
        got = {r.alliance: r for r in rollup.alliance_standings(physical).collect()}
        assert (got["Y"].rank, got["X"].rank, got[None].rank) == (1, 2, 3)
        assert (got["Y"].top_commander, got["Y"].server, got["Y"].avg_points) == ("b", "2", 10)
        assert (got["X"].server, got["X"].total_points, got["X"].avg_points) == ("1", 10, 5)
        assert (got["Y"].server_rank, got["X"].server_rank, got[None].server_rank) == (1, 1, 2)
    empty = players(spark)
    assert rollup.alliance_standings(empty).count() == rollup.server_totals(empty).count() == rollup.server_map(empty).count() == 0
    zero = rollup.server_totals(players(spark, (1, "a", "X", "1", None))).first()
    assert zero.point_share_pct == 0


def test_vote_rules(spark):
    one = lambda df: df.first()
    assert one(vote.vote(readings(spark, (1, "", "", "", 5, 0.1), (1, "", "", "", 5, 0.1), (1, "", "", "", 7, 0.45)), KEYS, "points")).points == 5
    assert one(vote.vote(readings(spark, (1, "", "", "", 5, 0.15), (1, "", "", "", 7, 0.47)), KEYS, "points")).points == 7
    nothing = one(vote.vote(readings(spark, (1, "", "", "", None, None)), KEYS, "points"))
    assert (nothing.points, nothing.agreement, nothing.n_valid) == (None, 0.0, 0)
    server = vote.vote(readings(spark, (1, "", "", None, 1, 0.4), (1, "", "", None, 1, 0.4), (1, "", "", "113", 1, 0.4)), KEYS, "server", nulls=True, by_distance=False)
    assert one(server).server is None
    assert vote.vote(readings(spark), KEYS, "points").count() == 0


def test_clean_reading_beats_tainted_majority(spark):
    df = readings(spark, (1, "A", "x", "1", 5, 0.4), (1, "B", "x", "1", 9, 0.4, True, True), (1, "B", "x", "1", 9, 0.4, True, True))
    got = vote.merge_readings(df, KEYS).first()
    assert (got.commander, got.points, got.n_obs, got.n_clean, got.used_tainted) == ("A", 5, 3, 1, False)
    only = vote.merge_readings(readings(spark, (1, "B", "x", "1", 9, 0.4, True, True)), KEYS).first()
    assert only.used_tainted


def test_names_vote_by_core_and_by_likeness(spark):
    df = readings(spark, (1, "★Alpha★", "x", "1", 5, 0.4), (1, "Alpha", "x", "1", 5, 0.4), (1, "ALPHA", "x", "1", 5, 0.4), (1, "Beta", "x", "1", 5, 0.45))
    got = vote.vote_name(df, KEYS).first()
    assert (got.commander, got.agreement) == ("★Alpha★", 0.75)
    near = readings(spark, (1, "Alphabet", "x", "1", 5, 0.2), (1, "Alphabat", "x", "1", 5, 0.44), (1, "Alphabot", "x", "1", 5, 0.1), (1, "Zzzzz", "x", "1", 5, 0.45))
    won = vote.vote_name_similar(near, KEYS).first()
    assert (won.commander, won.agreement) == ("Alphabat", 0.75)


def test_unreadable_name_keeps_the_row(spark):
    df = spark.createDataFrame([("e", 1, "", "x", "1", 5, 0.4, 1, True, False, True)], READINGS)
    got = vote.merge_readings(df, KEYS).first()
    assert (got.commander, got.points, got.commander_agreement) == ("(name unreadable by OCR)", 5, 1.0)


def test_keep_best_fills_missing_fields(spark):
    df = readings(spark, (1, "A", "", None, None, 0.45), (1, "A", "x", None, 5, 0.2))
    score = legacy.reading_score(F.col("y"), F.col("points"), F.col("commander"), F.col("alliance"))
    got = vote.keep_best(df, KEYS, score, ["points", "commander", "alliance"]).first()
    assert (got.points, got.commander, got.alliance) == (5, "A", "x")


def test_checks(spark):
    df = players(spark, (1, "a", "X", "1", 10), (2, "", "X", "1", 20), (5, "a", "X", "1", None))
    assert sorted(r["rank"] for r in quality.missing_ranks(df).collect()) == [3, 4]
    assert [(r.rank_before, r["rank"]) for r in quality.order_violations(df).collect()] == [(1, 2)]
    found = {r.error: r["sample"] for r in quality.validate(df).collect()}
    assert found == {"missing rank": [3, 4], "empty commander": [2], "missing points": [5], "not monotonic": [2]}
    assert [r.ranks for r in quality.duplicate_players(df).collect()] == [[1, 5]]
    assert quality.validate(players(spark)).count() == 0


def test_consolidation_and_repairs(spark):
    df = players(spark, *[(i, "c", "[IO] Team", "1", 1) for i in range(1, 4)], (4, "c", "[l0] Team", "1", 1), (5, "c", "No Alliance", "1", 1))
    assert [(r.variant, r.canonical, r.n) for r in clean.consolidate_labels(df, ["event_id"]).collect()] == [("[l0] Team", "[IO] Team", 1)]
    known = spark.createDataFrame([("[GRK] Garlock",), ("[ABL] Team",)], "label string")
    now = players(spark, (1, "c", "UGRKI Garlock", "1", 1), (2, "c", "UXXXI Other", "1", 1), (3, "c", "[AB1] Team", "1", 1), (4, "c", None, "1", 1))
    got = {r.alliance: (r.after, r.reason, list(r.reviews)) for r in clean.label_repairs(now, known).collect()}
    assert got["UGRKI Garlock"][:2] == ("[GRK] Garlock", "bracket repair")
    assert got["UXXXI Other"][0] == "UXXXI Other"
    assert got["[AB1] Team"][:2] == ("[ABL] Team", "known alliance")
    many = players(spark, *[(i, "c", "[AB1] Team", "1", 1) for i in range(1, 50)])
    listed = clean.label_repairs(many, known).first()
    assert (listed.after, list(listed.reviews)) == ("[AB1] Team", ["[ABL] Team"])
    manual = clean.label_repairs(many, known, {"[AB1] Team": "[Q] Q"}).first()
    assert (manual.after, manual.reason) == ("[Q] Q", "manual override")
    cleaned, changes, reviews = clean.apply_repairs(many, clean.label_repairs(many, known))
    assert (cleaned.count(), changes.count(), reviews.count()) == (49, 0, 49)


def test_unknown_names_are_reported_not_renamed(spark):
    before = players(spark, (1, "Alpha", "[A] A", "117", 1))
    now = players(spark, (1, "Alphx", "[A] A", "117", 1), (2, "Gamma", "[A] A", "117", 1))
    got = clean.name_candidates(now, clean.known_names(before), clean.known_name_labels(before)).collect()
    assert [(r["rank"], r.observed, r.known) for r in got] == [(1, "Alphx", "Alpha")]
    overrides = spark.createDataFrame([("117", "Alphx", "Alpha"), (None, "Gamma", "No")], "server string, observed string, canonical string")
    assert sorted((r.commander, r.overridden) for r in clean.name_overrides(now, overrides).collect()) == [("Alpha", True), ("Gamma", False)]


def merged(spark, a, b, cutoff=None):
    pairs = early.match_early(a, b)
    cut = early.clean_cutoff(a, b, pairs)
    return {r.event_id: r.cutoff for r in cut.collect()}.get("e")


def test_early_cutoffs(spark):
    a = players(spark, (1, "Alpha", "x", "1", 100), (2, "Beta", "x", "1", 90))
    b = players(spark, (1, "Beta", "x", "1", 110), (2, "Alpha", "x", "1", 100))
    assert merged(spark, a, b) == 2
    gap = players(spark, (1, "Alpha", "x", "1", 100), (3, "Beta", "x", "1", 90))
    assert merged(spark, gap, b.where("commander = 'Alpha'")) == 1
    ambiguous = players(spark, (1, "alphb", "x", "1", 100), (2, "alphc", "x", "1", 100))
    assert merged(spark, players(spark, (1, "alpha", "x", "1", 90)), ambiguous) == 0
    got = early.merge_early(a, b, early.match_early(a, b), spark.createDataFrame([("e", 1)], "event_id string, cutoff int")).orderBy("rank").collect()
    assert [(r["rank"], r.commander, r.points, r.passed) for r in got] == [(1, "Alpha", 100, False), (2, "Beta", 110, True)]


def test_cutoff_matches_the_loop_on_random_lists(spark):
    import random

    rng = random.Random(5)
    early_rows, later_rows, pair_rows, wanted = [], [], [], {}
    for e in range(60):
        n = rng.randint(1, 6)
        a = [(r, rng.choice([None, 1, 2, 3, 4])) for r in rng.sample(range(1, 8), n)]
        b = [rng.choice([None, 1, 2, 3, 4]) for _ in range(rng.randint(1, 5))]
        partners = dict(zip(rng.sample(sorted(r for r, _ in a), min(n, len(b))), rng.sample(range(1, len(b) + 1), min(n, len(b)))))
        cutoff, included = 0, set()
        for i, (r, p) in enumerate(sorted(a)):
            if r != i + 1 or p is None:
                break
            included |= {partners[r]} if r in partners else set()
            if all(j in included or q is None or q <= p for j, q in enumerate(b, 1)):
                cutoff = r
        wanted[f"e{e}"] = cutoff
        early_rows += [(f"e{e}", i, r, "c", "x", "1", p) for i, (r, p) in enumerate(a)]
        later_rows += [(f"e{e}", j, j, "c", "x", "1", q) for j, q in enumerate(b, 1)]
        pair_rows += [(f"e{e}", r, j) for r, j in partners.items()]
    pairs = spark.createDataFrame(pair_rows, "event_id string, early_rank int, later_pos bigint")
    got = early.clean_cutoff(spark.createDataFrame(early_rows, PLAYERS), spark.createDataFrame(later_rows, PLAYERS), pairs)
    assert {r.event_id: r.cutoff for r in got.collect()} == wanted


def test_registry_rules(spark):
    old = spark.createDataFrame([("a", "1", 0), ("b", "2", 1)], "id string, v string, pos bigint")
    new = spark.createDataFrame([("b", "x", 0), ("c", "y", 1), ("c", "z", 2), (None, "n", 3)], "id string, v string, pos bigint")
    assert [(r.id, r.v) for r in publish.upsert(old, new, "id").orderBy("pos").collect()] == [("c", "z"), ("a", "1"), ("b", "x"), (None, "n")]
    rows = spark.createDataFrame([("f1", "old", 0), ("f2", "k", 1), ("f1", "new", 2), (None, "p", 3), (None, "q", 4)], "id string, v string, pos bigint")
    assert [(r.id, r.v) for r in publish.latest_wins(rows, "id").orderBy("pos").collect()] == [("f1", "new"), ("f2", "k"), (None, "p"), (None, "q")]
    tags = "event_id string, tag string, server string, total_points bigint, rank int"
    standings = spark.createDataFrame([("e", "AA1B", "1", 3_000_000, 1), ("e", "BEB", "1", 1_000_000, 2), ("e", "WEAK", "1", 999_999, 3), ("e", "", "1", 5_000_000, 4), ("e", "OPP", "2", 9_000_000, 5)], tags)
    wanted = publish.allow_list(standings, "1", 1_000_000)
    assert sorted(r.tag for r in wanted.collect()) == ["AA1B", "BEB"]
    held = spark.createDataFrame([("e", "aa1b"), ("e", "WEAK"), ("e", "PAST")], "event_id string, tag string")
    assert sorted((r.tag, r.action) for r in publish.list_difference(wanted, held).collect()) == [("BEB", "add"), ("PAST", "remove"), ("WEAK", "remove")]


def test_captures(spark):
    shown = [("c", f, r, True) for f in range(1, 8) for r in range(10 * f - 9, 10 * f + 1)] + [("c", f, r, True) for f in range(8, 13) for r in range(61, 71)]
    df = spark.createDataFrame(shown, "capture_id string, frame_no bigint, rank int, complete boolean")
    assert sorted(r.frame_no for r in evidence.terminal_stall(df).collect()) == [1, 2, 3, 4, 5, 6, 7, 11, 12]
    frames = df.groupBy("capture_id", "frame_no").agg(F.max("rank").alias("max_rank"), F.concat_ws(",", F.sort_array(F.collect_list(F.col("rank").cast("string")))).alias("fingerprint"))
    assert evidence.bottom_stop(frames).first().stop_frame == 11
    assert evidence.bottom_stop(frames.withColumn("max_rank", F.col("max_rank") - 30)).first().stop_frame is None
    assert evidence.latest_centre(df).first().centre == 65.5
    assert evidence.repair_order([37, 33, 905, 800, 903], 904) == [905, 903, 800, 33, 37]
    assert evidence.repair_order([], None) == []


def test_movements_and_tiers(spark):
    rows = [("e1", 1, 2, "a", "x", "1", 5), ("e2", 1, 1, "a", "x", "1", 7), ("e3", 1, 1, "a", "x", "1", 7), ("e3", 2, 2, "b", "x", "1", None)]
    got = history.movement(spark.createDataFrame(rows, PLAYERS), ["server", "commander"], "event_id").orderBy("event_id", "rank").collect()
    assert [r.movement for r in got] == ["New", "Up", "None", "New"]
    tiers = history.tiers(spark.createDataFrame(rows, PLAYERS), [1], by="rank").collect()
    assert sorted((r.event_id, r.tier, r.points) for r in tiers) == [("e1", "2+", 5), ("e2", "1-1", 7), ("e3", "1-1", 7), ("e3", "2+", 0)]
