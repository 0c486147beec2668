"""Queries leave out no part of their tables; what the SQL leaves out is tested here by cases."""

import os
import random
import unicodedata

import __spark_entry__ as entry_point
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from podium.functions.text import CONFUSABLE_FROM, CONFUSABLE_TO, normal_label
from podium.operators import clean
from podium.operators.early import within
from podium.plans.boards import board


def write(folder, name, rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}
    fields = pa.schema([(n, kinds[c.split()[1]]) for n, c in zip(names, schema.split(", "))])
    pq.write_table(pa.Table.from_pylist([dict(zip(names, r)) for r in rows], fields), os.path.join(folder, f"{name}.parquet"))


def run(spark, name, folder):
    return entry_point.queries()[name](spark, str(folder))


def test_matchup_screens_of_every_home_server(spark, tmp_path):
    events = [(f"e{n}", str(1000 + n), "1500", ("attacking", "defending")[n % 2], n, 0) for n in range(1, 13)]
    write(tmp_path, "war_manifest", events, "event_id string, home_server string, opponent_server string, home_role string, total_points bigint, published_at timestamp")
    got = {(r.frame, r.home_role, r.opponent, r.battle_over, r.home_result) for r in run(spark, "screen_matchup", tmp_path).collect()}
    assert got == {(e, role, other, True, "victory") for e, _, other, role, _, _ in events}


BOARD = "row_id bigint, event_id string, scan_id string, scan_kind string, rank int, commander string, alliance string, alliance_tag string, alliance_name string, server string, points bigint"


def boards(folder, rows):
    """Final lists of (event, rank, commander, alliance, server)."""
    write(folder, "rankings", [(n, e, f"{e}f", "final", rank, name, label, None, None, server, 1000 - rank) for n, (e, rank, name, label, server) in enumerate(rows)], BOARD)


def core(name):
    return "".join(c for c in unicodedata.normalize("NFKC", name) if c.isalnum()).casefold()


def near(a, b):
    """Within one edit in look-alike keys."""
    a, b = ("".join(c for c in unicodedata.normalize("NFKC", x).casefold().translate(str.maketrans(CONFUSABLE_FROM, CONFUSABLE_TO)) if c.isalnum()) for x in (a, b))
    return within(a, b, 1)


NAMES = ["Wulfgar", "Wulfgat", "Wulfgarr", "Ørvald", "Ørvald!", "Ørvalt", "Дракон", "Дракн", "Дракoн", "Zoë Quinn", "Zoe Quinn", "Mirabeth", "M1rabeth", "Other"]


def test_fuzzy_candidates_are_those_of_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(e, rank, rng.choice(NAMES), rng.choice(["A", "B"]), "1") for e in "abcdefgh" for rank in range(1, 8)]
    known = [(n, "commander", "1", name, label, n) for n, (name, label) in enumerate([(x, y) for x in NAMES[::2] for y in ("A", "B") if rng.random() < 0.8])]
    boards(tmp_path, rows)
    write(tmp_path, "known_names", known, "name_id bigint, kind string, server string, commander string, alliance string, n_seen bigint")
    keys = {core(k[3]) for k in known}
    best = {x: min((-k[5], k[3]) for k in known if core(k[3]) == x)[1] for x in keys}
    want = set()
    for e, rank, name, label, server in rows:
        listed = {core(r[2]) for r in rows if r[0] == e}
        want |= {(e, rank, server, name, best[core(k[3])], label) for k in known if core(name) not in keys and k[4] == label and core(k[3]) not in listed and near(name, best[core(k[3])])}
    got = [tuple(r) for r in run(spark, "fuzzy_candidates", tmp_path).select("event_id", "rank", "server", "observed", "known", "alliance").collect()]
    assert len(got) == len(set(got)) and set(got) == want and any(not x[3].isascii() for x in want) and len({x[1] % 2 for x in want}) == 2


def test_every_event_gets_what_it_would_get_alone(spark, tmp_path):
    rng = random.Random(5)
    labels = ["A", "B", "[UIJ] Ünder Team", "[U1J] Ünder Team", "[ABC] Team", "[A8C] Team", "IABCI Team"]
    rows = [(e, rank, rng.choice(NAMES), rng.choice(labels), rng.choice("12")) for e in "abcd" for rank in range(1, 13)]
    rows += [(e, 20, "Wulfgar", "A", "1") for e in "ac"] + [("d", 21, "Wu1fgarx", "A", "1")]
    boards(tmp_path, rows)
    write(tmp_path, "alliance_registry", [("[ABC] Team",), ("[UIJ] Ünder Team",)], "alliance string")
    players = board(spark, str(tmp_path)).withColumn("pos", F.col("row_id"))
    known = spark.read.parquet(f"{tmp_path}/alliance_registry.parquet").select(normal_label(F.col("alliance")).alias("label"))
    repairs, found = set(), set()
    for e in "abcd":
        now, before = players.where(F.col("event_id") == e), players.where(F.col("event_id") < e)
        repairs |= {(e, r.alliance, r.after, r.reason, tuple(r.reviews)) for r in clean.label_repairs(now, known).collect()}
        found |= {(e, *r) for r in clean.name_candidates(now, clean.known_names(before), clean.known_name_labels(before)).collect()}
    assert {(r.event_id, r.alliance, r.after, r.reason, tuple(r.reviews)) for r in run(spark, "label_repairs", tmp_path).collect()} == repairs
    got = [tuple(r) for r in run(spark, "name_candidates", tmp_path).collect()]
    assert len(got) == len(set(got)) and set(got) == found and len({x[0] for x in found}) > 1
    assert len({r[0] for r in repairs if r[1] != r[2]}) > 1


def test_merged_prefix_may_be_longer_than_25(spark, tmp_path):
    final = [(n, "e", "f", "final", n, f"n{n}", "A", None, None, "1", 1000 - n) for n in range(1, 41)]
    early = [(100 + n, "e", "a", "incremental", n, f"n{41 - n if n <= 30 else 100 + n}", "A", None, None, "1", 5000 - n) for n in range(1, 35)]
    write(tmp_path, "rankings", final + early, BOARD)
    got = [(r.rank, r.commander, r.points, r.later_rank) for r in run(spark, "prefix_merge_renumber", tmp_path).orderBy("rank").collect()]
    want = [(f"n{41 - n}", 5000 - n, 41 - n) for n in range(1, 31)] + [(f"n{n}", 1000 - n, n) for n in range(1, 11)]
    assert got == [(rank, *x) for rank, x in enumerate(want, 1)]


def test_rows_beyond_ascii_are_kept(spark, tmp_path):
    rows = [("e", 1, "Ørvald", "［ÜB］ Ünder  ", "1001"), ("e", 2, "ØRVALD!", "[ÖR] TeIIer É", "1001"), ("e", 3, "Ann", "[ÖR] Teller É", "1001"), ("e", 4, "Bea", "[ÖR] Teller É", "1001"), ("e", 5, "Cem", "[ŸZ] Low", "1001")]
    boards(tmp_path, [(e, r, c, a, s) for e, r, c, a, s in rows])
    table = pq.read_table(f"{tmp_path}/rankings.parquet")
    at = table.schema.get_field_index("points")
    pq.write_table(table.set_column(at, "points", pa.array([3_000_000, 300_000, 2_000_000, 2_000_000, 250_000])), f"{tmp_path}/rankings.parquet")
    rows_of = lambda name: sorted(tuple(r) for r in run(spark, name, tmp_path).collect())
    assert [r[0] for r in rows_of("parse_labels")] == [0, 1, 2, 3, 4] and rows_of("parse_labels")[2][1:] == ("ÖR", "Teller É")
    assert rows_of("lookalike_consolidation") == [("e", "[ÖR] TeIIer É", "[ÖR] Teller É", 1)]
    assert [r[:2] + r[3:] for r in rows_of("known_index")] == [("1001", "ann", 1), ("1001", "bea", 1), ("1001", "cem", 1), ("1001", "ørvald", 2)]
    assert rows_of("known_labels") == [("[ÖR] TeIIer É",), ("[ÖR] Teller É",), ("[ÜB] Ünder",), ("[ŸZ] Low",)]
    assert (0, "alliance", "［ÜB］ Ünder  ", "[ÜB] Ünder") in rows_of("change_log")
    assert rows_of("threshold_allowlist") == [("e", "ÖR", 4_000_000)]
    assert rows_of("allowlist_diff") == [("e", "ŸZ", "remove")]
