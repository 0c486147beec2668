"""Queries on lists: standings, votes and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators import legacy, quality, rollup, vote
from podium.plans import sqltext as q
from podium.plans.boards import BOARD_SQL, READINGS_SQL, board, readings
from podium.session import table

_P = "coalesce(points, 0)"


def alliance_standings(s: SparkSession, d: str) -> DataFrame:
    return rollup.alliance_standings(board(s, d))


def dominant_server(s: SparkSession, d: str) -> DataFrame:
    return rollup.dominant(board(s, d), ["event_id", "alliance"], "server")


def roster_members_topn(s: SparkSession, d: str) -> DataFrame:
    return rollup.top_members(board(s, d), 5)


def server_totals(s: SparkSession, d: str) -> DataFrame:
    return rollup.server_totals(board(s, d))


def event_totals(s: SparkSession, d: str) -> DataFrame:
    return rollup.event_totals(board(s, d))


def server_map(s: SparkSession, d: str) -> DataFrame:
    return rollup.server_map(board(s, d)).select("event_id", F.explode("servers").alias("server", "v")).select("event_id", "server", "v.*")


def player_server_rank(s: SparkSession, d: str) -> DataFrame:
    return rollup.player_server_rank(board(s, d))


def share_of_alliance(s: SparkSession, d: str) -> DataFrame:
    return rollup.share_of_alliance(board(s, d))


def vote_points(s: SparkSession, d: str) -> DataFrame:
    return vote.vote(readings(s, d), ["event_id", "rank"], "points")


def vote_server(s: SparkSession, d: str) -> DataFrame:
    return vote.vote(readings(s, d), ["event_id", "rank"], "server", nulls=True, by_distance=False)


def vote_tiered(s: SparkSession, d: str) -> DataFrame:
    kept = vote.best_tier(readings(s, d), ["event_id", "rank"])
    return kept.select("event_id", "rank", "seq", "n_obs", "n_clean", "used_tainted")


def _small_core(column: str):
    return F.translate(F.lower(F.regexp_replace(column, r"[^\p{L}\p{N}]", "")), "ς", "σ")


def vote_name_key(s: SparkSession, d: str) -> DataFrame:
    """The name vote with a core of small letters and digits, which SQL has too."""
    return vote.vote_name(readings(s, d), ["event_id", "rank"], key=_small_core("commander"))


def vote_name(s: SparkSession, d: str) -> DataFrame:
    """The name vote on normalised, case-folded cores."""
    return vote.vote_name(readings(s, d), ["event_id", "rank"])


def similarity_vote(s: SparkSession, d: str) -> DataFrame:
    return vote.vote_name_similar(readings(s, d), ["event_id", "rank"])


def merged_records(s: SparkSession, d: str) -> DataFrame:
    return vote.merge_readings(readings(s, d), ["event_id", "rank"])


def keep_best(s: SparkSession, d: str) -> DataFrame:
    score = legacy.reading_score(F.col("y"), F.col("points"), F.col("commander"), F.col("alliance"))
    out = vote.keep_best(readings(s, d), ["event_id", "rank"], F.round(score, 6), ["points", "commander", "alliance"])
    return out


def missing_ranks(s: SparkSession, d: str) -> DataFrame:
    """Ranks that no row of a scan has, for every scan."""
    return quality.missing_ranks(table(s, d, "rankings"), group="scan_id")


def unread_ranks(s: SparkSession, d: str) -> DataFrame:
    """Ranks of a scan of which no row has points, up to the last that has."""
    return quality.missing_ranks(table(s, d, "rankings").where("points is not null"), group="scan_id")


def monotonic_violations(s: SparkSession, d: str) -> DataFrame:
    """Rows of an event, in the order they were delivered, with more points than the one before."""
    return quality.order_violations(readings(s, d), order="seq")


def _listed(found: DataFrame) -> DataFrame:
    return found.select("event_id", "name_key", "alliance", "n", F.concat_ws(",", F.transform("ranks", lambda r: r.cast("string"))).alias("ranks"))


def duplicate_entities(s: SparkSession, d: str) -> DataFrame:
    return _listed(quality.duplicate_players(board(s, d), key=_small_core("commander")))


def duplicate_players(s: SparkSession, d: str) -> DataFrame:
    return _listed(quality.duplicate_players(board(s, d)))


def _doubts(s: SparkSession, d: str) -> DataFrame:
    r = vote.best_tier(readings(s, d), ["event_id", "rank"])
    counts = r.groupBy("event_id", "rank").agg(F.first("n_clean").alias("n_clean"))
    points = vote.vote(r, ["event_id", "rank"], "points").select("event_id", "rank", "points", F.col("agreement").alias("points_agreement"))
    names = vote.vote_name(r, ["event_id", "rank"], key=_small_core("commander")).select("event_id", "rank", F.col("agreement").alias("commander_agreement"))
    return counts.join(points, ["event_id", "rank"]).join(names, ["event_id", "rank"], "left")


def problem_union(s: SparkSession, d: str) -> DataFrame:
    return quality.problem_ranks(_doubts(s, d))


def unresolved_ranks(s: SparkSession, d: str) -> DataFrame:
    return quality.unresolved_ranks(_doubts(s, d))


def single_clean_ranks(s: SparkSession, d: str) -> DataFrame:
    return quality.single_clean_ranks(_doubts(s, d))


def validate_lists(s: SparkSession, d: str) -> DataFrame:
    found = quality.validate(board(s, d))
    return found.select("event_id", "error", "n", F.concat_ws(",", F.transform("sample", lambda r: r.cast("string"))).alias("sample"))


def qa_report(s: SparkSession, d: str) -> DataFrame:
    return quality.report(merged_records(s, d))


def legacy_server_summary(s: SparkSession, d: str) -> DataFrame:
    return legacy.server_summary(board(s, d), ["1001", "1002"])


def legacy_alliance_rollup(s: SparkSession, d: str) -> DataFrame:
    return legacy.alliance_rollup(board(s, d))


def top_alliances(s: SparkSession, d: str) -> DataFrame:
    totals = board(s, d).groupBy("alliance").agg(F.count("*").alias("members"), F.sum(F.coalesce("points", F.lit(0))).alias("points"))
    return legacy.top(totals.withColumn("avg_points", F.expr("points div members")), 15, F.desc("points"), F.asc_nulls_first("alliance"))


def top_players(s: SparkSession, d: str) -> DataFrame:
    return legacy.top(board(s, d).select("event_id", "rank", "commander", "alliance", "points"), 15, "event_id", "rank")


def label_server(s: SparkSession, d: str) -> DataFrame:
    return board(s, d).select("row_id", legacy.server_in_label(F.concat_ws(" ", "alliance", F.concat(F.lit("S"), "server")), ["1001", "1002", "1003"], "1004").alias("server"))


QUERIES = {
    f.__name__: f
    for f in (
        alliance_standings, dominant_server, roster_members_topn, server_totals, event_totals, server_map, player_server_rank, share_of_alliance, vote_points, vote_server, vote_tiered,
        vote_name_key, vote_name, similarity_vote, merged_records, keep_best, missing_ranks, unread_ranks, monotonic_violations, duplicate_entities, duplicate_players, problem_union, unresolved_ranks,
        single_clean_ranks, validate_lists, qa_report, legacy_server_summary, legacy_alliance_rollup, top_alliances, top_players, label_server,
    )
}

_SERVER_OF = """dom AS (
  SELECT event_id, alliance, server FROM (SELECT event_id, alliance, server, count(*) AS n, min(pos) AS p FROM board GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY event_id, alliance ORDER BY n DESC, p) = 1
)"""
_TOTALS = f"totals AS (SELECT event_id, server, count(*) AS players, sum({_P})::BIGINT AS points FROM board GROUP BY ALL)"
_SHARE = "CASE WHEN sum(points) OVER (PARTITION BY event_id) > 0 THEN round_even(points / sum(points) OVER (PARTITION BY event_id) * 100, 2) ELSE 0.0 END"
_VOTE = """
  SELECT event_id, rank, v AS {value}, n AS votes, sum(n) OVER (PARTITION BY event_id, rank)::BIGINT AS n_valid,
    CASE WHEN sum(n) OVER (PARTITION BY event_id, rank) > 0 THEN round_even(n / sum(n) OVER (PARTITION BY event_id, rank), 3) ELSE 0.0 END AS agreement
  FROM (SELECT event_id, rank, CASE WHEN {valid} THEN {value} END AS v, count(*) FILTER ({valid}) AS n, min({near}) AS k FROM {rows} GROUP BY event_id, rank, {value})
  QUALIFY row_number() OVER (PARTITION BY event_id, rank ORDER BY n DESC, k NULLS LAST) = 1"""
_NEAR = "struct_pack(d := abs(y - 0.45), s := seq)"
_CORE = r"translate(lower(regexp_replace(commander, '[^\p{L}\p{N}]', '', 'g')), 'ς', 'σ')"
_NAMES = f"""
  SELECT event_id, rank, commander, round_even(n / whole, 3) AS agreement FROM (
    SELECT event_id, rank, core, sum(n) AS n, min(k) AS k, arg_min(commander, struct_pack(m := -n, s := s)) AS commander, sum(sum(n)) OVER (PARTITION BY event_id, rank) AS whole
    FROM (SELECT event_id, rank, {_CORE} AS core, commander, count(*) AS n, min({_NEAR}) AS k, min(seq) AS s FROM {{rows}} WHERE commander <> '' GROUP BY ALL)
    GROUP BY event_id, rank, core)
  QUALIFY row_number() OVER (PARTITION BY event_id, rank ORDER BY n DESC, k) = 1"""
_TIERED = """tiered AS (
  SELECT *, count(*) OVER w AS n_obs, count(*) FILTER (tier = 1) OVER w AS n_clean,
    CASE min(tier) OVER w WHEN 1 THEN false WHEN 2 THEN true ELSE bool_or(coalesce(tainted, false)) OVER w END AS used_tainted, min(tier) OVER w AS best
  FROM (SELECT *, CASE WHEN coalesce(complete, false) AND NOT coalesce(tainted, false) THEN 1 WHEN coalesce(complete, false) THEN 2 ELSE 3 END AS tier FROM readings)
  WINDOW w AS (PARTITION BY event_id, rank)
), pool AS (SELECT * FROM tiered WHERE tier = best)"""
_DOUBTS = f"""{READINGS_SQL}, {_TIERED}, pv AS ({_VOTE.format(value="points", valid="points IS NOT NULL", near=_NEAR, rows="pool")}), nv AS ({_NAMES.replace("{rows}", "pool")}),
doubts AS (SELECT c.event_id, c.rank, c.n_clean, pv.points, pv.agreement AS points_agreement, nv.agreement AS commander_agreement
  FROM (SELECT event_id, rank, any_value(n_clean) AS n_clean FROM pool GROUP BY ALL) c JOIN pv USING (event_id, rank) LEFT JOIN nv USING (event_id, rank))"""
# Names by the full key, and by likeness where at most half agree: matching blocks as Ratcliff and Obershelp find them,
# the longest first, then the earliest in the one text and in the other, left and right of it in turn.
_KEYED = _NAMES.replace(_CORE, q.name_key("commander"))
_BLOCK = """list_aggregate(flatten(list_transform(range(alo, ahi), lambda i: list_transform(range(blo, bhi), lambda j: struct_pack(
      k := len(list_filter(range(1, least(ahi - i, bhi - j) + 1), lambda l: a[i:i + l - 1] = b[j:j + l - 1])), i := -i, j := -j)))), 'max')"""
_SIMILAR = f"""keyed AS ({_KEYED}), unsure AS (SELECT event_id, rank FROM keyed WHERE agreement <= 0.5),
    spellings AS (SELECT event_id, rank, commander AS name, {q.name_key('commander')} AS core, count(*) AS n, min({_NEAR}) AS k, min(seq) AS s FROM {{rows}} SEMI JOIN unsure USING (event_id, rank) WHERE commander <> '' GROUP BY ALL),
    pairs AS (SELECT DISTINCT x.core AS a, y.core AS b FROM spellings x JOIN spellings y USING (event_id, rank) WHERE x.core <> y.core),
    blocks AS (SELECT a, b, alo, ahi, blo, bhi, {_BLOCK} AS m FROM (SELECT *, 1 AS alo, length(a) + 1 AS ahi, 1 AS blo, length(b) + 1 AS bhi FROM pairs WHERE a <> '' AND b <> '')
      UNION ALL SELECT a, b, alo, ahi, blo, bhi, {_BLOCK} AS m FROM (
        SELECT a, b, unnest([alo, m.k - m.i]) AS alo, unnest([-m.i, ahi]) AS ahi, unnest([blo, m.k - m.j]) AS blo, unnest([-m.j, bhi]) AS bhi FROM blocks WHERE m.k > 0) WHERE alo < ahi AND blo < bhi),
    alike AS (SELECT a, b FROM blocks GROUP BY a, b HAVING 2.0 * sum(m.k) / (length(a) + length(b)) >= 0.8),
    partners AS (SELECT x.event_id, x.rank, x.name, x.s, y.name AS other, y.n, y.k FROM spellings x JOIN spellings y USING (event_id, rank) WHERE x.core = y.core OR EXISTS (SELECT 1 FROM alike l WHERE l.a = x.core AND l.b = y.core)),
    groups AS (SELECT event_id, rank, name, s, sum(n) AS votes, arg_min(other, k) AS best FROM partners GROUP BY ALL),
    whole AS (SELECT event_id, rank, sum(n) AS n FROM spellings GROUP BY ALL),
    likened AS (SELECT event_id, rank, commander, agreement FROM keyed ANTI JOIN unsure USING (event_id, rank)
      UNION ALL SELECT g.event_id, g.rank, best, round_even(votes / n, 3) FROM groups g JOIN whole USING (event_id, rank) QUALIFY row_number() OVER (PARTITION BY g.event_id, g.rank ORDER BY votes DESC, s) = 1)"""
_MERGED = f"""{READINGS_SQL}, {_TIERED}, {_SIMILAR.replace("{rows}", "pool")},
    pv AS ({_VOTE.format(value="points", valid="points IS NOT NULL", near=_NEAR, rows="pool")}), av AS ({_VOTE.format(value="alliance", valid="alliance <> ''", near=_NEAR, rows="pool")}), sv AS ({_VOTE.format(value="server", valid="true", near="seq", rows="pool")}),
    facts AS (SELECT event_id, rank, any_value(n_obs) AS n_obs, any_value(n_clean) AS n_clean, any_value(used_tainted) AS used_tainted, bool_or(name_unreadable) AS name_unreadable FROM pool GROUP BY ALL),
    merged AS (SELECT f.event_id, f.rank, CASE WHEN c.commander IS NULL AND name_unreadable THEN '(name unreadable by OCR)' ELSE coalesce(c.commander, '') END AS commander, coalesce(av.alliance, '') AS alliance, sv.server, pv.points, n_obs, n_clean, used_tainted, name_unreadable,
      pv.agreement AS points_agreement, CASE WHEN c.commander IS NULL AND name_unreadable THEN 1.0 ELSE coalesce(c.agreement, 0.0) END::DOUBLE AS commander_agreement, av.agreement AS alliance_agreement
      FROM facts f LEFT JOIN pv USING (event_id, rank) LEFT JOIN av USING (event_id, rank) LEFT JOIN sv USING (event_id, rank) LEFT JOIN likened c USING (event_id, rank))"""
_GAPS = "SELECT event_id, unnest(range(prev + 1, rank)) AS rank FROM (SELECT event_id, rank, coalesce(lag(rank) OVER (PARTITION BY event_id ORDER BY rank), 0) AS prev FROM (SELECT DISTINCT event_id, rank FROM {rows}))"
_BREAKS = "SELECT event_id, rank_before, points_before, rank, points FROM (SELECT event_id, rank, points, lag(rank) OVER w AS rank_before, lag(points) OVER w AS points_before FROM {rows} WINDOW w AS (PARTITION BY event_id ORDER BY rank)) WHERE points > points_before"
_SAMPLE = "SELECT event_id, '{error}' AS error, count(*) AS n, string_agg(rank::VARCHAR, ',' ORDER BY rank) FILTER (k <= 15) AS sample FROM (SELECT event_id, rank, row_number() OVER (PARTITION BY event_id ORDER BY rank) AS k FROM ({rows})) GROUP BY event_id"

ORACLE = {
    "alliance_standings": f"""WITH {BOARD_SQL}, {_SERVER_OF}, rolled AS (
      SELECT event_id, alliance, count(*) AS members_count, sum({_P})::BIGINT AS total_points, min(pos) AS first_pos,
        arg_max(struct_pack(c := commander, p := {_P}, r := rank), struct_pack(p := {_P}, q := -pos)) AS t FROM board GROUP BY ALL
    ), ranked AS (
      SELECT rolled.*, dom.server, row_number() OVER (PARTITION BY rolled.event_id ORDER BY total_points DESC, first_pos) AS rank
      FROM rolled JOIN dom ON rolled.event_id = dom.event_id AND rolled.alliance IS NOT DISTINCT FROM dom.alliance)
    SELECT event_id, alliance, server, members_count, total_points, total_points // members_count AS avg_points, t.c AS top_commander, t.p AS top_points, t.r AS top_rank, rank,
      row_number() OVER (PARTITION BY event_id, server ORDER BY rank) AS server_rank FROM ranked""",
    "dominant_server": f"WITH {BOARD_SQL}, {_SERVER_OF} SELECT * FROM dom",
    "roster_members_topn": f"""WITH {BOARD_SQL} SELECT event_id, alliance, commander, rank, points, server, row_number() OVER (PARTITION BY event_id, alliance ORDER BY {_P} DESC, pos) AS member_rank
      FROM board QUALIFY member_rank <= 5""",
    "server_totals": f"WITH {BOARD_SQL}, {_TOTALS} SELECT event_id, server, players, points, {_SHARE} AS point_share_pct FROM totals",
    "event_totals": f"WITH {BOARD_SQL} SELECT event_id, count(*) AS total_players, sum({_P})::BIGINT AS total_points, count(DISTINCT alliance) AS unique_alliances FROM board GROUP BY event_id",
    "server_map": f"WITH {BOARD_SQL}, {_TOTALS} SELECT event_id, coalesce(server, 'home') AS server, 'S' || coalesce(server, 'home') AS name, players, points, {_SHARE} AS point_share_pct FROM totals",
    "player_server_rank": f"WITH {BOARD_SQL} SELECT event_id, rank, commander, server, points, row_number() OVER (PARTITION BY event_id, server ORDER BY pos) AS server_rank FROM board",
    "share_of_alliance": f"""WITH {BOARD_SQL} SELECT event_id, rank, commander, alliance,
      CASE WHEN sum({_P}) OVER w > 0 THEN round({_P} / sum({_P}) OVER w * 100, 4) END AS share_pct FROM board WINDOW w AS (PARTITION BY event_id, alliance)""",
    "vote_points": f"WITH {READINGS_SQL} {_VOTE.format(value='points', valid='points IS NOT NULL', near=_NEAR, rows='readings')}",
    "vote_server": f"WITH {READINGS_SQL} {_VOTE.format(value='server', valid='true', near='seq', rows='readings')}",
    "vote_tiered": f"WITH {READINGS_SQL}, {_TIERED} SELECT event_id, rank, seq, n_obs, n_clean, used_tainted FROM pool",
    "vote_name_key": f"WITH {READINGS_SQL} {_NAMES.replace('{rows}', 'readings')}",
    "vote_name": f"WITH {READINGS_SQL} {_KEYED.replace('{rows}', 'readings')}",
    "similarity_vote": f"WITH RECURSIVE {READINGS_SQL}, {_SIMILAR.replace('{rows}', 'readings')} SELECT * FROM likened",
    "merged_records": f"WITH RECURSIVE {_MERGED} SELECT * FROM merged",
    "qa_report": f"""WITH RECURSIVE {_MERGED}, stepped AS (SELECT *, lag(rank) OVER w AS r, lag(points) OVER w AS p FROM merged WINDOW w AS (PARTITION BY event_id ORDER BY rank)),
      doubles AS (SELECT event_id, count(*) AS n FROM (SELECT event_id FROM merged WHERE NOT name_unreadable AND {q.name_key('commander')} <> '' GROUP BY event_id, {q.name_key('commander')}, alliance HAVING count(*) > 1) GROUP BY event_id),
      told AS (SELECT event_id, count(*) AS n_records, max(rank) AS max_rank, count(*) FILTER (used_tainted) AS n_tainted, count(*) FILTER (n_clean = 1) AS n_single_clean, count(*) FILTER (name_unreadable) AS n_unreadable,
        (max(rank) - count(*))::BIGINT AS n_missing, count(*) FILTER (points > p) AS n_violations, count(*) FILTER (n_clean = 0 OR points_agreement <= 0.5 OR commander_agreement < 0.5) AS n_unresolved FROM stepped GROUP BY event_id)
      SELECT told.*, coalesce(n, 0) AS n_duplicates, n_missing = 0 AND n_violations = 0 AND n_unresolved = 0 AND coalesce(n, 0) = 0 AS passed FROM told LEFT JOIN doubles USING (event_id)""",
    "keep_best": f"""WITH {READINGS_SQL}, scored AS (
      SELECT *, round(100 - 50 * abs(y - 0.45) + CASE WHEN points IS NOT NULL THEN 30 ELSE 0 END + CASE WHEN commander <> '' THEN 20 ELSE 0 END + CASE WHEN alliance <> '' THEN 10 ELSE 0 END, 6) AS q FROM readings)
    SELECT event_id, rank, max(q) AS score, arg_max(points, struct_pack(q := q, s := -seq)) FILTER (points IS NOT NULL) AS points,
      arg_max(commander, struct_pack(q := q, s := -seq)) FILTER (commander <> '') AS commander, arg_max(alliance, struct_pack(q := q, s := -seq)) FILTER (alliance <> '') AS alliance
    FROM scored GROUP BY event_id, rank""",
    "missing_ranks": _GAPS.replace("event_id", "scan_id").format(rows="rankings"),
    "unread_ranks": _GAPS.replace("event_id", "scan_id").format(rows="rankings WHERE points IS NOT NULL"),
    "monotonic_violations": f"WITH {READINGS_SQL} {_BREAKS.replace('ORDER BY rank', 'ORDER BY seq').format(rows='readings')}",
    "duplicate_entities": f"""WITH {BOARD_SQL} SELECT event_id, {_CORE} AS name_key, alliance, count(*) AS n, string_agg(rank::VARCHAR, ',' ORDER BY rank) AS ranks
      FROM board WHERE commander <> '(name unreadable by OCR)' AND {_CORE} <> '' GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_players": f"""WITH {BOARD_SQL}, k AS (SELECT event_id, {q.name_key('commander')} AS name_key, alliance, rank FROM board WHERE commander <> '(name unreadable by OCR)')
      SELECT event_id, name_key, alliance, count(*) AS n, string_agg(rank::VARCHAR, ',' ORDER BY rank) AS ranks FROM k WHERE name_key <> '' GROUP BY ALL HAVING count(*) > 1""",
    "problem_union": f"""WITH {_DOUBTS}, breaks AS ({_BREAKS.format(rows="doubts")})
      SELECT event_id, rank, 'gap' AS reason FROM ({_GAPS.format(rows="doubts")})
      UNION SELECT event_id, rank, 'no clean reading' FROM doubts WHERE n_clean = 0
      UNION SELECT event_id, rank, 'agreement' FROM doubts WHERE coalesce(points_agreement, 1) < 1 OR coalesce(commander_agreement, 1) < 0.5
      UNION SELECT event_id, rank, 'order' FROM breaks UNION SELECT event_id, rank_before, 'order' FROM breaks""",
    "unresolved_ranks": f"WITH {_DOUBTS} SELECT event_id, rank FROM doubts WHERE n_clean = 0 OR coalesce(points_agreement, 1) <= 0.5 OR coalesce(commander_agreement, 1) < 0.5",
    "single_clean_ranks": f"WITH {_DOUBTS} SELECT event_id, rank FROM doubts WHERE n_clean = 1",
    "validate_lists": f"""WITH {BOARD_SQL}, b AS (SELECT * FROM board)
      {_SAMPLE.format(error="missing rank", rows=_GAPS.format(rows="b"))}
      UNION ALL {_SAMPLE.format(error="empty commander", rows="SELECT event_id, rank FROM b WHERE commander IS NULL OR commander = ''")}
      UNION ALL {_SAMPLE.format(error="missing points", rows="SELECT event_id, rank FROM b WHERE points IS NULL")}
      UNION ALL {_SAMPLE.format(error="not monotonic", rows="SELECT event_id, rank FROM (" + _BREAKS.format(rows="b") + ")")}""",
    "legacy_server_summary": f"""WITH {BOARD_SQL}, t AS (SELECT event_id, CASE WHEN server IN ('1001', '1002') THEN server ELSE 'other' END AS bucket, count(*) AS players, sum({_P})::BIGINT AS points FROM board GROUP BY ALL)
      SELECT *, CASE WHEN sum(points) OVER w > 0 THEN round(points / sum(points) OVER w * 100, 2) END AS share_pct FROM t WINDOW w AS (PARTITION BY event_id)""",
    "legacy_alliance_rollup": f"WITH {BOARD_SQL} SELECT event_id, alliance, count(*) AS members, sum({_P})::BIGINT AS points, arg_max(coalesce(server, ''), pos) AS server FROM board GROUP BY ALL",
    "top_alliances": f"""WITH {BOARD_SQL} SELECT alliance, count(*) AS members, sum({_P})::BIGINT AS points, sum({_P})::BIGINT // count(*) AS avg_points FROM board GROUP BY alliance
      ORDER BY points DESC, alliance NULLS FIRST LIMIT 15""",
    "top_players": f"WITH {BOARD_SQL} SELECT event_id, rank, commander, alliance, points FROM board ORDER BY event_id, rank LIMIT 15",
    "label_server": f"""WITH {BOARD_SQL}, l AS (SELECT row_id, concat_ws(' ', alliance, 'S' || server) AS t FROM board)
      SELECT row_id, CASE WHEN contains(t, 'S1001') THEN '1001' WHEN contains(t, 'S1002') THEN '1002' WHEN contains(t, 'S1003') THEN '1003' ELSE '1004' END AS server FROM l""",
}
