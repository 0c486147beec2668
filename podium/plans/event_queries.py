"""Queries across events, on screens and on captures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators import early, evidence, frames, history, legacy, publish, rollup
from podium.plans.boards import BOARD_SQL, MANIFEST_SQL, board, manifest
from podium.session import durable, table

_ID = ["server", "commander"]
_EDGES = [10, 50, 100]


def _named(s: SparkSession, d: str) -> DataFrame:
    """One row of each named player of known server in each event."""
    rows = board(s, d).where("commander <> '' and server is not null")
    return rows.groupBy("event_id", "server", "commander").agg(F.min_by(F.struct("rank", "alliance", "points"), "rank").alias("r")).select("event_id", "server", "commander", "r.*")


def _sides(s: SparkSession, d: str) -> DataFrame:
    """Points of each server in each event with the event's date."""
    return rollup.server_totals(board(s, d).where("server is not null")).join(manifest(s, d).select("event_id", "event_date"), "event_id")


def event_trend_delta(s: SparkSession, d: str) -> DataFrame:
    out = history.with_previous(_sides(s, d).select("event_id", "event_date", "server", "players", "points"), ["players", "points"], ["server"], ["event_date", "event_id"])
    return out.select("event_id", "server", "points", "players_change", "points_change")


def rank_movement(s: SparkSession, d: str) -> DataFrame:
    return history.movement(_named(s, d), _ID, "event_id").select("event_id", "server", "commander", "rank", "rank_before", "movement")


def player_profiles(s: SparkSession, d: str) -> DataFrame:
    return history.profiles(_named(s, d), _ID)


def did_not_place(s: SparkSession, d: str) -> DataFrame:
    events = manifest(s, d).select("event_id", F.explode(F.array("home_server", "opponent_server")).alias("server"))
    return history.did_not_place(_named(s, d), events, _ID)


def alias_identity(s: SparkSession, d: str) -> DataFrame:
    """Points of identities over all events, small-letter spellings counted with the first spelling of their server."""
    players = _named(s, d)
    aliases = players.groupBy("server", F.lower("commander").alias("k")).agg(F.min("commander").alias("first")).select(F.concat_ws("|", "server", "k").alias("later"), F.concat_ws("|", "server", "first").alias("earlier"))
    return history.aliased(players, aliases, "server", "commander").groupBy("identity").agg(F.count("*").alias("n"), F.sum(F.coalesce("points", F.lit(0))).alias("points"))


def _ranked(s: SparkSession, d: str) -> DataFrame:
    return rollup.player_server_rank(board(s, d).where("server is not null"))


def tier_sums(s: SparkSession, d: str) -> DataFrame:
    return history.tiers(_ranked(s, d), _EDGES)


def tier_difference(s: SparkSession, d: str) -> DataFrame:
    return history.tier_difference(history.tiers(_ranked(s, d), _EDGES), manifest(s, d))


def score_brackets(s: SparkSession, d: str) -> DataFrame:
    return history.brackets(board(s, d), [1_000_000, 2_000_000, 3_000_000, 4_000_000, 5_000_000])


def same_side_delta(s: SparkSession, d: str) -> DataFrame:
    out = history.same_side(manifest(s, d), ["total_points", "total_players"])
    return out.select("event_id", "home_role", "total_points", "total_points_change", "total_players_change")


def top_alliances_per_server(s: SparkSession, d: str) -> DataFrame:
    return rollup.alliance_standings(board(s, d)).where("server_rank <= 10").select("event_id", "server", "alliance", "total_points", "server_rank")


def qualifying_alliances(s: SparkSession, d: str) -> DataFrame:
    return rollup.alliance_standings(board(s, d)).where("total_points >= 1000000 and alliance <> 'No Alliance' and alliance <> ''").select("event_id", "alliance", "total_points")


def active_players(s: SparkSession, d: str) -> DataFrame:
    return board(s, d).where("points >= 50000").groupBy("event_id").agg(F.count("*").alias("n"))


def search_page(s: SparkSession, d: str) -> DataFrame:
    hits = history.search(board(s, d).select("event_id", "rank", "commander", "alliance"), "iron", ["commander", "alliance"])
    return history.page(hits, ["event_id", "rank"], 20, 1)


def _capture(s: SparkSession, d: str) -> DataFrame:
    """Each scan as a capture of frames of eight ranks that overlap by two, the last shown six times more."""
    rows = table(s, d, "rankings").select(F.col("scan_id").alias("capture_id"), "rank", F.floor((F.col("rank") - 1) / 6).alias("frame_no"), (F.col("points").isNotNull()).alias("complete"))
    over = rows.where("(rank - 1) % 6 < 2 and rank > 6").withColumn("frame_no", F.col("frame_no") - 1)
    shown = rows.unionByName(over)
    last = shown.groupBy("capture_id").agg(F.max("frame_no").alias("last"))
    again = shown.join(last, "capture_id").where("frame_no = last").drop("last").withColumn("frame_no", F.explode(F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.col("frame_no") + i)))
    return shown.unionByName(again)


_CAPTURE = """cap0 AS (SELECT scan_id AS capture_id, rank, (rank - 1) // 6 AS frame_no, points IS NOT NULL AS complete FROM rankings),
cap1 AS (SELECT * FROM cap0 UNION ALL SELECT capture_id, rank, frame_no - 1, complete FROM cap0 WHERE (rank - 1) % 6 < 2 AND rank > 6),
lastf AS (SELECT capture_id, max(frame_no) AS last FROM cap1 GROUP BY ALL),
capture AS (SELECT * FROM cap1 UNION ALL SELECT c.capture_id, rank, frame_no + i, complete FROM cap1 c JOIN lastf l ON c.capture_id = l.capture_id AND frame_no = last, (SELECT unnest(range(1, 7)) AS i))"""
_NEWS = "news AS (SELECT f.capture_id, f.frame_no, coalesce(n, 0) AS n_new FROM (SELECT DISTINCT capture_id, frame_no FROM capture) f LEFT JOIN (SELECT capture_id, frame_no, count(*) AS n FROM (SELECT capture_id, rank, min(frame_no) AS frame_no FROM capture GROUP BY ALL) GROUP BY ALL) g ON f.capture_id = g.capture_id AND f.frame_no = g.frame_no)"


def first_seen_per_frame(s: SparkSession, d: str) -> DataFrame:
    return evidence.new_ranks_per_frame(_capture(s, d))


def terminal_stall(s: SparkSession, d: str) -> DataFrame:
    return evidence.terminal_stall(_capture(s, d))


def bottom_stop(s: SparkSession, d: str) -> DataFrame:
    shown = _capture(s, d).groupBy("capture_id", "frame_no").agg(F.max("rank").alias("max_rank"), F.concat_ws(",", F.sort_array(F.collect_set(F.col("rank").cast("string")))).alias("fingerprint"))
    return evidence.bottom_stop(shown)


def latest_centre(s: SparkSession, d: str) -> DataFrame:
    return evidence.latest_centre(_capture(s, d))


def nearest_slot_join(s: SparkSession, d: str) -> DataFrame:
    """Events of each user by their value against slots at every 25 units, within 10."""
    events = table(s, d, "events").where("value is not null").select("event_id", F.col("user_id").alias("frame"), F.col("value").alias("y"))
    slots = events.select("frame").distinct().select("frame", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("slot")).withColumn("slot_y", F.col("slot") * 25.0)
    found = frames.nearest_slot(events, slots, "frame", "y", "slot", "slot_y", 10.0)
    return found.select("event_id", "slot", F.round("distance", 6).alias("distance"))


def region_filter(s: SparkSession, d: str) -> DataFrame:
    """The first purchase-like event of each user in a region of the plane of value and id."""
    boxes = table(s, d, "events").select(F.col("user_id").cast("string").alias("frame"), F.col("event_id").alias("seq"), F.col("event_type").alias("text"), (F.pmod("event_id", F.lit(100)) / 100.0).alias("x"), (F.pmod(F.floor("value"), F.lit(100)) / 100.0).alias("y"), F.lit(0.0).alias("width"), F.lit(0.0).alias("height"))
    return frames.first_per_region(boxes, "^(click|purchase|view)", 0.2, 0.8, 0.1, 0.9).select("frame", "seq", "text")


#: Ranks on a drawn screen and the height of its first row.
_PER, _TOP = 9, 0.835


def _screens(s: SparkSession, d: str, spoilt: bool = False) -> DataFrame:
    """The board drawn as screens, nine ranks a frame, each with boxes for what the row has of rank, name, label, server and points.

    ``spoilt`` ones show a banner with its close button over every fourth
    frame and misread a rank on every fifth; every seventh has no rank digits,
    and each event ends with a frame that shows no list.
    """
    rows = board(s, d).withColumn("f", F.floor((F.col("rank") - 1) / _PER)).withColumn("k", F.pmod(F.col("rank") - 1, F.lit(_PER)))
    placed = rows.withColumn("frame", F.concat_ws(":", "event_id", "f")).withColumn("yy", F.lit(_TOP) - F.col("k") * frames.PITCH)
    number = F.when((F.col("f") % 5 == 0) & (F.col("k") == 4), F.lit("1")).otherwise(F.col("rank").cast("string")) if spoilt else F.col("rank").cast("string")
    box = lambda shown, text, x, dy, k: F.when(shown, F.struct((F.col("rank") * 10 + k).alias("seq"), text.alias("text"), F.lit(x).alias("x"), (F.col("yy") + dy).alias("y"), F.lit(0.08).alias("width"), F.lit(0.02).alias("height")))
    has = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    parts = F.array(
        box(F.col("f") % 7 != 3 if spoilt else F.lit(True), number, 0.1, 0.0, 0), box(has("commander"), F.col("commander"), 0.40, 0.02, 1), box(has("alliance"), F.col("alliance"), 0.40, 0.0, 2),
        box(has("server"), F.concat(F.lit("S"), "server"), 0.40, -0.02, 3), box(F.col("points").isNotNull(), F.format_number("points", 0), 0.80, 0.0, 4),
    )
    drawn = placed.select("frame", F.explode(F.filter(parts, lambda b: b.isNotNull())).alias("b")).select("frame", "b.*")
    if not spoilt:
        return drawn
    extra = lambda *boxes: F.explode(F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(t).alias("text"), F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(w).alias("width"), F.lit(0.02).alias("height")) for k, t, x, y, w in boxes]))
    banners = placed.where("f % 4 = 1").select("frame").distinct().select("frame", extra((1, "Event begins soon", 0.25, 0.78, 0.3), (2, "X", 0.90, 0.80, 0.02)).alias("b"))
    ends = board(s, d).select(F.concat_ws(":", "event_id", F.lit("end")).alias("frame")).distinct().select("frame", extra((1, "Loading", 0.40, 0.5, 0.1)).alias("b"))
    return drawn.unionByName(banners.unionByName(ends).select("frame", "b.*"))


def _captures(boxes: DataFrame) -> DataFrame:
    """The drawn screens of an event as one capture in the order of its ranks."""
    return boxes.select("frame").distinct().select("frame", F.substring_index("frame", ":", 1).alias("capture_id"), F.coalesce(F.expr("try_cast(substring_index(frame, ':', -1) as int)"), F.lit(1 << 30)).alias("frame_no"))


def frame_parse(s: SparkSession, d: str) -> DataFrame:
    """The board read back from its spoilt screens, frame after frame."""
    boxes = durable(_screens(s, d, spoilt=True))
    parsed = frames.parse_frames(boxes, frames.ranks_before(boxes, _captures(boxes)))
    return parsed.select("frame", "rank", "commander", "alliance", "server", "points", "complete", "tainted", "name_unreadable")


def frame_fits(s: SparkSession, d: str) -> DataFrame:
    """Offset, rows and banner of every frame, those without a list too."""
    boxes = durable(_screens(s, d, spoilt=True))
    return frames.frame_fits(boxes, frames.ranks_before(boxes, _captures(boxes)))


def banner_close(s: SparkSession, d: str) -> DataFrame:
    """Where the banner of a frame is closed."""
    return frames.banner_close(_screens(s, d, spoilt=True)).select("frame", "seq", "x", "y")


def banner_frames(s: SparkSession, d: str) -> DataFrame:
    """Frames of each event that a banner covers in part, and frames in all."""
    marks = frames.banner_marks(_screens(s, d, spoilt=True)).withColumn("event_id", F.substring_index("frame", ":", 1))
    return marks.groupBy("event_id").agg(F.count("*").alias("n_frames"), F.count(F.when(F.col("banner_detected"), 1)).alias("n_banner_frames"), F.count(F.when(F.col("is_list"), 1)).alias("n_lists"))


def list_top(s: SparkSession, d: str) -> DataFrame:
    """Frames that show the top of the list."""
    boxes = _screens(s, d)
    return frames.at_top(boxes, frames.parse_frames(boxes))


def frame_parse_v1(s: SparkSession, d: str) -> DataFrame:
    """The board read back from its screens by the first version's rules."""
    parsed = legacy.parse_frames_v1(_screens(s, d))
    return parsed.select("frame", "rank", "commander", "alliance", "points", F.round("score", 6).alias("score"))


def early_parse(s: SparkSession, d: str) -> DataFrame:
    """The list of each event read from screens of another size: fitted, parsed and voted in one go."""
    return early.parse_early(_moved(_screens(s, d)), _captures(_screens(s, d)).select("frame", F.col("capture_id").alias("event_id"), "frame_no")).drop("n_obs", "n_clean")


def _moved(screens: DataFrame) -> DataFrame:
    """Screens with a header, scaled and moved."""
    heads = screens.select("frame").distinct().select("frame", F.explode(F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(t).alias("text"), F.lit(x - 0.04).alias("x"), F.lit((frames.TITLE_Y if t == "RANKINGS" else frames.COLUMN_Y) - 0.01).alias("y")) for i, (t, x) in enumerate(frames.HEADER_X.items())])).alias("h")).select("frame", "h.*", F.lit(0.08).alias("width"), F.lit(0.02).alias("height"))
    return screens.unionByName(heads).select("frame", "seq", "text", (0.08 + 0.83 * F.col("x")).alias("x"), (0.13 + 0.70 * F.col("y")).alias("y"), (0.83 * F.col("width")).alias("width"), (0.70 * F.col("height")).alias("height"))


def event_labels(s: SparkSession, d: str) -> DataFrame:
    """Ids, script names and roles of the servers of published events.  For some events another opponent is given than
    detected, and forced; for others none is given.
    """
    rows = manifest(s, d).withColumn("server", F.explode(F.array("home_server", "opponent_server", F.lit("9999"))))
    made = publish.event_id(F.col("event_date"), F.col("home_server"), F.col("opponent_server"))
    role = publish.role_label(F.col("server"), F.col("home_server"), F.col("opponent_server"), F.col("home_role"))
    case = F.pmod("total_points", F.lit(3))
    given = F.when(case == 0, "9999").when(case == 1, F.col("opponent_server"))
    sure = publish.resolve_matchup(given, F.col("opponent_server"), case == 0)
    return rows.select("event_id", "server", made.alias("made_id"), publish.script_name(made).alias("script_name"), role.alias("role"), sure.alias("opponent"))


def affine_fit(s: SparkSession, d: str) -> DataFrame:
    """Screens of another size brought back: the board's screens with a header, scaled and moved."""
    return frames.fit_screen(_moved(_screens(s, d))).where("seq >= 10").select("frame", "seq", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def screen_matchup(s: SparkSession, d: str) -> DataFrame:
    """The sides of every published event read from a drawn matchup screen, each from its home server."""
    rows = manifest(s, d).where("home_role is not null")
    box = lambda k, text, x, y: F.struct(F.lit(k).alias("seq"), text.alias("text"), F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(0.1).alias("width"), F.lit(0.02).alias("height"))
    role = lambda yes: F.when(F.col("home_role") == "defending", yes).otherwise("Invader" if yes == "Defender" else "Defender")
    parts = F.array(box(1, role("Defender"), 0.2, 0.8), box(2, F.concat(F.lit("S"), "home_server"), 0.2, 0.7), box(3, role("Invader"), 0.7, 0.8), box(4, F.concat(F.lit("S "), "opponent_server"), 0.7, 0.7), box(5, F.lit("Victory"), 0.2, 0.75), box(6, F.lit("Battle  Over"), 0.45, 0.4))
    drawn = rows.select(F.col("event_id").alias("frame"), F.explode(parts).alias("b")).select("frame", "b.*")
    return frames.screen_matchup(drawn, rows.select(F.col("event_id").alias("frame"), F.col("home_server").alias("home")))


QUERIES = {
    f.__name__: f
    for f in (
        event_trend_delta, rank_movement, player_profiles, did_not_place, alias_identity, tier_sums, tier_difference, score_brackets, same_side_delta, top_alliances_per_server, qualifying_alliances, active_players,
        search_page, first_seen_per_frame, terminal_stall, bottom_stop, latest_centre, nearest_slot_join, region_filter, frame_parse, frame_fits, banner_close, banner_frames, list_top, frame_parse_v1, early_parse, event_labels, affine_fit, screen_matchup,
    )
}

_P = "coalesce(points, 0)"
_NAMED = "named AS (SELECT event_id, server, commander, min(rank) AS rank, arg_min(struct_pack(p := points), rank).p AS points FROM board WHERE commander <> '' AND server IS NOT NULL GROUP BY ALL)"
_TIER = f"""ranked AS (SELECT event_id, server, points, row_number() OVER (PARTITION BY event_id, server ORDER BY pos) AS k FROM board WHERE server IS NOT NULL),
tiers AS (SELECT event_id, server, CASE WHEN k <= 10 THEN '1-10' WHEN k <= 50 THEN '11-50' WHEN k <= 100 THEN '51-100' ELSE '101+' END AS tier, count(*) AS players, sum({_P})::BIGINT AS points FROM ranked GROUP BY ALL)"""
_STANDINGS = f"""dom AS (
  SELECT event_id, alliance, server FROM (SELECT event_id, alliance, server, count(*) AS n, min(pos) AS p FROM board GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY event_id, alliance ORDER BY n DESC, p) = 1
), st AS (SELECT r.*, dom.server, row_number() OVER (PARTITION BY r.event_id, dom.server ORDER BY total_points DESC, first_pos) AS server_rank
  FROM (SELECT event_id, alliance, sum({_P})::BIGINT AS total_points, min(pos) AS first_pos FROM board GROUP BY ALL) r JOIN dom ON r.event_id = dom.event_id AND r.alliance IS NOT DISTINCT FROM dom.alliance)"""
_LINES = "list_filter([trim(nullif(commander, ''), ' '), trim(nullif(alliance, ''), ' '), 'S' || nullif(server, '')], lambda x: x IS NOT NULL)"
_SCREEN = f"""{BOARD_SQL}, drawn AS (SELECT *, event_id || ':' || f AS frame, {_TOP} - k * {frames.PITCH} AS yy, {_LINES} AS lines FROM (SELECT *, (rank - 1) // {_PER} AS f, (rank - 1) % {_PER} AS k FROM board))"""
# Every seventh frame has no digits: its rows with points follow the last rank of the frame before.
_SHOWN = f"""{_SCREEN}, shown AS (SELECT *, CASE WHEN f % 7 = 3 THEN {_PER} * f + 1 + k - min(k) OVER (PARTITION BY frame) ELSE rank END::INTEGER AS n FROM drawn WHERE f % 7 <> 3 OR points IS NOT NULL)"""

ORACLE = {
    "event_trend_delta": f"""WITH {BOARD_SQL}, {MANIFEST_SQL}, t AS (SELECT event_id, server, count(*) AS players, sum({_P})::BIGINT AS points FROM board WHERE server IS NOT NULL GROUP BY ALL)
      SELECT t.event_id, server, points, players - lag(players) OVER w AS players_change, points - lag(points) OVER w AS points_change FROM t JOIN manifest m ON t.event_id = m.event_id WINDOW w AS (PARTITION BY server ORDER BY event_date, t.event_id)""",
    "rank_movement": f"""WITH {BOARD_SQL}, {_NAMED} SELECT event_id, server, commander, rank, lag(rank) OVER w AS rank_before,
      CASE WHEN lag(rank) OVER w IS NULL THEN 'New' WHEN rank < lag(rank) OVER w THEN 'Up' WHEN rank > lag(rank) OVER w THEN 'Down' ELSE 'None' END AS movement FROM named WINDOW w AS (PARTITION BY server, commander ORDER BY event_id)""",
    "player_profiles": f"WITH {BOARD_SQL}, {_NAMED} SELECT server, commander, count(DISTINCT event_id) AS events_played, min(rank) AS best_rank, sum({_P})::BIGINT AS total_points, max(event_id) AS last_event FROM named GROUP BY ALL",
    "did_not_place": f"""WITH {BOARD_SQL}, {MANIFEST_SQL}, {_NAMED}, e AS (SELECT DISTINCT event_id, unnest([home_server, opponent_server]) AS server FROM manifest), k AS (SELECT server, commander, min(event_id) AS f FROM named GROUP BY ALL)
      SELECT k.server, k.commander, e.event_id FROM k JOIN e ON k.server = e.server AND e.event_id > f WHERE NOT EXISTS (SELECT 1 FROM named n WHERE n.server = k.server AND n.commander = k.commander AND n.event_id = e.event_id)""",
    "alias_identity": f"""WITH {BOARD_SQL}, {_NAMED}, a AS (SELECT server || '|' || lower(commander) AS later, min(server || '|' || commander) AS earlier FROM named GROUP BY ALL)
      SELECT coalesce(earlier, server || '|' || commander) AS identity, count(*) AS n, sum({_P})::BIGINT AS points FROM named LEFT JOIN a ON server || '|' || commander = later GROUP BY 1""",
    "tier_sums": f"WITH {BOARD_SQL}, {_TIER} SELECT * FROM tiers",
    "tier_difference": f"""WITH {BOARD_SQL}, {MANIFEST_SQL}, {_TIER} SELECT t.event_id, tier, (sum(CASE WHEN server = home_server THEN points ELSE 0 END) - sum(CASE WHEN server = opponent_server THEN points ELSE 0 END))::BIGINT AS difference
      FROM tiers t JOIN manifest m ON t.event_id = m.event_id GROUP BY ALL""",
    "score_brackets": f"WITH {BOARD_SQL} SELECT event_id, server, CASE WHEN points >= 5000000 THEN 5000000 WHEN points >= 4000000 THEN 4000000 WHEN points >= 3000000 THEN 3000000 WHEN points >= 2000000 THEN 2000000 WHEN points >= 1000000 THEN 1000000 ELSE 0 END AS bracket, count(*) AS players FROM board WHERE points IS NOT NULL GROUP BY ALL",
    "same_side_delta": f"""WITH {MANIFEST_SQL} SELECT event_id, home_role, total_points, total_points - lag(total_points) OVER w AS total_points_change, total_players - lag(total_players) OVER w AS total_players_change
      FROM manifest WHERE home_role IS NOT NULL WINDOW w AS (PARTITION BY home_server, home_role ORDER BY event_date, event_id)""",
    "top_alliances_per_server": f"WITH {BOARD_SQL}, {_STANDINGS} SELECT event_id, server, alliance, total_points, server_rank FROM st WHERE server_rank <= 10",
    "qualifying_alliances": f"WITH {BOARD_SQL}, {_STANDINGS} SELECT event_id, alliance, total_points FROM st WHERE total_points >= 1000000 AND alliance <> 'No Alliance' AND alliance <> ''",
    "active_players": f"WITH {BOARD_SQL} SELECT event_id, count(*) AS n FROM board WHERE points >= 50000 GROUP BY event_id",
    "search_page": f"WITH {BOARD_SQL} SELECT event_id, rank, commander, alliance FROM board WHERE contains(lower(commander), 'iron') OR contains(lower(alliance), 'iron') ORDER BY event_id, rank LIMIT 20 OFFSET 20",
    "first_seen_per_frame": f"WITH {_CAPTURE}, {_NEWS} SELECT * FROM news",
    "terminal_stall": f"""WITH {_CAPTURE}, {_NEWS} SELECT capture_id, frame_no, n_new FROM (SELECT *, max(frame_no) FILTER (n_new > 0) OVER (PARTITION BY capture_id) AS l, row_number() OVER (PARTITION BY capture_id ORDER BY frame_no DESC) AS k FROM news)
      WHERE frame_no <= coalesce(l, -1) OR k <= 2""",
    "latest_centre": f"WITH {_CAPTURE}, c AS (SELECT capture_id, frame_no, (min(rank) + max(rank)) / 2 AS centre FROM capture WHERE complete GROUP BY ALL) SELECT capture_id, arg_max(centre, frame_no) AS centre FROM c GROUP BY ALL",
    "bottom_stop": f"""WITH {_CAPTURE}, f AS (SELECT capture_id, frame_no, max(rank) AS m, list_sort(list(DISTINCT rank)) AS p FROM capture GROUP BY ALL),
      g AS (SELECT *, max(m) OVER w AS top, p IS NOT DISTINCT FROM lag(p) OVER (PARTITION BY capture_id ORDER BY frame_no) AS same FROM f WINDOW w AS (PARTITION BY capture_id ORDER BY frame_no)),
      h AS (SELECT *, coalesce(top > lag(top) OVER (PARTITION BY capture_id ORDER BY frame_no), true) AS grew FROM g),
      i AS (SELECT *, frame_no - max(CASE WHEN grew THEN frame_no END) OVER (PARTITION BY capture_id ORDER BY frame_no) AS stalled, frame_no - max(CASE WHEN NOT same THEN frame_no END) OVER (PARTITION BY capture_id ORDER BY frame_no) AS alike FROM h)
      SELECT capture_id, min(frame_no) FILTER (top > 50 AND (stalled >= 4 OR alike >= 5)) AS stop_frame FROM i GROUP BY capture_id""",
    "nearest_slot_join": """WITH p AS (SELECT event_id, value AS y FROM events WHERE value IS NOT NULL), s AS (SELECT unnest(range(0, 9)) AS slot)
      SELECT event_id, arg_min(slot, struct_pack(d := abs(y - slot * 25.0), s := -slot)) AS slot, round(min(abs(y - slot * 25.0)), 6) AS distance FROM p, s WHERE abs(y - slot * 25.0) <= 10 GROUP BY event_id""",
    "region_filter": """WITH b AS (SELECT user_id::VARCHAR AS frame, event_id AS seq, event_type AS text, (event_id % 100) / 100.0 AS cx, 1 - (floor(value) % 100) / 100.0 AS cy FROM events)
      SELECT frame, min(seq) AS seq, arg_min(text, seq) AS text FROM b WHERE regexp_matches(text, '^(click|purchase|view)', 'i') AND cx BETWEEN 0.2 AND 0.8 AND cy BETWEEN 0.1 AND 0.9 GROUP BY frame""",
    "frame_parse": rf"""WITH {_SHOWN}, parts AS (SELECT *, coalesce(lines[1], '') AS one, lines[2:] AS rest, k = 0 AS edge FROM shown),
      found AS (SELECT *, list_position(list_transform(rest, lambda x: regexp_full_match(x, 'S\d{{2,4}}')), true) AS hit FROM parts),
      told AS (SELECT *, array_to_string(list_filter(rest, lambda x, i: hit IS NULL OR hit = 0 OR i <> hit), ' ') AS two, CASE WHEN hit > 0 THEN rest[hit][2:] END AS sv FROM found),
      marked AS (SELECT *, starts_with(one, '[') AND two = '' AS tag_only FROM told)
      SELECT frame, n AS rank, CASE WHEN tag_only AND NOT edge THEN '' ELSE one END AS commander, CASE WHEN tag_only AND NOT edge THEN one ELSE two END AS alliance, sv AS server, points,
        (one <> '' OR tag_only AND NOT edge) AND points IS NOT NULL AND NOT edge AND NOT (tag_only AND edge) AS complete, f % 4 = 1 AND k = 1 AS tainted, tag_only AND NOT edge AS name_unreadable FROM marked""",
    "frame_fits": f"""WITH {_SHOWN} SELECT frame, f % 4 = 1 AS banner_detected, min(n) AS offset, count(*)::INTEGER AS n_rows FROM shown GROUP BY ALL
      UNION ALL SELECT DISTINCT event_id || ':end', false, NULL, 0 FROM board""",
    "banner_close": f"WITH {_SCREEN} SELECT DISTINCT frame, 2 AS seq, 0.9::DOUBLE AS x, 0.8::DOUBLE AS y FROM drawn WHERE f % 4 = 1",
    "banner_frames": f"WITH {_SCREEN} SELECT event_id, count(DISTINCT f) + 1 AS n_frames, count(DISTINCT f) FILTER (f % 4 = 1) AS n_banner_frames, 0 AS n_lists FROM drawn GROUP BY event_id",
    "list_top": f"WITH {_SCREEN} SELECT frame FROM drawn GROUP BY frame HAVING min(rank) = 1",
    "frame_parse_v1": f"""WITH {_SCREEN}, r AS (SELECT frame, rank, coalesce(lines[1], '') AS commander, array_to_string(lines[2:], ' ') AS alliance, points, yy::DOUBLE AS y FROM drawn),
      every AS (SELECT * FROM r UNION ALL SELECT frame, 2, '', '', NULL, (max(y) FILTER (rank = 1) + max(y) FILTER (rank = 3)) / 2 FROM r GROUP BY frame HAVING count(*) FILTER (rank = 1) > 0 AND count(*) FILTER (rank = 3) > 0 AND count(*) FILTER (rank = 2) = 0)
      SELECT frame, rank, commander, alliance, points, round(100 - 50 * abs(y - 0.45) + CASE WHEN points IS NOT NULL THEN 30 ELSE 0 END + CASE WHEN commander <> '' THEN 20 ELSE 0 END + CASE WHEN alliance <> '' THEN 10 ELSE 0 END, 6) AS score FROM every""",
    "early_parse": rf"""WITH {_SCREEN}, parts AS (SELECT *, coalesce(lines[1], '') AS one, lines[2:] AS rest, k = 0 AS edge FROM drawn),
      found AS (SELECT *, list_position(list_transform(rest, lambda x: regexp_full_match(x, 'S\d{{2,4}}')), true) AS hit FROM parts),
      told AS (SELECT *, array_to_string(list_filter(rest, lambda x, i: hit IS NULL OR hit = 0 OR i <> hit), ' ') AS two, CASE WHEN hit > 0 THEN rest[hit][2:] END AS sv FROM found),
      marked AS (SELECT *, starts_with(one, '[') AND two = '' AND NOT edge AS lost FROM told)
      SELECT event_id, rank, CASE WHEN lost THEN '(name unreadable by OCR)' ELSE one END AS commander, CASE WHEN lost THEN one ELSE two END AS alliance, sv AS server, points, false AS used_tainted, lost AS name_unreadable,
        CASE WHEN points IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS points_agreement, CASE WHEN one = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS commander_agreement, CASE WHEN two = '' AND NOT lost THEN 0.0 ELSE 1.0 END::DOUBLE AS alliance_agreement FROM marked""",
    "event_labels": f"""WITH {MANIFEST_SQL}, s AS (SELECT *, unnest([home_server, opponent_server, '9999']) AS server FROM manifest)
      SELECT event_id, server, event_date || '-s' || home_server || '-vs-s' || opponent_server AS made_id, 'EVENT_' || replace(event_date || '-s' || home_server || '-vs-s' || opponent_server, '-', '_') AS script_name,
        CASE WHEN server = home_server THEN upper(home_role[1]) || home_role[2:] WHEN server = opponent_server THEN CASE home_role WHEN 'attacking' THEN 'Defending' WHEN 'defending' THEN 'Attacking' END WHEN home_role IS NOT NULL THEN 'Cross-server' END AS role,
        CASE WHEN total_points % 3 = 0 THEN '9999' ELSE opponent_server END AS opponent FROM s""",
    "affine_fit": f"""WITH {_SCREEN}, b AS (SELECT frame, rank * 10 + v.k AS seq, x, yy + dy AS y FROM drawn, (VALUES (0, 0.1, 0.0), (1, 0.4, 0.02), (2, 0.4, 0.0), (3, 0.4, -0.02), (4, 0.8, 0.0)) v(k, x, dy)
        WHERE CASE v.k WHEN 1 THEN commander <> '' WHEN 2 THEN alliance <> '' WHEN 3 THEN server <> '' WHEN 4 THEN points IS NOT NULL ELSE true END)
      SELECT frame, seq, round(x::DOUBLE, 6) AS x, round(y::DOUBLE, 6) AS y FROM b""",
    "screen_matchup": f"WITH {MANIFEST_SQL} SELECT event_id AS frame, home_role, opponent_server AS opponent, true AS battle_over, 'victory' AS home_result FROM manifest WHERE home_role IS NOT NULL AND opponent_server <> home_server",
}
