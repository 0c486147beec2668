"""Queries that write what is published and read it back, and those that run as streams."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.text import LABEL_FIXES
from podium.operators import evidence, history, legacy, publish, quality, rollup, vote
from podium.plans import sqltext as q
from podium.plans.boards import BOARD_SQL, MANIFEST_SQL, READINGS_SQL, board, manifest, readings
from podium.plans.event_queries import _CAPTURE, _ID, _capture, _named, _sides
from podium.plans.event_queries import ORACLE as _EVENTS
from podium.plans.list_queries import _MERGED
from podium.plans.list_queries import ORACLE as _LISTS
from podium.session import durable, scratch, table
from podium.sources import readers, sinks
from podium.streaming import capture


def _published(s: SparkSession, d: str) -> str:
    """A folder to which every event is published; the first half of the events before, so the registry is updated."""
    root, meta, players = scratch(s, "published"), manifest(s, d), board(s, d)
    early = F.col("event_id") < "2027-03"
    sinks.publish(meta.where(early), players.where(early), root)
    sinks.publish(meta, players, root)
    return root


def published_players(s: SparkSession, d: str) -> DataFrame:
    return readers.players(s, f"{_published(s, d)}/rankings/*").select("event_id", "rank", "commander", "alliance", "server", "points", "server_rank")


def published_standings(s: SparkSession, d: str) -> DataFrame:
    """Standings read back with how many members their lists hold and what the first has."""
    rows = readers.standings(s, f"{_published(s, d)}/alliances/*")
    return rows.select("event_id", "alliance", "tag", "name", "server", "total_points", "rank", F.size("members").alias("n_members"), F.get("members", F.lit(0))["points"].alias("first_points"), F.get("members", F.lit(0))["rank"].alias("first_rank"))


def published_events(s: SparkSession, d: str) -> DataFrame:
    """The servers of the events' documents."""
    rows = readers.event_documents(s, f"{_published(s, d)}/event/*")
    return rows.select(F.col("id").alias("event_id"), "title", "total_players", F.explode("servers").alias("server", "v")).select("event_id", "title", "total_players", "server", "v.*")


def published_bundle(s: SparkSession, d: str) -> DataFrame:
    """Standings and places of players, as the script bundle has them."""
    path = f"{_published(s, d)}/bundle/*"
    places = readers.bundle(s, path, "rankings").groupBy("event_id", "alliance").agg(F.max("server_rank").alias("last_server_rank"))
    return readers.bundle(s, path, "alliances").select("event_id", "alliance", "members_count", "top_points").join(places.withColumnRenamed("event_id", "_e").withColumnRenamed("alliance", "_a"), (F.col("event_id") == F.col("_e")) & F.col("alliance").eqNullSafe(F.col("_a"))).drop("_e", "_a")


def published_csv(s: SparkSession, d: str) -> DataFrame:
    rows = s.read.option("header", True).schema("Rank int, Server_Rank int, Commander string, Alliance string, Server string, Points bigint, event_id string").csv(f"{_published(s, d)}/rankings_csv")
    return rows.select("event_id", F.col("Rank").alias("rank"), F.col("Server_Rank").alias("server_rank"), F.col("Server").alias("server"), F.col("Points").alias("points"))


def published_registry(s: SparkSession, d: str) -> DataFrame:
    """The registry after all publications, in order, with whether an entry's version is a content hash."""
    rows = s.read.parquet(f"{_published(s, d)}/registry")
    return rows.select("event_id", "title", "total_players", "total_points", "top_alliance", "top_commander", F.length("data_version").alias("version_length"))


def published_latest(s: SparkSession, d: str) -> DataFrame:
    """The list to which the pointer to the newest event leads."""
    return s.read.parquet(f"{_published(s, d)}/latest").select("event_id", "rank", "points")


def snapshots(s: SparkSession, d: str) -> DataFrame:
    """Scans written as snapshots and read again, but for those of the first event: rows and points of each."""
    root, rows = scratch(s, "snapshots"), table(s, d, "rankings")
    sinks.write_snapshot(rows, root)
    first = rows.agg(F.min("event_id")).first()[0]
    return readers.earlier_players(s, root, first).groupBy("event_id", "scan_id").agg(F.count("*").alias("n_rows"), F.sum(F.coalesce("points", F.lit(0))).alias("points"))


def gated(s: SparkSession, d: str) -> DataFrame:
    """Where the gate lets the lists go: to the published folder only if every event passes."""
    root, staging = scratch(s, "gate"), scratch(s, "staging")
    merged = durable(vote.merge_readings(readings(s, d), ["event_id", "rank"]))
    fine = sinks.publish_gate(merged, quality.report(merged), root, staging)
    return s.read.parquet(root if fine else staging).groupBy("event_id").agg(F.count("*").alias("n"), F.first(F.lit(fine)).alias("published"))


def correction_files(s: SparkSession, d: str) -> DataFrame:
    """Corrections and registry labels written as JSON objects and read again; a missing file has none."""
    root = scratch(s, "corrections")
    entries = table(s, d, "alliance_registry").select(F.concat_ws(" ", "alliance_tag", "alliance_name").alias("before"), F.col("alliance").alias("after")).unionByName(s.createDataFrame(list(LABEL_FIXES.items()), "before string, after string"))
    once = entries.groupBy("before").agg(F.max("after").alias("after"))
    once.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("before", "after")))).alias("value")).coalesce(1).write.text(root)  # a fixed list
    return readers.json_map(s, root).unionByName(readers.json_map(s, f"{root}-missing"))


def scan_files(s: SparkSession, d: str) -> DataFrame:
    """Scan indexes written as an object or, for even events, as the array itself, and read again."""
    root = scratch(s, "scans")
    index = publish.scan_index(table(s, d, "rankings")).select("event_id", "scan_id", "scan_kind", "total_players", "total_points", "unique_alliances", "top_commander")
    each = index.groupBy("event_id").agg(F.sort_array(F.collect_list(F.struct("scan_id", "scan_kind", "event_id", "total_players", "total_points", "unique_alliances", "top_commander"))).alias("scans"), F.sum("total_players").alias("n"))
    value = F.when(F.col("n") % 2 == 0, F.to_json("scans")).otherwise(F.to_json(F.struct("event_id", "scans")))
    sinks.write_documents(each.select("event_id", value.alias("value")), root)
    return readers.scans(s, f"{root}/*").select("event_id", "scan_id", "scan_kind", "total_players", "total_points", "unique_alliances", "top_commander")


def box_files(s: SparkSession, d: str) -> DataFrame:
    """Boxes of user events written as one JSON array a file and read again."""
    root = scratch(s, "boxes")
    rows = table(s, d, "events").where("value is not null").select(F.concat(F.lit("u"), F.col("user_id") % 100).alias("frame"), F.struct("event_id", F.col("event_type").alias("text"), F.lit(1.0).alias("confidence"), F.round("value", 3).alias("x"), F.lit(0.5).alias("y"), F.lit(0.1).alias("width"), F.lit(0.02).alias("height")).alias("b"))
    each = rows.groupBy("frame").agg(F.to_json(F.transform(F.sort_array(F.collect_list("b")), lambda b: b.dropFields("event_id"))).alias("value"))
    each.write.partitionBy("frame").text(root)
    read = s.read.text(f"{root}/*", wholetext=True).select(F.from_json("value", "array<struct<text:string,x:double>>").alias("b"))
    return read.select(F.posexplode("b").alias("seq", "b")).groupBy("b.text").agg(F.count("*").alias("n"), F.round(F.sum("b.x"), 3).alias("x"))


def version_stamps(s: SparkSession, d: str) -> DataFrame:
    """A page of every event whose script gets the version of the event's title."""
    rows = manifest(s, d).withColumn("name", F.concat("event_id", F.lit("/event_data.js")))
    page = F.concat(F.lit('<script src="'), "name", F.when(F.col("total_points") % 2 == 0, "?v=0123456789").otherwise(""), F.lit('"></script>'))
    return rows.select("event_id", publish.stamped(page, F.col("name"), publish.content_version(F.col("title"))).alias("page"))


def repair_plan(s: SparkSession, d: str) -> DataFrame:
    """The order in which the doubtful ranks of each event are looked up again, from the middle of its list."""
    merged = durable(vote.merge_readings(readings(s, d), ["event_id", "rank"]))
    starts = merged.groupBy("event_id").agg((F.max("rank") / 2).alias("centre"))
    return evidence.repair_plan(quality.unresolved_ranks(merged), starts, "event_id")


def repaired_records(s: SparkSession, d: str) -> DataFrame:
    """Incremental readings repaired in two rounds: by the final scans, then by what of them was delivered again."""
    rows = readings(s, d).join(table(s, d, "rankings").select(F.col("row_id").alias("seq"), "scan_kind"), "seq")
    final = board(s, d).select(F.col("row_id").alias("seq"))
    first = rows.where("scan_kind = 'final'").join(final, "seq", "left_semi").drop("scan_kind")
    again = rows.where("scan_kind = 'final'").join(final, "seq", "left_anti").drop("scan_kind")
    merged, targets = quality.repaired(rows.where("scan_kind = 'incremental'").drop("scan_kind"), [first, again], ["event_id", "rank"])
    marked = merged.join(targets.withColumn("repaired", F.lit(True)), ["event_id", "rank"], "left")
    return marked.select("event_id", "rank", "points", "server", "n_obs", "n_clean", F.coalesce("repaired", F.lit(False)).alias("repaired"))


def bottom_stop_v1(s: SparkSession, d: str) -> DataFrame:
    shown = _capture(s, d).groupBy("capture_id", "frame_no").agg(F.max("rank").alias("max_rank"))
    return evidence.bottom_stop_v1(shown)


def legacy_labels(s: SparkSession, d: str) -> DataFrame:
    """Labels of the board, some with a server at their end, as the first version split and showed them."""
    rows = board(s, d).withColumn("_l", F.when(F.col("rank") % 7 == 0, F.concat("alliance", F.lit(" S1001"))).otherwise(F.col("alliance")))
    tag, name, shown = legacy.label_parts(F.col("_l"))
    return rows.select("row_id", tag.alias("tag"), name.alias("name"), shown.alias("alliance"))


def roster_change(s: SparkSession, d: str) -> DataFrame:
    return history.roster_change(_named(s, d), _ID).select("event_id", "server", "commander", "alliance", "place", "place_before", "places_up")


def side_shares(s: SparkSession, d: str) -> DataFrame:
    return history.side_shares(board(s, d))


def alliance_profiles(s: SparkSession, d: str) -> DataFrame:
    """Alliances by tag over all events; those without a tag by their whole label."""
    rows = board(s, d).withColumn("tag", F.coalesce(F.nullif("alliance_tag", F.lit("")), "alliance", F.lit("")))
    return history.group_profiles(rows, ["tag"])


def side_averages(s: SparkSession, d: str) -> DataFrame:
    return history.side_averages(manifest(s, d), ["total_points", "total_players"])


def trend_table(s: SparkSession, d: str) -> DataFrame:
    return history.trend_table(_sides(s, d), ["1001", "1002"]).withColumnsRenamed({"1001": "s1001", "1002": "s1002"})


def kpi_change(s: SparkSession, d: str) -> DataFrame:
    """Totals of each event and their change against the event before."""
    rows = rollup.event_totals(board(s, d)).join(manifest(s, d).select("event_id", "event_date"), "event_id").withColumn("_all", F.lit(1))
    return history.with_previous(rows, ["total_players", "total_points", "unique_alliances"], ["_all"], ["event_date", "event_id"]).drop("_all", "event_date")


def last_server(s: SparkSession, d: str) -> DataFrame:
    """Totals of alliances over all events with the server of their last row, the greatest 15."""
    rows = board(s, d).groupBy("alliance").agg(F.count("*").alias("members"), F.sum(F.coalesce("points", F.lit(0))).alias("points"), F.max_by(F.struct("server"), F.struct("event_id", "pos"))["server"].alias("server"))
    return legacy.top(rows, 15, F.desc("points"), F.asc_nulls_first("alliance"))


def _streamed(s: SparkSession, rows: DataFrame, name: str, key: str, steps: int = 3) -> DataFrame:
    """``rows`` as a stream: written in ``steps`` one after the other by ``frame_no``, each key in one file of a step, and read one file a micro-batch."""
    path = scratch(s, name)
    edges = [None, *rows.approxQuantile("frame_no", [n / steps for n in range(1, steps)], 0.05), None]
    for low, high in zip(edges, edges[1:]):
        part = rows if low is None else rows.where(F.col("frame_no") > low)
        (part if high is None else part.where(F.col("frame_no") <= high)).repartition(2, key).write.mode("append").parquet(path)
    return capture.read_frames(s, path, rows.schema, per_batch=1)


def _run(s: SparkSession, stream: DataFrame, mode: str, name: str) -> str:
    """Runs ``stream`` over what there is; the folder with its last complete table, or all it appended."""
    out = scratch(s, name)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", scratch(s, f"{name}-state")).trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", out).start().awaitTermination()
    else:
        writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).start().awaitTermination()
    return out


def stream_votes(s: SparkSession, d: str) -> DataFrame:
    """Points by running votes over the readings as they come in; equal to the vote over all of them."""
    rows = readings(s, d).select("event_id", "rank", "points", "y", "seq", F.floor(F.col("seq") / 1000).alias("frame_no"))
    votes = capture.running_votes(_streamed(s, rows, "readings", "event_id"), ["event_id", "rank"], "points")
    return capture.winners(s.read.parquet(_run(s, votes, "complete", "votes")), ["event_id", "rank"], "points")


def stream_stop(s: SparkSession, d: str) -> DataFrame:
    """The first frame of each capture at which the stream tells that the end of the list is certain."""
    rows = _capture(s, d).select("capture_id", F.col("frame_no").cast("bigint").alias("frame_no"), "rank")
    progress = s.read.parquet(_run(s, capture.running_progress(_streamed(s, rows, "frames", "capture_id")), "append", "progress"))
    return progress.groupBy("capture_id").agg(F.min(F.when(F.col("at_end"), F.col("frame_no"))).alias("stop_frame"), F.max("max_rank").alias("max_rank"))


def stream_windows(s: SparkSession, d: str) -> DataFrame:
    """Extension: events of each type by day, counted as a stream with a watermark."""
    rows = table(s, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("frame_no"))
    counts = capture.windowed_counts(_streamed(s, rows, "events", "event_type"), "ts", "event_type", "1 day")
    return s.read.parquet(_run(s, counts, "complete", "windows")).groupBy("event_type").agg(F.sum("n").alias("n"), F.countDistinct("start").alias("n_days"))


QUERIES = {
    f.__name__: f
    for f in (
        published_players, published_standings, published_events, published_bundle, published_csv, published_registry, published_latest, snapshots, gated, correction_files, scan_files, box_files, version_stamps,
        repair_plan, repaired_records, bottom_stop_v1, legacy_labels, roster_change, side_shares, alliance_profiles, side_averages, trend_table, kpi_change, last_server, stream_votes, stream_stop, stream_windows,
    )
}

_P = "coalesce(points, 0)"
_STANDINGS = _LISTS["alliance_standings"]
# The first version's labels, of the board with servers at the end of some.
_V1_TEXT = q.stripped("coalesce(l, '')")
_V1_PATTERN = rf"(?s)^\[(.*?)\]{q.SPACE}*(.*)$"


def _renamed(sql: str, suffix: str) -> str:
    """The CTEs of a merge under other names."""
    names = ["readings", "tiered", "pool", "keyed", "unsure", "spellings", "pairs", "blocks", "alike", "partners", "groups", "whole", "likened", "pv", "av", "sv", "facts", "merged"]
    return re.sub(rf"\b({'|'.join(names)})\b", rf"\g<1>{suffix}", sql)


def _merge_of(rows: str, suffix: str) -> str:
    """The merge of the readings in ``rows`` as CTEs ending in merged<suffix>."""
    return _renamed(_MERGED[len(READINGS_SQL) + 2 :].replace("FROM readings", "FROM @rows"), suffix).replace("@rows", rows)


def _targets(suffix: str, single: bool) -> str:
    one = f" UNION SELECT event_id, rank FROM merged{suffix} WHERE n_clean = 1" if single else ""
    return f"""breaks{suffix} AS (SELECT event_id, rank, r FROM (SELECT event_id, rank, points, lag(rank) OVER w AS r, lag(points) OVER w AS p FROM merged{suffix} WINDOW w AS (PARTITION BY event_id ORDER BY rank)) WHERE points > p),
    targets{suffix} AS (SELECT event_id, unnest(range(p + 1, rank)) AS rank FROM (SELECT event_id, rank, coalesce(lag(rank) OVER (PARTITION BY event_id ORDER BY rank), 0) AS p FROM merged{suffix})
      UNION SELECT event_id, rank FROM merged{suffix} WHERE n_clean = 0 OR points_agreement < 1 OR commander_agreement < 0.5 UNION SELECT event_id, rank FROM breaks{suffix} UNION SELECT event_id, r FROM breaks{suffix}{one})"""


ORACLE = {
    "published_players": f"WITH {BOARD_SQL} SELECT event_id, rank, commander, alliance, server, points, row_number() OVER (PARTITION BY event_id, server ORDER BY pos) AS server_rank FROM board",
    "published_standings": f"""WITH st AS ({_STANDINGS}) SELECT event_id, alliance, {q.label_tag('alliance')} AS tag, {q.label_name('alliance')} AS name, server, total_points, rank, members_count AS n_members, top_points AS first_points, top_rank AS first_rank FROM st""",
    "published_events": f"""WITH {BOARD_SQL}, {MANIFEST_SQL}, t AS (SELECT event_id, server, count(*) AS players, sum({_P})::BIGINT AS points FROM board GROUP BY ALL),
      named AS (SELECT t.event_id, title, sum(players) OVER (PARTITION BY t.event_id) AS total_players, coalesce(server, 'home') AS server, players, points, CASE WHEN sum(points) OVER (PARTITION BY t.event_id) > 0 THEN round_even(points / sum(points) OVER (PARTITION BY t.event_id) * 100, 2) ELSE 0.0 END AS point_share_pct,
        CASE WHEN server = home_server THEN upper(home_role[1]) || home_role[2:] WHEN server = opponent_server THEN CASE home_role WHEN 'attacking' THEN 'Defending' WHEN 'defending' THEN 'Attacking' END ELSE 'Cross-server' END AS role FROM t JOIN manifest m ON t.event_id = m.event_id)
      SELECT event_id, title, total_players, server, 'Server ' || server || ' (' || coalesce(role, 'Cross-server') || ')' AS name, players, points, point_share_pct FROM named""",
    "published_bundle": f"""WITH st AS ({_STANDINGS}), {BOARD_SQL}, r AS (SELECT event_id, alliance, row_number() OVER (PARTITION BY event_id, server ORDER BY pos) AS k FROM board)
      SELECT st.event_id, st.alliance, members_count, top_points, max(k) AS last_server_rank FROM st JOIN r ON st.event_id = r.event_id AND st.alliance IS NOT DISTINCT FROM r.alliance GROUP BY ALL""",
    "published_csv": f"WITH {BOARD_SQL} SELECT event_id, rank, row_number() OVER (PARTITION BY event_id, server ORDER BY pos) AS server_rank, 'S' || server AS server, points FROM board",
    "published_registry": f"""WITH st AS ({_STANDINGS}), {BOARD_SQL}, {MANIFEST_SQL} SELECT m.event_id, title, n AS total_players, p AS total_points, st.alliance AS top_alliance, c AS top_commander, 10 AS version_length
      FROM manifest m JOIN (SELECT event_id, count(*) AS n, sum({_P})::BIGINT AS p, arg_min(struct_pack(c := commander), pos).c AS c FROM board GROUP BY event_id) b ON m.event_id = b.event_id JOIN st ON st.event_id = m.event_id AND st.rank = 1""",
    "published_latest": f"WITH {BOARD_SQL}, {MANIFEST_SQL} SELECT event_id, rank, points FROM board WHERE event_id = (SELECT arg_max(event_id, struct_pack(d := event_date, e := event_id)) FROM manifest)",
    "snapshots": f"SELECT event_id, scan_id, count(*) AS n_rows, sum({_P})::BIGINT AS points FROM rankings WHERE event_id <> (SELECT min(event_id) FROM rankings) GROUP BY ALL",
    "gated": f"WITH RECURSIVE q AS ({_LISTS['qa_report']}) SELECT event_id, n_records AS n, (SELECT bool_and(passed) FROM q) AS published FROM q",
    "correction_files": f"SELECT before, max(after) AS after FROM (SELECT alliance_tag || ' ' || alliance_name AS before, alliance AS after FROM alliance_registry UNION ALL VALUES {', '.join('(' + q._quoted(a) + ', ' + q._quoted(b) + ')' for a, b in LABEL_FIXES.items())}) GROUP BY before",
    "scan_files": """SELECT event_id, scan_id, scan_kind, count(*) AS total_players, sum(coalesce(points, 0))::BIGINT AS total_points, count(DISTINCT alliance) AS unique_alliances,
      arg_max(struct_pack(c := commander), struct_pack(p := coalesce(points, -1), r := -rank, c := commander)).c AS top_commander FROM rankings GROUP BY ALL""",
    "box_files": "SELECT event_type AS text, count(*) AS n, round(sum(round(value, 3)), 3) AS x FROM events WHERE value IS NOT NULL GROUP BY ALL",
    "version_stamps": f"""WITH {MANIFEST_SQL} SELECT event_id, '<script src="' || event_id || '/event_data.js?v=' || substr(sha1(title), 1, 10) || '"></script>' AS page FROM manifest""",
    "repaired_records": f"""WITH RECURSIVE {READINGS_SQL}, {BOARD_SQL}, kinds AS (SELECT r.*, k.scan_kind, b.row_id IS NOT NULL AS first FROM readings r JOIN rankings k ON k.row_id = r.seq LEFT JOIN board b ON b.row_id = r.seq),
      read0 AS (SELECT * FROM kinds WHERE scan_kind = 'incremental'), {_merge_of('read0', '0')}, {_targets('0', True)},
      read1 AS (SELECT * FROM read0 UNION ALL SELECT * FROM kinds SEMI JOIN targets0 USING (event_id, rank) WHERE scan_kind = 'final' AND first), {_merge_of('read1', '1')}, {_targets('1', False)},
      read2 AS (SELECT * FROM read1 UNION ALL SELECT * FROM kinds SEMI JOIN targets1 USING (event_id, rank) WHERE scan_kind = 'final' AND NOT first), {_merge_of('read2', '2')}
      SELECT m.event_id, m.rank, points, server, n_obs, n_clean, t.rank IS NOT NULL AS repaired FROM merged2 m LEFT JOIN (SELECT event_id, rank FROM targets0 UNION SELECT event_id, rank FROM targets1) t ON m.event_id = t.event_id AND m.rank = t.rank""",
    "bottom_stop_v1": f"""WITH {_CAPTURE}, f AS (SELECT capture_id, frame_no, max(rank) AS m FROM capture GROUP BY ALL), g AS (SELECT *, max(m) OVER (PARTITION BY capture_id ORDER BY frame_no) AS top FROM f),
      h AS (SELECT *, coalesce(top = lag(top) OVER (PARTITION BY capture_id ORDER BY frame_no), false) AND top > 50 AS still FROM g),
      i AS (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY frame_no) AS k FROM h), j AS (SELECT *, k - max(CASE WHEN NOT still THEN k END) OVER (PARTITION BY capture_id ORDER BY frame_no) AS stalled FROM i)
      SELECT capture_id, min(frame_no) FILTER (stalled >= 6) AS stop_frame FROM j GROUP BY capture_id""",
    "legacy_labels": f"""WITH {BOARD_SQL}, l AS (SELECT row_id, CASE WHEN rank % 7 = 0 THEN alliance || ' S1001' ELSE alliance END AS l FROM board),
      p AS (SELECT row_id, {q.stripped(f"regexp_extract({_V1_TEXT}, '{_V1_PATTERN}', 1)")} AS tag, CASE WHEN {_V1_TEXT} = '' THEN 'No Alliance' WHEN regexp_matches({_V1_TEXT}, '{_V1_PATTERN}') THEN {q.stripped(f"regexp_extract({_V1_TEXT}, '{_V1_PATTERN}', 2)")} ELSE {_V1_TEXT} END AS whole FROM l),
      n AS (SELECT row_id, tag, {q.without_server('whole')} AS name FROM p) SELECT row_id, tag, name, CASE WHEN tag <> '' THEN {q.stripped("('[' || tag || '] ' || name)")} WHEN name <> '' THEN name ELSE 'No Alliance' END AS alliance FROM n""",
    "roster_change": f"""WITH {BOARD_SQL}, named AS (SELECT event_id, server, commander, min(rank) AS rank, arg_min(struct_pack(p := points, a := alliance), rank) AS r FROM board WHERE commander <> '' AND server IS NOT NULL GROUP BY ALL),
      placed AS (SELECT event_id, server, commander, r.a AS alliance, row_number() OVER (PARTITION BY event_id, r.a ORDER BY coalesce(r.p, 0) DESC, rank) AS place FROM named)
      SELECT *, lag(place) OVER w AS place_before, lag(place) OVER w - place AS places_up FROM placed WINDOW w AS (PARTITION BY server, commander, alliance ORDER BY event_id)""",
    "side_shares": f"""WITH {BOARD_SQL}, a AS (SELECT event_id, server, alliance, count(*) AS n, sum({_P})::BIGINT AS s, min(pos) AS p FROM board GROUP BY ALL), t AS (SELECT event_id, server, sum(n)::BIGINT AS players, sum(s)::BIGINT AS points FROM a GROUP BY ALL),
      b AS (SELECT event_id, server, alliance FROM a QUALIFY row_number() OVER (PARTITION BY event_id, server ORDER BY s DESC, p) = 1)
      SELECT t.event_id, t.server, players, points, CASE WHEN sum(points) OVER w > 0 THEN round_even(points / sum(points) OVER w * 100, 2) ELSE 0.0 END AS points_share, round_even(players / sum(players) OVER w * 100, 2) AS roster_share, points // players AS avg_points, alliance AS top_alliance
      FROM t JOIN b ON t.event_id = b.event_id AND t.server IS NOT DISTINCT FROM b.server WINDOW w AS (PARTITION BY t.event_id)""",
    "alliance_profiles": f"""WITH {BOARD_SQL}, e AS (SELECT coalesce(nullif(alliance_tag, ''), alliance, '') AS tag, event_id, count(*) AS n, sum({_P})::BIGINT AS s FROM board GROUP BY ALL)
      SELECT tag, count(*) AS events_played, max(n) AS most_members, sum(s)::BIGINT AS total_points, arg_max(event_id, struct_pack(s := s, e := event_id)) AS best_event, max(s) AS best_points, max(event_id) AS last_event FROM e GROUP BY tag""",
    "side_averages": f"WITH {MANIFEST_SQL} SELECT home_server, home_role, count(*) AS n_events, round(avg(total_points), 2) AS avg_total_points, round(avg(total_players), 2) AS avg_total_players FROM manifest WHERE home_role IS NOT NULL GROUP BY ALL",
    "trend_table": f"WITH {BOARD_SQL} SELECT event_id, sum({_P}) FILTER (server = '1001')::BIGINT AS s1001, sum({_P}) FILTER (server = '1002')::BIGINT AS s1002 FROM board WHERE server IS NOT NULL GROUP BY event_id",
    "kpi_change": f"""WITH {BOARD_SQL}, {MANIFEST_SQL}, t AS (SELECT event_id, count(*) AS total_players, sum({_P})::BIGINT AS total_points, count(DISTINCT alliance) AS unique_alliances FROM board GROUP BY event_id)
      SELECT t.*, {', '.join(f'lag(t.{c}) OVER w AS {c}_before, t.{c} - lag(t.{c}) OVER w AS {c}_change' for c in ('total_players', 'total_points', 'unique_alliances'))} FROM t JOIN manifest m ON t.event_id = m.event_id WINDOW w AS (ORDER BY event_date, t.event_id)""",
    "last_server": f"""WITH {BOARD_SQL} SELECT alliance, count(*) AS members, sum({_P})::BIGINT AS points, arg_max(struct_pack(s := server), struct_pack(e := event_id, p := pos)).s AS server FROM board GROUP BY alliance ORDER BY points DESC, alliance NULLS FIRST LIMIT 15""",
    "stream_votes": f"WITH {READINGS_SQL}, v AS (SELECT event_id, rank, points, count(*) AS n, min(struct_pack(d := abs(y - 0.45), s := seq)) AS k FROM readings WHERE points IS NOT NULL GROUP BY ALL) SELECT event_id, rank, points, n AS votes FROM v QUALIFY row_number() OVER (PARTITION BY event_id, rank ORDER BY n DESC, k) = 1",
    "stream_stop": f"WITH b AS ({_EVENTS['bottom_stop']}) SELECT b.capture_id, stop_frame, max(rank)::BIGINT AS max_rank FROM b JOIN rankings r ON r.scan_id = b.capture_id GROUP BY ALL",
    "stream_windows": "SELECT event_type, count(*) AS n, count(DISTINCT date_trunc('day', ts)) AS n_days FROM events GROUP BY ALL",
}
