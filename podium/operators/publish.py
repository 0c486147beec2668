"""Registries, snapshots and what follows from publishing a list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.operators.rollup import alliance_standings, event_totals, server_totals


def upsert(registry: DataFrame, updates: DataFrame, key: str, pos: str = "pos", front: bool = True) -> DataFrame:
    """``registry`` with ``updates``: a known key keeps its place and gets the new row, a new key comes first (or last).

    Both have ``pos``; of several updates of a key that with the greatest pos
    counts.  Rows with a null key are appended as they are.
    """
    latest = updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*[c for c in updates.columns if c != key]), pos).alias("_u"))
    fields = [c for c in registry.columns if c not in (key, pos)]
    old = registry.select(key, F.col(pos).alias("_pos"))
    first = F.broadcast(registry.agg(F.least(F.coalesce(F.min(pos), F.lit(0)), F.lit(0)).alias("_first")))  # one row
    joined = latest.join(old, key, "left").crossJoin(first)
    new_pos = F.coalesce("_pos", (F.col("_first") - F.lit(1) - F.col(f"_u.{pos}")) if front else F.col(f"_u.{pos}") + F.lit(1 << 40))
    fresh = joined.select(key, *[F.col(f"_u.{f}").alias(f) for f in fields], new_pos.cast("bigint").alias(pos))
    kept = registry.join(latest.select(key), key, "left_anti").select(key, *fields, F.col(pos).cast("bigint").alias(pos))
    nameless = updates.where(F.col(key).isNull()).select(key, *fields, F.col(pos).cast("bigint").alias(pos))
    return kept.unionByName(fresh).unionByName(nameless)


def latest_wins(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """One row per key with the latest content at the first place; rows with a null key all stay."""
    fields = [c for c in rows.columns if c not in (key, pos)]
    merged = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*fields), pos).alias("_r"), F.min(pos).alias(pos))
    return merged.select(key, *[F.col(f"_r.{f}").alias(f) for f in fields], pos).unionByName(rows.where(F.col(key).isNull()).select(key, *fields, pos))


def is_latest(registry: DataFrame, date: str = "event_date") -> DataFrame:
    """Each entry and whether no published one is of a later date: only such may move the pointer to the latest."""
    last = registry.agg(F.max(date).alias("_last"))
    return registry.join(F.broadcast(last), F.col(date) == F.col("_last"), "left").withColumn("is_latest", F.col("_last").isNotNull()).drop("_last")


def scan_id(given, finished_at, started_at):
    """The id of a scan: as given, else the digits of when it ended or began, with a T between date and time, else of now in UTC with a Z."""
    stamp = F.coalesce(finished_at, started_at)
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'")
    return F.coalesce(F.nullif(given, F.lit("")), F.date_format(stamp, "yyyyMMdd'T'HHmmss"), now)


def scan_index(rankings: DataFrame) -> DataFrame:
    """One row per scan of an event: kind, times, players, points, alliances and leaders."""
    best = F.max(F.struct(F.coalesce("points", F.lit(-1)).alias("p"), (-F.col("rank")).alias("r"), F.col("commander").alias("v")))
    scans = rankings.groupBy("event_id", "scan_id", "scan_kind").agg(
        F.min("captured_at").alias("started_at"), F.max("captured_at").alias("finished_at"), F.count("*").alias("total_players"), F.sum(F.coalesce("points", F.lit(0))).alias("total_points"),
        F.countDistinct("alliance").alias("unique_alliances"), best.alias("_b"),
    )
    return scans.withColumn("top_commander", F.col("_b.v")).drop("_b")


def allow_list(standings: DataFrame, home: str, least_points) -> DataFrame:
    """``event_id, tag, total_points``: tags of home alliances with at least ``least_points``, each once, best first."""
    fit = standings.where((F.col("server") == home) & F.col("tag").isNotNull() & (F.col("tag") != "") & (F.col("total_points") >= least_points))
    best = fit.groupBy("event_id", F.lower("tag").alias("_k")).agg(F.min(F.struct("rank", "tag", "total_points")).alias("b"))
    return best.select("event_id", F.col("b.tag").alias("tag"), F.col("b.total_points").alias("total_points"))


def list_difference(wanted: DataFrame, held: DataFrame, tag: str = "tag", group: str = "event_id") -> DataFrame:
    """``group, tag, action``: what to add to and remove from ``held`` to have ``wanted``, without regard to case."""
    left, right = (df.where(F.col(tag).isNotNull()).withColumn("_k", F.lower(tag)) for df in (wanted, held))
    add = left.join(right.select(group, "_k").distinct(), [group, "_k"], "left_anti").select(group, tag, F.lit("add").alias("action"))
    drop = right.join(left.select(group, "_k").distinct(), [group, "_k"], "left_anti").select(group, tag, F.lit("remove").alias("action"))
    return add.unionByName(drop).distinct()


def threshold(live, stored, fallback: float = 1.0):
    """The first positive of a live setting, a stored one and ``fallback``."""
    return F.coalesce(F.when(live > 0, live), F.when(stored > 0, stored), F.lit(fallback))


def content_version(content):
    """The first ten characters of the content's SHA-1, as a version."""
    return F.substring(F.sha1(content), 1, 10)


def previous_of(rows: DataFrame, group: list[str], order: str, fields: list[str]) -> DataFrame:
    """``rows`` with ``previous_<field>`` from the row before it in its group."""
    per = Window.partitionBy(*group).orderBy(order)
    return rows.select("*", *[F.lag(f).over(per).alias(f"previous_{f}") for f in fields])


def event_id(date, home, opponent):
    """The id of an event: date, home and opponent."""
    return F.concat(date.cast("string"), F.lit("-s"), home, F.lit("-vs-s"), opponent)


def script_name(event):
    """The variable that holds an event's data in a script bundle."""
    return F.concat(F.lit("EVENT_"), F.translate(event, "-", "_"))


def role_label(server, home, opponent, home_role):
    """What a server did in an event, in words; null if the home role is not known."""
    other = F.when(home_role == "attacking", "defending").when(home_role == "defending", "attacking")
    return F.when(server == home, F.initcap(home_role)).when(server == opponent, F.initcap(other)).otherwise(F.when(home_role.isNotNull(), F.lit("Cross-server")))


def resolve_matchup(given, detected, forced=None):
    """The given value, else the detected one; an error if both are missing, or differ without ``forced``."""
    force = F.lit(False) if forced is None else F.coalesce(forced, F.lit(False))
    chosen = F.coalesce(given, detected)
    missing = F.when(chosen.isNull(), F.raise_error(F.lit("the matchup is not known")).cast("string"))
    conflict = F.when((given != detected) & ~force, F.raise_error(F.concat(F.lit("given and detected matchup differ: "), given, F.lit(", "), detected)).cast("string"))
    return F.coalesce(missing, conflict, chosen)


def messages(keys, texts):
    """A translation table from its keys and one language's texts in the same order; lengths must agree."""
    return F.when(F.size(keys) != F.size(texts), F.raise_error(F.lit("as many texts as keys are needed")).cast("map<string,string>")).otherwise(F.map_from_arrays(keys, texts))


def stamped(page, name, version):
    """``page`` with the version of every script called ``name`` replaced: ``name?v=...``, put in where there is none."""
    quoted = F.regexp_replace(name, r"([\\.^$|?*+()\[\]{}])", r"\\$1")
    return F.regexp_replace(page, F.concat(F.lit("("), quoted, F.lit(r")(\?v=[0-9A-Za-z]*)?(?=[\"'])")), F.concat(F.lit("$1?v="), version))


def event_documents(meta: DataFrame, players: DataFrame) -> DataFrame:
    """``meta`` with totals, leaders and ``servers``: a map from server to its labelled name, players, points and share."""
    totals = server_totals(players)
    named = totals.join(meta.select("event_id", "home_server", "opponent_server", "home_role"), "event_id")
    code = F.coalesce("server", F.lit("home"))
    label = F.concat(F.lit("Server "), code, F.lit(" ("), F.coalesce(role_label(F.col("server"), F.col("home_server"), F.col("opponent_server"), F.col("home_role")), F.lit("Cross-server")), F.lit(")"))
    entry = F.struct(code.alias("key"), F.struct(label.alias("name"), "players", "points", "point_share_pct").alias("value"))
    maps = named.groupBy("event_id").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("servers"))
    first = players.groupBy("event_id").agg(F.min_by("commander", "pos").alias("top_commander"))
    best = alliance_standings(players).where("rank = 1").select("event_id", F.col("alliance").alias("top_alliance"))
    kept = [c for c in ("event_id", "title", "event_date", "home_server", "opponent_server", "home_role") if c in meta.columns]
    return meta.select(*kept).join(event_totals(players), "event_id").join(maps, "event_id", "left").join(best, "event_id", "left").join(first, "event_id", "left")
