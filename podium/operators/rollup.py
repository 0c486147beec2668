"""Standings and shares of groups of ranked players.

Players have ``event_id, pos, rank, commander, alliance, server, points``;
``pos`` is the place in the event's list and decides every tie, so results do
not depend on how rows lie in partitions.  Every aggregate is one that Spark
combines before the shuffle: top members by greatest struct, dominant servers
by counts of counts.  A group that holds a third of all players is therefore a
few rows per task by the time it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _points(column: str = "points"):
    return F.coalesce(F.col(column), F.lit(0)).cast("bigint")


def dominant(df: DataFrame, keys: list[str], value: str, pos: str = "pos") -> DataFrame:
    """The most frequent ``value`` of each group, first seen on ties; null counts as a value: ``keys, value``."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(pos).alias("_p"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_p").alias("p"), F.col(value).alias("v")))
    return counted.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.v").alias(value))


def alliance_standings(players: DataFrame) -> DataFrame:
    """Roll-up of each alliance of an event, ranked overall and within its dominant server.

    Null points count as 0; the average is the floor; ties of totals go to the
    alliance met first.  Null or empty alliances are one group each.
    """
    keys = ["event_id", "alliance"]
    top = F.max(F.struct(_points().alias("points"), (-F.col("pos")).alias("p"), "commander", "rank"))
    # One pass: totals by server first, of which the sums are the alliance's and the greatest count its server.
    by_server = players.groupBy(*keys, "server").agg(F.count("*").alias("n"), F.sum(_points()).alias("s"), top.alias("t"), F.min("pos").alias("p"))
    most = F.min(F.struct((-F.col("n")).alias("m"), "p", F.col("server").alias("v")))
    joined = by_server.groupBy(*keys).agg(F.sum("n").alias("members_count"), F.sum("s").alias("total_points"), F.max("t").alias("_t"), F.min("p").alias("first_pos"), most.alias("_d")).withColumn("server", F.col("_d.v"))
    ranked = joined.withColumn("rank", F.row_number().over(Window.partitionBy("event_id").orderBy(F.desc("total_points"), "first_pos")))
    ranked = ranked.withColumn("server_rank", F.row_number().over(Window.partitionBy("event_id", "server").orderBy("rank")))
    return ranked.select(
        "event_id", "alliance", "server", "members_count", "total_points", F.expr("total_points div members_count").alias("avg_points"),
        F.col("_t.commander").alias("top_commander"), F.col("_t.points").alias("top_points"), F.col("_t.rank").alias("top_rank"), "rank", "server_rank",
    )


def members(players: DataFrame) -> DataFrame:
    """Each player's place in the alliance, by points, the earlier in the list first on ties."""
    place = F.row_number().over(Window.partitionBy("event_id", "alliance").orderBy(F.desc(_points()), "pos"))
    return players.select("event_id", "alliance", "commander", "rank", "points", "server", place.alias("member_rank"))


def top_members(players: DataFrame, n: int) -> DataFrame:
    """The first ``n`` members of each alliance; Spark cuts each partition's groups to ``n`` before the shuffle."""
    return members(players).where(F.col("member_rank") <= n)


def with_members(standings: DataFrame, players: DataFrame) -> DataFrame:
    """``standings`` with ``members``: the list of each alliance's players as they are placed in it.

    A member list is one value of the published document of its event, so it
    is gathered here; nothing else needs it.
    """
    rows = players.groupBy("event_id", "alliance").agg(F.sort_array(F.collect_list(F.struct((-_points()).alias("m"), "pos", "rank", "commander", _points().alias("points"), "server"))).alias("_m"))
    shown = rows.select("event_id", F.col("alliance").alias("_a"), F.transform("_m", lambda x: F.struct(x["rank"].alias("rank"), x["commander"].alias("commander"), x["points"].alias("points"), x["server"].alias("server"))).alias("members"))
    return standings.join(shown.withColumnRenamed("event_id", "_e"), (F.col("event_id") == F.col("_e")) & F.col("alliance").eqNullSafe(F.col("_a")), "left").drop("_e", "_a")


def server_totals(players: DataFrame) -> DataFrame:
    """Players, points and point share (two decimals, 0 if nobody has points) of each server of an event."""
    totals = players.groupBy("event_id", "server").agg(F.count("*").alias("players"), F.sum(_points()).alias("points"))
    whole = F.sum("points").over(Window.partitionBy("event_id"))
    share = F.when(whole > 0, F.bround(F.col("points") / whole * 100, 2)).otherwise(F.lit(0.0))
    return totals.select("event_id", "server", "players", "points", share.alias("point_share_pct"))


def event_totals(players: DataFrame) -> DataFrame:
    """Players, points and distinct alliances of each event."""
    return players.groupBy("event_id").agg(F.count("*").alias("total_players"), F.sum(_points()).alias("total_points"), F.countDistinct("alliance").alias("unique_alliances"))


def server_map(players: DataFrame) -> DataFrame:
    """Per event a map from server to its name, players, points and share; a null server is 'home'."""
    totals = server_totals(players)
    entry = F.struct(F.coalesce("server", F.lit("home")).alias("key"), F.struct(F.concat(F.lit("S"), F.coalesce("server", F.lit("home"))).alias("name"), "players", "points", "point_share_pct").alias("value"))
    return totals.groupBy("event_id").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("servers"))


def player_server_rank(players: DataFrame) -> DataFrame:
    """Each player's running number within the server, in list order."""
    place = F.row_number().over(Window.partitionBy("event_id", "server").orderBy("pos"))
    return players.select("event_id", "rank", "commander", "server", "points", place.alias("server_rank"))


def share_of_alliance(players: DataFrame) -> DataFrame:
    """Each player's share of the alliance's points in percent, null where it has none."""
    total = F.sum(_points()).over(Window.partitionBy("event_id", "alliance"))
    return players.select("event_id", "rank", "commander", "alliance", F.when(total > 0, F.round(_points() / total * 100, 4)).alias("share_pct"))
