"""Questions across events: trends, movements, profiles, tiers.  Thresholds and edges are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(events: DataFrame, fields: list[str], group: list[str], order: list[str]) -> DataFrame:
    """Each row with ``<field>_before`` and ``<field>_change`` against the row before it in its group; null for the first."""
    per = Window.partitionBy(*group).orderBy(*order)
    out = events
    for f in fields:
        out = out.withColumn(f"{f}_before", F.lag(f).over(per))
    for f in fields:
        out = out.withColumn(f"{f}_change", F.col(f) - F.col(f"{f}_before"))
    return out


def movement(players: DataFrame, identity: list[str], order: str) -> DataFrame:
    """Each appearance with the rank at the one before and ``Up``, ``Down``, ``None`` or ``New``."""
    per = Window.partitionBy(*identity).orderBy(order)
    rows = players.withColumn("rank_before", F.lag("rank").over(per))
    move = F.when(F.col("rank_before").isNull(), "New").when(F.col("rank") < F.col("rank_before"), "Up").when(F.col("rank") > F.col("rank_before"), "Down").otherwise("None")
    return rows.withColumn("movement", move)


def profiles(players: DataFrame, identity: list[str]) -> DataFrame:
    """Events played, best rank, points and last event of each identity."""
    return players.groupBy(*identity).agg(F.countDistinct("event_id").alias("events_played"), F.min("rank").alias("best_rank"), F.sum(F.coalesce("points", F.lit(0))).alias("total_points"), F.max("event_id").alias("last_event"))


def did_not_place(players: DataFrame, events: DataFrame, identity: list[str], server: str = "server") -> DataFrame:
    """Events of its server in which a known identity did not place, after its first appearance."""
    known = players.where(F.col(server).isNotNull()).groupBy(*identity).agg(F.min("event_id").alias("_first"))
    due = known.join(events.select("event_id", server).distinct(), server).where(F.col("event_id") > F.col("_first"))
    placed = players.select(*identity, "event_id").distinct()
    return due.join(placed, [*identity, "event_id"], "left_anti").select(*identity, "event_id")


def aliased(players: DataFrame, aliases: DataFrame, server: str, key: str) -> DataFrame:
    """Players whose identity (server, key) is replaced by the earlier one that ``aliases`` (later, earlier) names."""
    fixes = aliases.where("later is not null").groupBy("later").agg(F.min("earlier").alias("earlier"))
    own = F.concat_ws("|", server, key)
    joined = players.withColumn("_own", own).join(fixes, F.col("_own") == F.col("later"), "left")
    return joined.withColumn("identity", F.coalesce("earlier", "_own")).drop("_own", "later", "earlier")


def tiers(players: DataFrame, edges: list[int], by: str = "server_rank") -> DataFrame:
    """``event_id, server, tier, players, points``: sums over classes of ranks; ``edges`` are the last ranks of each."""
    tier = F.when(F.col(by) <= edges[0], F.lit(f"1-{edges[0]}"))
    for low, high in zip(edges, edges[1:]):
        tier = tier.when(F.col(by) <= high, F.lit(f"{low + 1}-{high}"))
    return players.withColumn("tier", tier.otherwise(F.lit(f"{edges[-1] + 1}+"))).groupBy("event_id", "server", "tier").agg(F.count("*").alias("players"), F.sum(F.coalesce("points", F.lit(0))).alias("points"))


def tier_difference(of_tiers: DataFrame, events: DataFrame) -> DataFrame:
    """Home points less the opponent's in each tier of an event; a side without the tier counts 0."""
    sides = of_tiers.join(events.select("event_id", "home_server", "opponent_server"), "event_id")
    home = F.sum(F.when(F.col("server") == F.col("home_server"), F.col("points")).otherwise(0))
    away = F.sum(F.when(F.col("server") == F.col("opponent_server"), F.col("points")).otherwise(0))
    return sides.groupBy("event_id", "tier").agg((home - away).alias("difference"))


def brackets(players: DataFrame, edges: list[int]) -> DataFrame:
    """``event_id, server, bracket, players``: players by the greatest edge their points reach, 0 below the first."""
    bracket: Column = F.lit(0)
    for e in sorted(edges):
        bracket = F.when(F.col("points") >= e, F.lit(e)).otherwise(bracket)
    return players.where("points is not null").withColumn("bracket", bracket).groupBy("event_id", "server", "bracket").agg(F.count("*").alias("players"))


def same_side(events: DataFrame, fields: list[str], group: str = "home_server", role: str = "home_role", order: str = "event_date") -> DataFrame:
    """Change against the last event in which the server stood on the same side."""
    return with_previous(events.where(F.col(role).isNotNull()), fields, [group, role], [order, "event_id"])


def page(rows: DataFrame, order: list, size: int, number: int) -> DataFrame:
    """The ``number``-th page (from 0) of ``size`` rows: a top-k of Spark, no global sort of the rest."""
    return rows.orderBy(*order).limit(size * (number + 1)).offset(size * number)


def search(rows: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Rows of which a column contains ``text``, without regard to case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(c).contains(text.lower()), F.lit(False))
    return rows.where(hit)


def roster_change(players: DataFrame, identity: list[str], order: str = "event_id") -> DataFrame:
    """Each appearance with its place in the alliance (by points, earlier rank first on ties), that at the appearance before
    in the same alliance, and the change upwards; null for the first.
    """
    place = F.row_number().over(Window.partitionBy(order, "alliance").orderBy(F.coalesce("points", F.lit(0)).desc(), "rank"))
    rows = players.withColumn("place", place)
    before = F.lag("place").over(Window.partitionBy(*identity, "alliance").orderBy(order))
    return rows.withColumn("place_before", before).withColumn("places_up", F.col("place_before") - F.col("place"))


def side_shares(players: DataFrame) -> DataFrame:
    """``event_id, server, players, points, points_share, roster_share, avg_points, top_alliance``: shares in percent of the
    event, two decimals; a null server is a group of its own.
    """
    per = ["event_id", "server"]
    by_alliance = players.groupBy(*per, "alliance").agg(F.count("*").alias("n"), F.sum(F.coalesce("points", F.lit(0))).alias("s"), F.min("pos").alias("p"))
    best = F.min(F.struct((-F.col("s")).alias("m"), "p", F.col("alliance").alias("v")))
    sides = by_alliance.groupBy(*per).agg(F.sum("n").alias("players"), F.sum("s").alias("points"), best.alias("b"))
    event = Window.partitionBy("event_id")
    share = lambda c: F.when(F.sum(c).over(event) > 0, F.bround(F.col(c) / F.sum(c).over(event) * 100, 2)).otherwise(F.lit(0.0))
    return sides.select(*per, "players", "points", share("points").alias("points_share"), share("players").alias("roster_share"), F.expr("points div players").alias("avg_points"), F.col("b.v").alias("top_alliance"))


def group_profiles(players: DataFrame, identity: list[str]) -> DataFrame:
    """Events, members, points, best event and last event of each group of players, e.g. an alliance."""
    per_event = players.groupBy(*identity, "event_id").agg(F.count("*").alias("n"), F.sum(F.coalesce("points", F.lit(0))).alias("s"))
    best = F.max(F.struct("s", "event_id"))
    out = per_event.groupBy(*identity).agg(F.count("*").alias("events_played"), F.max("n").alias("most_members"), F.sum("s").alias("total_points"), best.alias("b"), F.max("event_id").alias("last_event"))
    return out.select(*identity, "events_played", "most_members", "total_points", F.col("b.event_id").alias("best_event"), F.col("b.s").alias("best_points"), "last_event")


def side_averages(events: DataFrame, fields: list[str], group: str = "home_server", role: str = "home_role") -> DataFrame:
    """``group, role, n_events`` and the mean of each field over the events in which the group stood on that side."""
    return events.where(F.col(role).isNotNull()).groupBy(group, role).agg(F.count("*").alias("n_events"), *[F.round(F.avg(f), 2).alias(f"avg_{f}") for f in fields])


def trend_table(totals: DataFrame, servers: list[str], value: str = "points") -> DataFrame:
    """One row of each event with a column for each of ``servers``."""
    return totals.groupBy("event_id").pivot("server", servers).agg(F.sum(value))
