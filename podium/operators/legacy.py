"""The first version's reports, which differ from today's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.text import NO_ALLIANCE, stripped, without_server


def server_in_label(label: Column, servers: list[str], home: str) -> Column:
    """The first of ``servers`` whose mark occurs in the label, else ``home``."""
    found = F.lit(home)
    for s in reversed(servers):
        found = F.when(label.contains(f"S{s}"), F.lit(s)).otherwise(found)
    return found


def server_summary(players: DataFrame, named: list[str], other: str = "other") -> DataFrame:
    """``event_id, bucket, players, points, share_pct``: the named servers and all others."""
    bucket = F.when(F.col("server").isin(*named), F.col("server")).otherwise(F.lit(other))
    totals = players.groupBy("event_id", bucket.alias("bucket")).agg(F.count("*").alias("players"), F.sum(F.coalesce("points", F.lit(0))).alias("points"))
    whole = F.sum("points").over(Window.partitionBy("event_id"))
    return totals.withColumn("share_pct", F.when(whole > 0, F.round(F.col("points") / whole * 100, 2)))


def alliance_rollup(players: DataFrame) -> DataFrame:
    """Totals of each alliance with the server of its last row."""
    return players.groupBy("event_id", "alliance").agg(F.count("*").alias("members"), F.sum(F.coalesce("points", F.lit(0))).alias("points"), F.max_by(F.coalesce("server", F.lit("")), "pos").alias("server"))


def top(rows: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows in an order."""
    return rows.orderBy(*order).limit(n)


def reading_score(y: Column, points: Column, commander: Column, alliance: Column) -> Column:
    """How good a reading of a row is: near the middle of the screen and with all fields."""
    has = lambda c, n: F.when(c.isNotNull() & (c.cast("string") != ""), n).otherwise(0)
    return F.lit(100) - 50 * F.abs(y - 0.45) + has(points, 30) + has(commander, 20) + has(alliance, 10)


def parse_frames_v1(boxes: DataFrame) -> DataFrame:
    """The first version's rows of each frame: ``frame, rank, commander, alliance, points, y, score``.

    Every number at the left is a rank (1-3000); wide boxes from the left are
    banners; rank 2 is put midway between 1 and 3 if only it is missing; points
    are the nearest within 0.045, names the boxes within 0.042 from the top.
    """
    digits = F.regexp_replace("text", "[^0-9]", "")
    seen = boxes.where(F.col("y").between(0.05, 0.865) & ~((F.col("width") > 0.45) & (F.col("x") < 0.30))).withColumn("t", F.trim("text")).withColumn("n", F.when(digits != "", digits.cast("decimal(38,0)")))
    is_rank = (F.col("x") < 0.20) & F.col("n").isNotNull()
    ranks = seen.where(is_rank & F.col("n").between(1, 3000)).select("frame", F.col("n").cast("int").alias("rank"), "y", "seq")
    at = lambda r: F.max_by(F.when(F.col("rank") == r, F.col("y")), F.when(F.col("rank") == r, F.col("seq")))
    gaps = ranks.groupBy("frame").agg(at(1).alias("y1"), at(3).alias("y3"), F.max((F.col("rank") == 2).cast("int")).alias("has2")).where("has2 = 0 and y1 is not null and y3 is not null")
    ranks = ranks.select("frame", "rank", "y").unionByName(gaps.select("frame", F.lit(2).alias("rank"), ((F.col("y1") + F.col("y3")) / 2).alias("y")))
    packed = seen.where(~is_rank).groupBy("frame").agg(
        F.collect_list(F.when((F.col("x") > 0.73) & F.col("n").isNotNull(), F.struct("seq", "y", F.col("n").cast("bigint").alias("p")))).alias("points"),
        F.sort_array(F.collect_list(F.when(F.col("x").between(0.32, 0.73), F.struct((-F.col("y")).alias("d"), "seq", "t")))).alias("middle"),
    )
    rows = ranks.join(packed, "frame", "left")
    near = F.transform(F.filter("points", lambda p: F.abs(p["y"] - F.col("y")) < 0.045), lambda p: F.struct(F.abs(p["y"] - F.col("y")).alias("d"), p["seq"], p["p"].alias("p")))
    names = F.transform(F.filter("middle", lambda m: F.abs(-m["d"] - F.col("y")) <= 0.042), lambda m: m["t"])
    rows = rows.withColumn("points", F.array_min(near)["p"]).withColumn("names", F.coalesce(names, F.array().cast("array<string>")))
    rows = rows.withColumn("commander", F.coalesce(F.get("names", F.lit(0)), F.lit(""))).withColumn("alliance", F.array_join(F.slice("names", 2, F.greatest(F.size("names"), F.lit(1))), " "))
    return rows.select("frame", "rank", "commander", "alliance", "points", "y", reading_score(F.col("y"), F.col("points"), F.col("commander"), F.col("alliance")).alias("score"))


def rankings_csv(players: DataFrame) -> DataFrame:
    """The first version's columns of the list: no rank within the server."""
    return players.select(F.col("rank").alias("Rank"), F.col("commander").alias("Commander"), F.col("alliance").alias("Alliance"), F.concat(F.lit("S"), "server").alias("Server"), F.col("points").alias("Points"))


_LABEL = r"(?Us)^\[(.*?)\]\s*(.*)$"


def label_parts(label: Column) -> tuple[Column, Column, Column]:
    """(tag, name, shown label) as the first version split labels: spaces within the tag stay, a server at the end of the
    name goes; a null or empty label has no tag and the no-alliance name.
    """
    text = stripped(F.coalesce(label, F.lit("")))
    tag = stripped(F.regexp_extract(text, _LABEL, 1))
    name = F.when(text == "", F.lit(NO_ALLIANCE)).when(text.rlike(_LABEL), stripped(F.regexp_extract(text, _LABEL, 2))).otherwise(text)
    name = without_server(name)
    shown = F.when(tag != "", stripped(F.concat(F.lit("["), tag, F.lit("] "), name))).when(name != "", name).otherwise(F.lit(NO_ALLIANCE))
    return tag, name, shown


def alliances_csv(standings: DataFrame) -> DataFrame:
    """The first version's columns of the standings: no rank within the server."""
    return standings.select(
        F.col("rank").alias("Rank"), F.col("alliance").alias("Alliance"), F.concat(F.lit("S"), "server").alias("Server"), F.col("members_count").alias("Members"), F.col("total_points").alias("Total Points"),
        F.col("avg_points").alias("Avg Points/Player"), F.col("top_commander").alias("Top Commander"), F.col("top_points").alias("Top Commander Points"),
    )
