"""Checks of a ranked list: gaps, order, doubt and repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.text import UNREADABLE, name_key
from podium.operators.vote import merge_readings
from podium.session import durable


def missing_ranks(players: DataFrame, group: str = "event_id", rank: str = "rank") -> DataFrame:
    """``group, rank`` of every rank from 1 to the greatest that no row has.

    Gaps come from neighbouring distinct ranks, so what is generated is what is
    missing and no full sequence is ever built.
    """
    held = players.where(F.col(rank) >= 1).groupBy(group, rank).agg(F.lit(1).alias("_o"))
    before = F.coalesce(F.lag(rank).over(Window.partitionBy(group).orderBy(rank)), F.lit(0))
    gaps = held.withColumn("_b", before).where(F.col(rank) - F.col("_b") > 1)
    return gaps.select(group, F.explode(F.sequence(F.col("_b") + 1, F.col(rank) - 1)).alias(rank))


def order_violations(players: DataFrame, group: str = "event_id", order: str = "pos") -> DataFrame:
    """Neighbouring rows of which the later has more points: ``group, rank_before, points_before, rank, points``.  Pairs with a null are not judged."""
    per = Window.partitionBy(group).orderBy(order)
    rows = players.select(group, "rank", "points", F.lag("rank").over(per).alias("rank_before"), F.lag("points").over(per).alias("points_before"))
    return rows.where("points > points_before").select(group, "rank_before", "points_before", "rank", "points")


def problem_ranks(merged: DataFrame, group: str = "event_id", points_below: float = 1.0, commander_below: float = 0.5) -> DataFrame:
    """``group, rank, reason`` to look at again: gaps, no clean reading, weak agreement, both sides of a violation.  Null agreement is full."""
    gaps = missing_ranks(merged, group).select(group, "rank", F.lit("gap").alias("reason"))
    unclean = merged.where("n_clean = 0").select(group, "rank", F.lit("no clean reading").alias("reason"))
    weak = merged.where((F.coalesce("points_agreement", F.lit(1.0)) < points_below) | (F.coalesce("commander_agreement", F.lit(1.0)) < commander_below)).select(group, "rank", F.lit("agreement").alias("reason"))
    bad = order_violations(merged.withColumn("pos", F.col("rank")), group)
    sides = bad.select(group, F.explode(F.array("rank_before", "rank")).alias("rank"), F.lit("order").alias("reason"))
    return gaps.union(unclean).union(weak).union(sides).distinct()


def unresolved_ranks(merged: DataFrame, group: str = "event_id") -> DataFrame:
    """Ranks still in doubt at the end: no clean reading, points agreed by at most half, names by under half."""
    doubt = (F.col("n_clean") == 0) | (F.coalesce("points_agreement", F.lit(1.0)) <= 0.5) | (F.coalesce("commander_agreement", F.lit(1.0)) < 0.5)
    return merged.where(doubt).select(group, "rank")


def single_clean_ranks(merged: DataFrame, group: str = "event_id") -> DataFrame:
    """Ranks that rest on one clean reading."""
    return merged.where("n_clean = 1").select(group, "rank")


def duplicate_players(players: DataFrame, group: str = "event_id", key=None) -> DataFrame:
    """Names met more than once in an alliance: ``group, name_key, alliance, n, ranks``; unreadable and empty names are not judged."""
    keyed = players.where(F.col("commander").isNotNull() & (F.col("commander") != UNREADABLE)).select(group, "rank", "alliance", (name_key(F.col("commander")) if key is None else key).alias("name_key"))
    found = keyed.where("name_key <> ''").groupBy(group, "name_key", "alliance").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("rank")).alias("ranks"))
    return found.where("n > 1")


def validate(players: DataFrame, group: str = "event_id", most: int = 15) -> DataFrame:
    """Errors of each group: ``group, error, n, sample``; the sample holds the first ``most`` ranks.

    One pass: a row tells the gap before its rank, its missing fields and
    whether it has more points than the row before it.
    """
    per = Window.partitionBy(group).orderBy("rank")
    before = F.lag("points").over(Window.partitionBy(group).orderBy("pos"))
    rows = players.select(group, "rank", "commander", "points", F.coalesce(F.lag("rank").over(per), F.lit(0)).alias("_r"), before.alias("_p"))
    here = F.array("rank")
    told = [
        ("missing rank", (F.col("rank") - F.col("_r") > 1), F.sequence(F.col("_r") + 1, F.col("rank") - 1)), ("empty commander", F.coalesce("commander", F.lit("")) == "", here),
        ("missing points", F.col("points").isNull(), here), ("not monotonic", F.coalesce(F.col("points") > F.col("_p"), F.lit(False)), here),
    ]
    each = F.filter(F.array(*[F.when(holds, F.struct(F.lit(error).alias("error"), ranks.alias("ranks"))) for error, holds, ranks in told]), lambda x: x.isNotNull())
    errors = rows.select(group, F.explode(each).alias("x")).select(group, "x.error", F.explode("x.ranks").alias("rank"))
    numbered = errors.withColumn("_n", F.row_number().over(Window.partitionBy(group, "error").orderBy("rank")))
    sample = F.sort_array(F.collect_list(F.when(F.col("_n") <= most, F.col("rank"))))
    return numbered.groupBy(group, "error").agg(F.count("*").alias("n"), sample.alias("sample"))


def report(merged: DataFrame, group: str = "event_id", frames: DataFrame | None = None) -> DataFrame:
    """One row of counters per group, and whether it passes: no gap, no violation, nothing unresolved, nobody twice.

    ``frames`` (group, banner_detected) adds ``n_banner_frames``.  Counters
    come from one window over each group's ranks, those who stand twice from
    one aggregation.
    """
    per = Window.partitionBy(group).orderBy("rank")
    rows = merged.withColumn("_gap", F.col("rank") - F.coalesce(F.lag("rank").over(per), F.lit(0)) - 1).withColumn("_up", F.col("points") > F.lag("points").over(per))
    doubt = (F.col("n_clean") == 0) | (F.coalesce("points_agreement", F.lit(1.0)) <= 0.5) | (F.coalesce("commander_agreement", F.lit(1.0)) < 0.5)
    out = rows.groupBy(group).agg(
        F.count("*").alias("n_records"), F.max("rank").alias("max_rank"), F.count(F.when(F.col("used_tainted"), 1)).alias("n_tainted"), F.count(F.when(F.col("n_clean") == 1, 1)).alias("n_single_clean"),
        F.count(F.when(F.col("name_unreadable"), 1)).alias("n_unreadable"), F.sum(F.greatest("_gap", F.lit(0))).cast("bigint").alias("n_missing"), F.count(F.when(F.col("_up"), 1)).alias("n_violations"), F.count(F.when(doubt, 1)).alias("n_unresolved"),
    )
    count = lambda found, name: found.groupBy(group).agg(F.count("*").alias(name))
    extra = [(count(duplicate_players(merged.where(~F.coalesce("name_unreadable", F.lit(False))), group), "n_duplicates"), "n_duplicates")]
    if frames is not None:
        extra.append((count(frames.where("banner_detected"), "n_banner_frames"), "n_banner_frames"))
    for counted, name in extra:
        out = out.join(counted, group, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.withColumn("passed", (F.col("n_missing") == 0) & (F.col("n_violations") == 0) & (F.col("n_unresolved") == 0) & (F.col("n_duplicates") == 0))


def repaired(readings: DataFrame, rounds: list[DataFrame], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(merged records, ranks that were read again) after rounds of repair.

    Before each round the readings so far are merged; ranks in doubt (in the
    first round also those with one clean reading) are targets, and the new
    readings that show them join the vote.  Nothing read before is dropped.
    ``keys`` are the group and the rank.
    """
    group, targets = keys[0], None
    for n, again in enumerate(rounds):
        merged = durable(merge_readings(readings, keys))
        wanted = problem_ranks(merged, group).select(*keys)
        if n == 0:
            wanted = wanted.unionByName(single_clean_ranks(merged, group))
        wanted = durable(wanted.distinct())
        targets = wanted if targets is None else targets.unionByName(wanted)
        readings = readings.unionByName(again.join(wanted, keys, "left_semi"))
    return merge_readings(readings, keys), targets.distinct()
