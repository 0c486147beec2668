"""The tables that queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.session import table

#: The final list of each event; of rows delivered again the first counts.
BOARD_SQL = """board AS (
  SELECT event_id, scan_id, rank, rank AS pos, commander, alliance, alliance_tag, alliance_name, server, points, row_id
  FROM rankings WHERE scan_kind = 'final'
  QUALIFY row_number() OVER (PARTITION BY event_id, scan_id, rank ORDER BY row_id) = 1
)"""


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final list of each event with ``pos``; of rows delivered again that with the least row_id."""
    rows = table(spark, sf_dir, "rankings").where("scan_kind = 'final'")
    first = F.row_number().over(Window.partitionBy("event_id", "scan_id", "rank").orderBy("row_id"))
    once = rows.withColumn("_n", first).where("_n = 1")  # Spark keeps one row of each group before the shuffle and reads only columns in use
    return once.select("event_id", "scan_id", "rank", F.col("rank").cast("bigint").alias("pos"), "commander", "alliance", "alliance_tag", "alliance_name", "server", "points", "row_id")


#: Every row of a scan as a reading of its rank.
READINGS_SQL = """readings AS (
  SELECT event_id, rank, commander, alliance, server, points, row_id AS seq, (row_id % 100) / 100.0::DOUBLE AS y,
    scan_kind = 'incremental' AND row_id % 5 = 0 AS tainted, points IS NOT NULL AND commander <> '' AS complete, coalesce(commander, '') = '' AS name_unreadable
  FROM rankings
)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ranking row as one reading of its event's rank, with a height and marks made from its id."""
    return table(spark, sf_dir, "rankings").select(
        "event_id", "rank", "commander", "alliance", "server", "points", F.col("row_id").alias("seq"), ((F.col("row_id") % 100) / 100.0).alias("y"),
        ((F.col("scan_kind") == "incremental") & (F.col("row_id") % 5 == 0)).alias("tainted"),
        (F.col("points").isNotNull() & (F.col("commander") != "")).alias("complete"), (F.coalesce("commander", F.lit("")) == "").alias("name_unreadable"),
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published events, the latest publication of each."""
    rows = table(spark, sf_dir, "war_manifest")
    fields = [c for c in rows.columns if c != "event_id"]
    return rows.groupBy("event_id").agg(F.max_by(F.struct(*fields), F.struct("published_at", "total_points")).alias("r")).select("event_id", "r.*")


MANIFEST_SQL = """manifest AS (
  SELECT * FROM war_manifest QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY published_at DESC, total_points DESC) = 1
)"""
