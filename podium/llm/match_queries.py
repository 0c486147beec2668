"""Queries of problem 3: reposted results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.matching import match_records
from podium.session import table

_SHARED = ["commander", "alliance", "server", "points"]


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = table(spark, sf_dir, "rankings").where("scan_kind = 'final'").select(F.col("row_id").alias("id"), F.col("event_id").alias("context"), F.col("scan_id").alias("scan"), "rank", *_SHARED)
    posted = table(spark, sf_dir, "mirror_board").select(F.col("mirror_id").alias("id"), F.col("event_id").alias("context"), *_SHARED)
    return match_records(board, posted)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final rankings rows and the mirror records that describe the same commander."""
    return _matches(spark, sf_dir).select(F.col("board_id").alias("row_id"), F.col("posted_id").alias("mirror_id"))


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with their confidence and cosine."""
    return _matches(spark, sf_dir).select(F.col("board_id").alias("row_id"), F.col("posted_id").alias("mirror_id"), "confidence", "cosine")


QUERIES = {"p3_found": p3_found, "p3_matches": p3_matches}
#: Vectors and assignments are beyond SQL; recall is tested against brute force.
ORACLE: dict[str, str] = {}
