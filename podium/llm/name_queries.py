"""Queries of problems 2, 4 and 5: names and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.canonical import load_reference, map_values
from podium.llm.normalize import normal_forms, values_not_plain
from podium.llm.variants import group_pairs, link_variants
from podium.session import table

FIELDS = ["commander", "alliance"]


def _registry(spark: SparkSession, sf_dir: str) -> list[tuple[int, str, str]]:
    return load_reference(table(spark, sf_dir, "alliance_registry"), "alliance_id", "alliance", "alliance_name")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of rankings that are not in plain form."""
    entries = [label for _, label, _ in _registry(spark, sf_dir)]
    return values_not_plain(table(spark, sf_dir, "rankings"), "row_id", {"commander": None, "alliance": entries})


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct commander and alliance with its plain form and comparison key."""
    return normal_forms(table(spark, sf_dir, "rankings"), FIELDS)


def _free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings rows whose alliance was freely entered: not empty, not 'No Alliance', no registry entry."""
    rows = table(spark, sf_dir, "rankings").select("row_id", "alliance").where("alliance <> '' and alliance <> 'No Alliance'")
    exact = table(spark, sf_dir, "alliance_registry").select("alliance").where("alliance is not null").distinct()
    return rows.join(F.broadcast(exact), "alliance", "left_anti")


def _mapped(spark: SparkSession, sf_dir: str, free: DataFrame) -> DataFrame:
    reference = load_reference(table(spark, sf_dir, "alliance_registry"), "alliance_id", "alliance_tag", "alliance_name")
    return map_values(free, "alliance", reference)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry entry that each freely entered alliance means, or 0."""
    free = _free(spark, sf_dir)
    mapped = _mapped(spark, sf_dir, free).select(F.col("value").alias("alliance"), F.col("entry_id").alias("alliance_id"))
    return free.join(mapped, "alliance").select("row_id", "alliance_id")


def p4_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct freely entered alliance with its entry and the confidence; entry 0 reports that there is none."""
    return _mapped(spark, sf_dir, _free(spark, sf_dir))


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_variants(table(spark, sf_dir, "known_names"), "name_id", "kind", "server", {"commander": "commander", "alliance": "alliance"}, "alliance")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of known spellings that mean the same commander or alliance."""
    return group_pairs(_groups(spark, sf_dir)).select(F.col("id_a").alias("name_id_a"), F.col("id_b").alias("name_id_b"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each known spelling with the group it belongs to."""
    return _groups(spark, sf_dir).select(F.col("id").alias("name_id"), F.col("group_id").alias("group_name_id"))


QUERIES = {"p2_found": p2_found, "p2_forms": p2_forms, "p4_found": p4_found, "p4_values": p4_values, "p5_found": p5_found, "p5_groups": p5_groups}
#: These need Unicode tables, edit distances or components that SQL lacks; they are tested against brute force.
ORACLE: dict[str, str] = {}
