"""Writing lists, standings, snapshots and registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.text import label_name, label_tag
from podium.operators import rollup
from podium.operators.publish import content_version, event_documents, upsert
from podium.session import durable
from podium.sources.readers import _exists


def write_players(players: DataFrame, root: str) -> None:
    """Players by event, replacing only the events they hold."""
    players.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_id").parquet(root)


def write_snapshot(players: DataFrame, root: str) -> None:
    """Players by event and scan, replacing only the scans they hold; registries are not touched."""
    players.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_id", "scan_id").parquet(root)


def rankings_csv(players: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the published list, before them those to ``keep``."""
    return players.select(*keep, F.col("rank").alias("Rank"), F.col("server_rank").alias("Server_Rank"), F.col("commander").alias("Commander"), F.col("alliance").alias("Alliance"), F.concat(F.lit("S"), "server").alias("Server"), F.col("points").alias("Points"))


def alliances_csv(standings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the published standings, before them those to ``keep``."""
    return standings.select(
        *keep,
        F.col("rank").alias("Rank"), F.col("server_rank").alias("Server_Rank"), F.col("alliance").alias("Alliance"), F.concat(F.lit("S"), "server").alias("Server"), F.col("members_count").alias("Members"),
        F.col("total_points").alias("Total Points"), F.col("avg_points").alias("Avg Points/Player"), F.col("top_commander").alias("Top Commander"), F.col("top_points").alias("Top Commander Points"),
    )


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def script_bundle(meta: DataFrame, alliances: DataFrame, players: DataFrame) -> DataFrame:
    """``event_id, value``: a script of five lines that assigns an event's data to a variable named after it.

    An event's list is one document of the published format, so it is gathered
    per event; events go to different tasks.
    """
    def packed(df: DataFrame, order: str, name: str) -> DataFrame:
        fields = [c for c in df.columns if c not in ("event_id", order)]
        rows = F.transform(F.sort_array(F.collect_list(F.struct(order, F.struct(*fields).alias("r")))), lambda x: x["r"])
        return df.groupBy("event_id").agg(F.to_json(rows).alias(name))

    one = meta.select("event_id", F.to_json(F.struct(*[c for c in meta.columns if c != "event_id"])).alias("m"))
    joined = one.join(packed(alliances, "rank", "a"), "event_id", "left").join(packed(players, "pos", "p"), "event_id", "left")
    name = F.concat(F.lit("window.EVENT_"), F.translate("event_id", "-", "_"), F.lit(" = {"))
    value = F.concat_ws("\n", name, F.concat(F.lit("  meta: "), "m", F.lit(",")), F.concat(F.lit("  alliances: "), F.coalesce("a", F.lit("[]")), F.lit(",")), F.concat(F.lit("  rankings: "), F.coalesce("p", F.lit("[]"))), F.lit("};"))
    return joined.select("event_id", value.alias("value"))


def publish_gate(players: DataFrame, report: DataFrame, root: str, staging: str) -> bool:
    """Writes to ``root`` if every event's report passes and there are rows, else to ``staging``; tells which."""
    failed = report.where(~F.col("passed")).limit(1).count()
    fine = failed == 0 and players.limit(1).count() == 1
    write_players(players, root if fine else staging)
    return fine


def documents(rows: DataFrame, order: str) -> DataFrame:
    """``event_id, value``: the rows of each event, in order, as one JSON array; the published format is one document an event."""
    fields = [c for c in rows.columns if c not in ("event_id", order)]
    packed = F.transform(F.sort_array(F.collect_list(F.struct(order, F.struct(*fields).alias("r")))), lambda x: x["r"])
    return rows.groupBy("event_id").agg(F.to_json(packed, {"ignoreNullFields": "false"}).alias("value"))


def write_documents(docs: DataFrame, path: str) -> None:
    """Documents (event_id, value), a folder for each event, replacing only the events they hold."""
    docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_id").text(path)


def publish(meta: DataFrame, players: DataFrame, root: str) -> DataFrame:
    """Everything that is published of the events in ``players``, in one go; returns the new registry.

    Documents of the event, its list (with the rank within the server) and its
    standings (with members), both tables as CSV, the script bundle, the
    registry with the bundle's version, and the list of the newest event, which
    moves only to an event not older than all known ones.  Running it again
    with the same events changes nothing but what they say.
    """
    spark = players.sparkSession
    ranked = durable(players.select("event_id", "pos", "rank", "commander", "alliance", "alliance_tag", "alliance_name", "server", "points", F.row_number().over(Window.partitionBy("event_id", "server").orderBy("pos")).alias("server_rank")))
    standings = durable(rollup.with_members(rollup.alliance_standings(ranked), ranked).withColumn("tag", label_tag(F.col("alliance"))).withColumn("name", label_name(F.col("alliance"))))
    events = durable(event_documents(meta, ranked))
    described = events.select("event_id", F.struct(F.col("event_id").alias("id"), "title", F.col("event_date").alias("date"), "home_server", "opponent_server", "home_role", "total_players", "total_points", "unique_alliances", "servers").alias("m"))
    write_documents(described.select("event_id", F.to_json("m", {"ignoreNullFields": "false"}).alias("value")), f"{root}/event")
    write_documents(documents(ranked, "pos"), f"{root}/rankings")
    write_documents(documents(standings.withColumn("_o", F.col("rank")), "_o"), f"{root}/alliances")
    for name, rows in (("rankings_csv", rankings_csv(ranked, ("event_id",))), ("alliances_csv", alliances_csv(standings, ("event_id",)))):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy("event_id").csv(f"{root}/{name}")
    bundle = durable(script_bundle(described.select("event_id", "m.*"), standings.drop("first_pos"), ranked))
    write_documents(bundle, f"{root}/bundle")
    numbered = events.join(bundle.select("event_id", content_version(F.col("value")).alias("data_version")), "event_id").withColumn("pos", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("event_date", "event_id")).cast("bigint"))  # a row for each event
    entries = numbered.select("event_id", "title", "event_date", "home_server", "opponent_server", "home_role", "total_players", "total_points", "top_alliance", "top_commander", "data_version", "pos")
    old = durable(spark.read.parquet(f"{root}/registry")) if _exists(spark, f"{root}/registry") else entries.limit(0)
    registry = durable(upsert(old, entries, "event_id"))
    registry.write.mode("overwrite").parquet(f"{root}/registry")
    newest = registry.agg(F.max(F.struct("event_date", "event_id")).alias("n")).select("n.event_date", "n.event_id")
    latest = ranked.join(F.broadcast(newest), "event_id").drop("event_date")
    if latest.limit(1).count():
        latest.write.mode("overwrite").parquet(f"{root}/latest")
    return registry
