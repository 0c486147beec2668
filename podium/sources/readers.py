"""Reading what the pipeline writes: boxes, lists, registries, corrections, bundles.  Schemas are explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOX = T.StructType([T.StructField("text", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in ("confidence", "x", "y", "width", "height")]])
PLAYER = T.StructType(
    [
        T.StructField("rank", T.IntegerType()), T.StructField("commander", T.StringType()), T.StructField("alliance", T.StringType()), T.StructField("alliance_tag", T.StringType()),
        T.StructField("alliance_name", T.StringType()), T.StructField("server", T.StringType()), T.StructField("points", T.LongType()), T.StructField("server_rank", T.IntegerType()),
    ]
)
MEMBER = T.StructType([T.StructField("rank", T.IntegerType()), T.StructField("commander", T.StringType()), T.StructField("points", T.LongType()), T.StructField("server", T.StringType())])
STANDING = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("alliance", "tag", "name", "server")], T.StructField("members_count", T.LongType()), T.StructField("total_points", T.LongType()), T.StructField("avg_points", T.LongType()),
        T.StructField("top_commander", T.StringType()), T.StructField("top_points", T.LongType()), T.StructField("top_rank", T.IntegerType()), T.StructField("rank", T.IntegerType()), T.StructField("server_rank", T.IntegerType()),
        T.StructField("members", T.ArrayType(MEMBER)),
    ]
)
META = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("id", "title", "date", "home_server", "opponent_server", "home_role")],
        T.StructField("total_players", T.IntegerType()), T.StructField("total_points", T.LongType()), T.StructField("unique_alliances", T.IntegerType()),
        T.StructField("servers", T.MapType(T.StringType(), T.StructType([T.StructField("name", T.StringType()), T.StructField("players", T.IntegerType()), T.StructField("points", T.LongType()), T.StructField("point_share_pct", T.DoubleType())]))),
    ]
)
SCAN = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("scan_id", "scan_kind", "event_id", "date", "home_server", "opponent_server", "home_role", "started_at", "finished_at")],
        T.StructField("total_players", T.IntegerType()), T.StructField("total_points", T.LongType()), T.StructField("unique_alliances", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in ("top_alliance", "top_commander", "path")],
    ]
)


#: The folder of a file, by its value where it is written as name=value.
_FOLDER = r"(?:event_id=)?([^/]+)/[^/]+$"


def boxes(spark: SparkSession, path: str) -> DataFrame:
    """Text boxes of screens, one JSON array a file: ``frame`` is the file's name, ``seq`` the place in the array."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.json)?$", 1).alias("frame"), F.from_json("value", T.ArrayType(BOX)).alias("b"))
    return files.select("frame", F.posexplode("b").alias("seq", "b")).select("frame", "seq", "b.*")


def players(spark: SparkSession, path: str) -> DataFrame:
    """A list of players, one JSON array a file, with ``pos`` and the file's folder as ``event_id``."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1).alias("event_id"), F.from_json("value", T.ArrayType(PLAYER)).alias("p"))
    return files.select("event_id", F.posexplode("p").alias("pos", "p")).select("event_id", F.col("pos").cast("bigint").alias("pos"), "p.*")


def standings(spark: SparkSession, path: str) -> DataFrame:
    """Published standings with their members, one JSON array a file, and the file's folder as ``event_id``."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1).alias("event_id"), F.from_json("value", T.ArrayType(STANDING)).alias("p"))
    return files.select("event_id", F.explode("p").alias("p")).select("event_id", "p.*")


def event_documents(spark: SparkSession, path: str) -> DataFrame:
    """Published documents of events, one JSON object a file."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", META).alias("m")).select("m.*")


def bundle(spark: SparkSession, path: str, part: str) -> DataFrame:
    """``rankings``, ``alliances`` or ``meta`` of published script bundles: the line that begins with the part's name."""
    lines = spark.read.text(path).select(F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1).alias("event_id"), F.trim("value").alias("line"))
    body = lines.select("event_id", F.regexp_extract("line", rf'^"?{part}"?\s*:\s*(.*?),?$', 1).alias("json")).where("json <> ''")
    if part == "meta":
        return body.select("event_id", F.from_json("json", META).alias("m")).select("event_id", "m.*")
    kind = STANDING if part == "alliances" else PLAYER
    rows = body.select("event_id", F.posexplode(F.from_json("json", T.ArrayType(kind))).alias("pos", "p"))
    return rows.select("event_id", F.col("pos").cast("bigint").alias("pos"), "p.*")


def earlier_players(spark: SparkSession, root: str, exclude_event: str) -> DataFrame:
    """Players of every event under ``root`` (written with ``write_players``) but one; the partition is pruned."""
    return spark.read.parquet(root).where(F.col("event_id") != exclude_event)


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """``before, after`` of a JSON object of strings; empty if there is no such file or it can't be read."""
    schema = "before string, after string"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    found = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return found.select(F.explode("m").alias("before", "after"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a registry, a JSON array; empty if it is missing or can't be read."""
    entry = T.StructType([*META.fields[:9], T.StructField("top_alliance", T.StringType()), T.StructField("top_commander", T.StringType()), T.StructField("data_version", T.StringType())])
    if not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("pos", T.IntegerType()), *entry.fields]))
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", T.ArrayType(entry))).alias("pos", "e")).select("pos", "e.*")


def scans(spark: SparkSession, path: str) -> DataFrame:
    """Entries of scan indexes, whether a file holds an object with ``scans`` or the array itself."""
    text = spark.read.text(path, wholetext=True)
    boxed = F.from_json("value", T.StructType([T.StructField("scans", T.ArrayType(SCAN))]))["scans"]
    bare = F.from_json("value", T.ArrayType(SCAN))
    return text.select(F.explode(F.when(F.ltrim("value").startswith("["), bare).otherwise(boxed)).alias("s")).select("s.*")


def images(spark: SparkSession, path: str) -> DataFrame:
    """``path, taken_at`` of screenshots in time order; the time in the name counts, else that of the file.  Contents are not read."""
    kinds = r"(?i)\.(png|jpg|jpeg|heic|webp|tif|tiff|bmp)$"
    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime").where(F.col("path").rlike(kinds))
    named = F.try_to_timestamp(F.nullif(F.regexp_extract("path", r"Screenshot_(\d{8}_\d{6})", 1), F.lit("")), F.lit("yyyyMMdd_HHmmss"))
    return files.select("path", F.coalesce(named, "modificationTime").alias("taken_at")).orderBy("taken_at", "path")


def expired(spark: SparkSession, path: str, days: int) -> DataFrame:
    """Files older than ``days``."""
    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime")
    return files.where(F.col("modificationTime") < F.current_timestamp() - F.make_interval(days=F.lit(days)))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))
