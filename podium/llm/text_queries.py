"""Queries of problems 6, 7 and 8: texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.mixing import Plan, Source, entropy, exponent_for_entropy, plan, read_sources, realise, tempered
from podium.llm.mojibake import restored
from podium.llm.packing import pack
from podium.llm.tokens import token_sizes
from podium.session import durable, table


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durable(token_sizes(table(spark, sf_dir, "documents"), "doc_id", "text", keep=("source",)))


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int]]:
    rows = table(spark, sf_dir, "containers").where("container_class is not null and capacity_tokens is not null").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("more than 1000 classes of containers")
    capacities = {r.container_class: r.capacity_tokens for r in sorted(rows)}
    return pack(_sizes(spark, sf_dir), "doc_id", "n_tokens", capacities), capacities


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tokens of which text stand in which container, for every class."""
    return _packed(spark, sf_dir)[0].withColumnRenamed("item_id", "doc_id")


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of each class, the tokens in them and the share of their space in use."""
    placed, capacities = _packed(spark, sf_dir)
    capacity = F.create_map(*[F.lit(x) for pair in capacities.items() for x in pair])
    each = placed.groupBy("container_class", "container_id").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("held"), F.count("*").alias("pieces"))
    out = each.groupBy("container_class").agg(F.count("*").alias("n_containers"), F.sum("held").alias("n_tokens"), F.sum("pieces").alias("n_pieces"), F.max("held").alias("most_tokens"))
    return out.withColumn("fill_share", F.round(F.col("n_tokens") / (F.col("n_containers") * capacity[F.col("container_class")]), 6))


def _mixed(spark: SparkSession, sf_dir: str, size: float | None = None, wanted_entropy: float | None = None, share: float | None = None) -> tuple[DataFrame, list[Source], Plan]:
    sizes = _sizes(spark, sf_dir)
    sources = read_sources(sizes, "source", table(spark, sf_dir, "source_targets"))
    made = plan(sources, size if share is None else share * sum(s.tokens for s in sources), wanted_entropy)
    return realise(sizes, "doc_id", "source", sources, made.budgets), sources, made


#: The size of the tempered mixture, as a share of the tokens its sources hold.
TEMPERED_SHARE = 0.5


def p7_mixture(spark: SparkSession, sf_dir: str, size: float | None = None, wanted_entropy: float | None = None) -> DataFrame:
    """The mixture, a row per use of a document: of ``size`` tokens, by default the most that keep every target within its repetition limit."""
    return _mixed(spark, sf_dir, size, wanted_entropy)[0]


def _shares(spark: SparkSession, mixture: DataFrame, sources: list[Source], made: Plan) -> DataFrame:
    wanted = spark.createDataFrame([(s.name, s.target, s.max_repeats, s.tokens, made.exponent, made.budgets[s.name]) for s in sources], "source string, target_share double, max_repeats int, source_tokens bigint, exponent double, budget bigint")
    reached = mixture.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_uses"), (F.max("pass_no") + 1).alias("most_uses"))
    every = Window.partitionBy()  # one row per source
    return wanted.join(reached, "source", "left").select(
        "source", "target_share", F.try_divide("n_tokens", F.sum("n_tokens").over(every)).alias("reached_share"), "max_repeats", "most_uses", "n_uses", "n_tokens", "budget", "source_tokens", "exponent",
        (F.col("budget") == 0).alias("left_out"),
    )


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source, how often a document of it is used at most, and whether it is left out."""
    return _shares(spark, *_mixed(spark, sf_dir))


def p7_tempered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture of half the tokens that the sources hold: repetition limits lower the exponent below 1, as close to the targets as they allow."""
    return _mixed(spark, sf_dir, share=TEMPERED_SHARE)[0]


def p7_tempered_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of that mixture and its exponent."""
    return _shares(spark, *_mixed(spark, sf_dir, share=TEMPERED_SHARE))


def p7_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of every source, tempered to the entropy that the targets have."""
    sizes = _sizes(spark, sf_dir)
    goal = entropy([s.target or 0.0 for s in read_sources(sizes, "source", table(spark, sf_dir, "source_targets"))])
    sources = read_sources(sizes, "source")
    exponent = exponent_for_entropy(sources, goal)
    rows = [(s.name, s.tokens, w, exponent) for s, w in zip(sources, tempered(sources, exponent))]
    return spark.createDataFrame(rows, "source string, n_tokens bigint, weight double, exponent double")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage decoded with the wrong encoding."""
    return restored(table(spark, sf_dir, "documents"), "doc_id", "text", with_text=False)


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected documents with their text as far as it can be restored."""
    return restored(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {
    "p6_containers": p6_containers, "p6_fill": p6_fill, "p7_mixture": p7_mixture, "p7_shares": p7_shares, "p7_tempered": p7_tempered, "p7_tempered_shares": p7_tempered_shares,
    "p7_temperature": p7_temperature, "p8_found": p8_found, "p8_restored": p8_restored,
}
#: These need a tokenizer or code tables; they are tested by round trips and against brute force.
ORACLE: dict[str, str] = {}
