"""Problem 7: mixing sources to target weights.

Weights are tempered: w_i is proportional to p_i * (t_i / p_i) ** a for natural
token shares p and targets t, so that a = 0 gives the natural mixture and a = 1
the targets; with no targets w_i is proportional to p_i ** a.  The exponent is
found by bisection: to meet a target entropy, or as the largest up to 1 that
keeps every source within its repetition limit at a wanted size.  Without a
wanted size the mixture is as large as the weights' limits allow, so targets
are then met exactly.  The weights are realised as budgeted block permutations:
every pass over a source is a fresh permutation of hashed blocks and of the
documents in them; whole blocks are taken until the block in which the budget
ends, of which those documents are taken, in order, that still fit.

Sources without tokens (or without a target, where there are targets) are left
out, the targets of the others are normalised again, and the report names them.

Only one row per source reaches the driver.  Prefix sums run over at most
RANGES ranges of blocks, then over the blocks of the one range in which a
budget ends, then within one block; so a source with most of the documents is
spread over all tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.session import durable

#: Tokens that a block holds on average.
BLOCK_TOKENS = 500_000
#: Ranges into which the blocks of a pass are put for the first of the prefix sums, a power of two.
RANGES = 256
#: Most sources; one row of each is held by the driver.
MAX_SOURCES = 100_000


@dataclass(frozen=True)
class Source:
    name: str
    tokens: int
    target: float | None
    max_repeats: int


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(sources: list[Source], exponent: float) -> list[float]:
    """Normalised weights at ``exponent``; a source without tokens has none."""
    total = sum(s.tokens for s in sources) or 1
    raw = []
    for s in sources:
        p = s.tokens / total
        if p <= 0:
            raw.append(0.0)
        elif s.target is None:
            raw.append(p**exponent)
        else:
            raw.append(p * (s.target / p) ** exponent if s.target > 0 else 0.0)
    return [r / (sum(raw) or 1.0) for r in raw]


def bisect(holds, low: float, high: float, steps: int = 60) -> float:
    """The largest x of [low, high] for which ``holds``, which holds up to some point; low if nowhere."""
    if holds(high):
        return high
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def exponent_for_entropy(sources: list[Source], wanted: float) -> float:
    """The exponent at which the weights have the entropy ``wanted``.

    Of untargeted weights the entropy falls as the exponent grows, from any to
    0; with targets the exponent lies between the natural mixture (0) and the
    targets (1), whichever way the entropy runs between them.
    """
    at = lambda a: entropy(tempered(sources, a))
    if all(s.target is None for s in sources):
        return bisect(lambda a: at(a) >= wanted, 0.0, 64.0)
    return bisect(lambda a: at(a) <= wanted if at(1.0) >= at(0.0) else at(a) >= wanted, 0.0, 1.0)


def exponent_for_limits(sources: list[Source], size: float, most: float = 1.0) -> float:
    """The largest exponent up to ``most`` at which ``size`` tokens repeat no source beyond its limit."""
    return bisect(lambda a: all(w * size <= s.tokens * s.max_repeats * (1 + 1e-12) for w, s in zip(tempered(sources, a), sources)), 0.0, most)


def usable(sources: list[Source]) -> list[Source]:
    """The sources that can contribute, their targets normalised to sum to 1."""
    held = [s for s in sources if s.tokens > 0 and s.max_repeats > 0 and (s.target is None or s.target > 0)]
    whole = sum(s.target or 0.0 for s in held)
    return [replace(s, target=s.target / whole) if s.target is not None else s for s in held]


def largest_size(sources: list[Source], exponent: float = 1.0) -> float:
    """The most tokens in which every source can have its weight within its repetition limit; 0 without sources."""
    return min((s.tokens * s.max_repeats / w for s, w in zip(sources, tempered(sources, exponent)) if w > 0), default=0.0)


@dataclass(frozen=True)
class Plan:
    """What a mixture is made of: the bisected exponent, its size, and the tokens of each source."""

    exponent: float
    size: float
    budgets: dict[str, int]


def plan(sources: list[Source], size: float | None = None, wanted_entropy: float | None = None) -> Plan:
    """The mixture of ``size`` tokens, or of the most that its weights allow.

    The exponent is that of ``wanted_entropy`` (by default 1, the targets or
    the natural shares), lowered as far as ``size`` asks for.  If even the
    natural mixture repeats a source too often at that size, its limit counts.
    """
    held = usable(sources)
    exponent = 1.0 if wanted_entropy is None else exponent_for_entropy(held, wanted_entropy)
    if size is None:
        size = largest_size(held, exponent)
    exponent = exponent_for_limits(held, size, exponent)
    weights = dict(zip((s.name for s in held), tempered(held, exponent)))
    return Plan(exponent, size, {s.name: min(int(weights.get(s.name, 0.0) * size), s.tokens * s.max_repeats) for s in sources})


def budgets(sources: list[Source], size: float | None = None, wanted_entropy: float | None = None) -> dict[str, int]:
    """Tokens each source contributes; see ``plan``."""
    return plan(sources, size, wanted_entropy).budgets


def read_sources(sizes: DataFrame, source: str, targets: DataFrame | None = None, repeats: int = 1) -> list[Source]:
    """Every source with its tokens, by name; with ``targets`` (source, target_share, max_repeats) only those in it."""
    totals = sizes.where(f"`{source}` is not null").groupBy(F.col(source).alias("source")).agg(F.sum("n_tokens").alias("tokens"))
    if targets is not None:
        totals = targets.select("source", "target_share", "max_repeats").where("source is not null").join(totals, "source", "left")
    else:
        totals = totals.select("source", F.lit(None).cast("double").alias("target_share"), F.lit(repeats).alias("max_repeats"), "tokens")
    rows = totals.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return sorted((Source(r.source, int(r.tokens or 0), r.target_share, max(int(r.max_repeats or 0), 0)) for r in rows), key=lambda s: s.name)


def realise(sizes: DataFrame, key: str, source: str, sources: list[Source], budget: dict[str, int], seed: int = 17, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixture: ``source, pass_no, block_rank, doc_rank_key, doc_id, n_tokens``, one row per use of a document.

    A source's rows sum to its budget, or less by under the smallest document left out.  Sorting
    by block_rank and doc_rank_key gives the order in which a pass is read.
    Documents without tokens, key or source are left out.
    """
    spark = sizes.sparkSession
    plans = []
    for s in sources:
        left, passes = budget.get(s.name, 0), 0
        while left > 0 and passes < s.max_repeats and s.tokens > 0:
            part = min(left, s.tokens)
            plans.append((s.name, passes, part, part == s.tokens, max(1, -(-s.tokens // block_tokens))))
            left, passes = left - part, passes + 1
    wanted = F.broadcast(spark.createDataFrame(plans, "source string, pass_no int, budget bigint, whole boolean, blocks bigint"))
    docs = sizes.select(F.col(key).cast("bigint").alias("doc_id"), F.col(source).alias("source"), "n_tokens").where("doc_id is not null and source is not null and n_tokens > 0")
    uses = docs.join(wanted, "source").withColumn("block_no", F.pmod(F.xxhash64(F.lit(seed), "pass_no", "doc_id"), F.col("blocks")))
    uses = uses.withColumn("block_rank", F.xxhash64(F.lit(seed + 1), "pass_no", "block_no")).withColumn("doc_rank_key", F.xxhash64(F.lit(seed + 2), "pass_no", "doc_id"))
    columns = ["source", "pass_no", "block_rank", "doc_rank_key", "doc_id", "n_tokens"]
    whole = uses.where("whole").select(*columns)
    part = uses.where("not whole")
    # Sums over ranges of blocks tell in which range a budget ends; only its blocks are summed one by one.
    part = part.withColumn("range", F.shiftright("block_rank", 64 - (RANGES - 1).bit_length()))
    of_pass = ["source", "pass_no"]
    by_range = part.groupBy(*of_pass, "range", "budget").agg(F.sum("n_tokens").alias("held"))
    upto = F.sum("held").over(Window.partitionBy(*of_pass).orderBy("range"))
    ranges = by_range.withColumn("r_upto", upto).withColumn("r_before", F.col("r_upto") - F.col("held")).where("r_before < budget").select(*of_pass, "range", "r_before", "r_upto")
    met = durable(part.join(ranges, [*of_pass, "range"]))
    edge = met.where("r_upto > budget")
    by_block = edge.groupBy(*of_pass, "block_no", "block_rank", "budget", "r_before").agg(F.sum("n_tokens").alias("held"))
    order = Window.partitionBy(*of_pass).orderBy("block_rank", "block_no")
    ends = by_block.withColumn("upto", F.col("r_before") + F.sum("held").over(order)).withColumn("before", F.col("upto") - F.col("held")).where("before < budget")
    kept = edge.join(ends.select(*of_pass, "block_no", "before", "upto"), [*of_pass, "block_no"])
    inner = met.where("r_upto <= budget").select(*columns)
    inside = kept.where("upto <= budget").select(*columns)
    ending = kept.where("upto > budget").select(*columns, (F.col("budget") - F.col("before")).alias("left"))
    last = ending.groupBy("source", "pass_no", "block_rank").applyInPandas(_fill, ending.select(*columns).schema)
    return whole.unionByName(inner).unionByName(inside).unionByName(last)


def _fill(block: pd.DataFrame) -> pd.DataFrame:
    """The documents of the block in which a budget ends, in order, each if it still fits."""
    left, taken = int(block["left"].iloc[0]), []
    block = block.sort_values(["doc_rank_key", "doc_id"])
    for size in block["n_tokens"]:
        taken.append(size <= left)
        left -= size if size <= left else 0
    return block[taken].drop(columns="left")
