"""Truth discovery: one value for each key from repeated, unreliable readings.

Readings have a key, a value, a height ``y`` (0.45 is the middle of a screen,
where readings are best) and an arrival number ``seq``.  Votes are counts per
value, aggregated before the shuffle, then the least struct of (-count,
distance to the middle, arrival), so a key with a third of all readings needs
no window over its rows.
"""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.text import UNREADABLE, name_key
from podium.session import durable

#: Where on the screen readings are best, fixed value.
CENTRE = 0.45
#: Names at least this alike are readings of one; used up to this agreement, fixed values.
ALIKE, FALLBACK = 0.8, 0.5


def distance(y: str = "y") -> Column:
    return F.abs(F.coalesce(F.col(y), F.lit(CENTRE)) - CENTRE)


def vote(readings: DataFrame, keys: list[str], value: str, nulls: bool = False, by_distance: bool = True) -> DataFrame:
    """``keys, value, votes, n_valid, agreement``: the most frequent value of each key.

    Null and empty readings do not vote unless ``nulls``; a key without a vote
    has a null value and agreement 0.  Ties go to the value read nearest the
    centre, then to the earliest; without ``by_distance`` to the earliest.
    """
    valid = F.lit(True) if nulls else F.col(value).isNotNull() & (F.col(value).cast("string") != "")
    near = F.struct((distance() if by_distance else F.lit(0.0)).alias("d"), F.col("seq").alias("s"))
    counted = readings.groupBy(*keys, value).agg(F.count(F.when(valid, 1)).alias("n"), F.min(near).alias("k"))
    best = F.min(F.when(F.col("n") > 0, F.struct((-F.col("n")).alias("m"), "k", F.col(value).alias("v"))))
    out = counted.groupBy(*keys).agg(best.alias("b"), F.sum("n").alias("n_valid"))
    share = F.when(F.col("n_valid") > 0, F.bround(-F.col("b.m") / F.col("n_valid"), 3)).otherwise(F.lit(0.0))
    return out.select(*keys, F.col("b.v").alias(value), F.coalesce(-F.col("b.m"), F.lit(0)).alias("votes"), "n_valid", share.alias("agreement"))


def best_tier(readings: DataFrame, keys: list[str]) -> DataFrame:
    """The readings of each key that may vote: complete and clean ones, else complete ones, else all.

    Adds ``used_tainted``, ``n_obs`` and ``n_clean`` of the key.
    """
    complete, tainted = F.coalesce("complete", F.lit(False)), F.coalesce("tainted", F.lit(False))
    tiered = readings.withColumn("_tier", F.when(complete & ~tainted, 1).when(complete, 2).otherwise(3))
    of_key = tiered.groupBy(*keys).agg(F.min("_tier").alias("_best"), F.count("*").alias("n_obs"), F.count(F.when(F.col("_tier") == 1, 1)).alias("n_clean"), F.max(tainted).alias("_any"))
    kept = tiered.join(of_key, keys).where("_tier = _best")
    used = F.when(F.col("_best") == 1, False).when(F.col("_best") == 2, True).otherwise(F.col("_any"))
    return kept.withColumn("used_tainted", used).drop("_tier", "_best", "_any")


def vote_name(readings: DataFrame, keys: list[str], name: str = "commander", key: Column | None = None) -> DataFrame:
    """``keys, name, agreement``: vote on the name's core, shown in its most frequent spelling.

    Ties of cores go to the one read nearest the centre, of spellings to the
    first seen.  Names of symbols only vote under the empty core.
    """
    named = readings.where(F.col(name).isNotNull() & (F.col(name) != ""))
    forms = named.groupBy(*keys, name).agg(F.count("*").alias("n"), F.min(F.struct(distance().alias("d"), F.col("seq").alias("s"))).alias("k"), F.min("seq").alias("s"))
    forms = forms.withColumn("_core", key if key is not None else name_key(F.col(name)))
    cores = forms.groupBy(*keys, "_core").agg(F.sum("n").alias("n"), F.min("k").alias("k"), F.min(F.struct((-F.col("n")).alias("m"), "s", F.col(name).alias("v"))).alias("f"))
    out = cores.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), "k", F.col("f.v").alias("v"))).alias("b"), F.sum("n").alias("all"))
    return out.select(*keys, F.col("b.v").alias(name), F.bround(-F.col("b.m") / F.col("all"), 3).alias("agreement"))


def partners(cores: list[str]) -> dict[str, list[str]]:
    """For each core those alike to it, itself included.

    Likeness is asked for only where its bounds, by length and by letters in
    common, allow it; the matcher keeps what it knows of its second text.
    """
    out: dict[str, list[str]] = {a: [] for a in cores}
    letters = {a: Counter(a) for a in out}
    for b in out:
        matcher = SequenceMatcher(None, "", b)
        for a in out:
            least = ALIKE * (len(a) + len(b)) / 2
            if a == b:
                out[a].append(b)
            elif min(len(a), len(b)) >= least and (letters[a] & letters[b]).total() >= least:
                matcher.set_seq1(a)
                if matcher.ratio() >= ALIKE:
                    out[a].append(b)
    return out


def similar_name(names: list[str], cores: list[str], counts: list[int], nearest: list[tuple]) -> tuple[str, float]:
    """The spelling with the most alike readings, shown as nearest the centre among them, and their share.

    Spellings come in the order first seen; ``nearest`` is (distance, arrival) of each one's best reading.
    """
    alike = partners(cores)
    groups = [[j for j, b in enumerate(cores) if b in alike[a]] for a in cores]
    votes = [sum(counts[j] for j in g) for g in groups]
    won = votes.index(max(votes))
    best = min(groups[won], key=lambda j: nearest[j])
    return names[best], round(votes[won] / sum(counts), 3)


@F.pandas_udf(T.StructType([T.StructField("name", T.StringType()), T.StructField("agreement", T.DoubleType())]))
def _settle(forms: pd.Series) -> pd.DataFrame:
    out = []
    for rows in forms:
        rows = sorted(rows, key=lambda r: r["s"])
        out.append(similar_name([r["name"] for r in rows], [r["core"] for r in rows], [r["n"] for r in rows], [(r["d"], r["s"]) for r in rows]))
    return pd.DataFrame(out, columns=["name", "agreement"])


def vote_name_similar(readings: DataFrame, keys: list[str], name: str = "commander") -> DataFrame:
    """``vote_name``, and for keys on which at most half agree a vote by similarity.

    Readings are counted by spelling before the shuffle; only the distinct
    spellings of the keys in doubt, one array a key, go to Python.
    """
    plain = vote_name(readings, keys, name)
    unsure = plain.where(F.col("agreement") <= FALLBACK).select(*keys)
    rows = readings.where(F.col(name).isNotNull() & (F.col(name) != "")).join(unsure, keys, "left_semi")
    near = F.min(F.struct(distance().alias("d"), F.col("seq").alias("s")))
    forms = rows.groupBy(*keys, name).agg(F.count("*").alias("n"), near.alias("k"), F.min("seq").alias("s")).withColumn("core", name_key(F.col(name)))
    packed = forms.groupBy(*keys).agg(F.collect_list(F.struct(F.col(name).alias("name"), "core", "n", F.col("k.d").alias("d"), "s")).alias("f"))
    settled = packed.withColumn("b", _settle("f")).select(*keys, F.col("b.name").alias(name), F.col("b.agreement").alias("agreement"))
    return plain.join(unsure, keys, "left_anti").unionByName(settled)


def merge_readings(readings: DataFrame, keys: list[str]) -> DataFrame:
    """One record for each key with its diagnostics.

    ``readings`` have ``commander, alliance, server, points, y, seq, complete,
    tainted, name_unreadable``.  A null server votes (it is home).  Where no
    name could be read but a row was seen, the name is a fixed text.

    Readings that agree in everything are counted as one before the first
    shuffle, so a key with a third of all readings is spread over what was
    read of it; these counts are brought together by key in the second, where
    all fields vote without another.
    """
    complete, tainted = F.coalesce("complete", F.lit(False)), F.coalesce("tainted", F.lit(False))
    tier = F.when(complete & ~tainted, 1).when(complete, 2).otherwise(3)
    values = ["points", "alliance", "commander", "server"]
    marked = readings.select(*keys, *values, tier.alias("tier"), tainted.alias("t"), F.coalesce("name_unreadable", F.lit(False)).alias("u"), distance().alias("d"), "seq")
    alike = marked.groupBy(*keys, *values, "tier").agg(F.count("*").alias("n"), F.min(F.struct("d", F.col("seq").alias("s"))).alias("k"), F.min("seq").alias("s"), F.max("t").alias("t"), F.max("u").alias("u"))
    has = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    told = lambda f, v, ok, d: F.when(ok, F.struct(F.lit(f).alias("f"), v.cast("string").alias("v"), F.struct(d.alias("d"), (F.col("k.s") if f in values[:3] else F.col("s")).alias("s")).alias("k")))
    fields = [told(c, F.col(c), has(c), F.col("k.d")) for c in values[:3]]
    fields += [told("server", F.col("server"), F.lit(True), F.lit(0.0)), told("row", F.lit(None), F.lit(True), F.lit(0.0))]
    spread = alike.repartition(*keys).select(*keys, "tier", "n", "s", "t", "u", F.explode(F.filter(F.array(*fields), lambda x: x.isNotNull())).alias("x"))
    counted = spread.groupBy(*keys, "x.f", "x.v", "tier").agg(F.sum("n").alias("n"), F.min("x.k").alias("k"), F.min("s").alias("s"), F.max("t").alias("t"), F.max("u").alias("u"))
    counted = counted.withColumn("core", F.when(F.col("f") == "commander", name_key(F.when(F.col("f") == "commander", F.col("v")))).otherwise(F.col("v")))
    of_key, rows = Window.partitionBy(*keys), F.when(F.col("f") == "row", F.col("n"))
    pooled = counted.withColumn("best", F.min("tier").over(of_key)).withColumn("n_obs", F.sum(rows).over(of_key)).withColumn("n_clean", F.coalesce(F.sum(F.when(F.col("tier") == 1, rows)).over(of_key), F.lit(0))).where("tier = best")
    pool = durable(pooled)
    voted = pool.groupBy(*keys, "n_obs", "n_clean", "best", "f", "core").agg(F.sum("n").alias("n"), F.min("k").alias("k"), F.min(F.struct((-F.col("n")).alias("m"), "s", "v")).alias("form"), F.max("t").alias("t"), F.max("u").alias("u"))
    names = ("points", "alliance", "commander", "server")
    best = [F.min(F.when(F.col("f") == c, F.struct((-F.col("n")).alias("m"), "k", F.col("form.v").alias("v")))).alias(f"b_{c}") for c in names]
    total = [F.sum(F.when(F.col("f") == c, F.col("n"))).alias(f"n_{c}") for c in names]
    one = voted.groupBy(*keys, "n_obs", "n_clean", "best").agg(*best, *total, F.max("t").alias("t"), F.max("u").alias("name_unreadable"))
    share = lambda c: F.coalesce(F.bround(-F.col(f"b_{c}.m") / F.col(f"n_{c}"), 3), F.lit(0.0))
    one = durable(one.withColumn("sure", share("commander")))
    forms = pool.where("f = 'commander'").join(one.where((F.col("n_commander") > 0) & (F.col("sure") <= FALLBACK)).select(*keys), keys, "left_semi")
    packed = forms.groupBy(*keys).agg(F.collect_list(F.struct(F.col("v").alias("name"), "core", "n", F.col("k.d").alias("d"), "s")).alias("_f"))
    settled = packed.withColumn("_b", _settle("_f")).select(*keys, "_b")
    out = one.join(settled, keys, "left")
    lost = F.col("b_commander").isNull() & F.col("name_unreadable")
    used = F.when(F.col("best") == 1, False).when(F.col("best") == 2, True).otherwise(F.col("t"))
    name = F.coalesce("_b.name", "b_commander.v", F.lit(""))
    return out.select(
        *keys, F.when(lost, F.lit(UNREADABLE)).otherwise(name).alias("commander"), F.coalesce("b_alliance.v", F.lit("")).alias("alliance"), F.col("b_server.v").alias("server"), F.col("b_points.v").cast("bigint").alias("points"),
        "n_obs", "n_clean", used.alias("used_tainted"), "name_unreadable", share("points").alias("points_agreement"),
        F.when(lost, F.lit(1.0)).otherwise(F.coalesce("_b.agreement", "sure")).alias("commander_agreement"), share("alliance").alias("alliance_agreement"),
    )


def keep_best(readings: DataFrame, keys: list[str], score: Column, fields: list[str]) -> DataFrame:
    """The reading of the highest score (the earliest on ties), its missing fields filled from the best reading that has them."""
    out = [F.max(F.when(F.col(f).isNotNull() & (F.col(f).cast("string") != ""), F.struct(score.alias("q"), (-F.col("seq")).alias("s"), F.col(f).alias("v")))).alias(f"_{f}") for f in fields]
    best = readings.groupBy(*keys).agg(F.max(score).alias("score"), *out)
    return best.select(*keys, "score", *[F.col(f"_{f}.v").alias(f) for f in fields])


