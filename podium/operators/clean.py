"""Cleaning of alliance labels and checking of names against earlier events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.text import (
    NO_ALLIANCE, UNREADABLE, brackets, casefold, confusable_key, display, fused_forms, label_key, label_name, label_tag,
    name_key, normal_label, server_code, stripped, tag_confusable, without_server,
)

from podium.session import durable

#: Largest table of manual corrections that is sent to every worker.
MAX_CORRECTIONS = 100_000


def corrections_table(spark, corrections: DataFrame | dict[str, str] | None) -> DataFrame:
    """``before, after`` of manual corrections, each ``before`` once; raises beyond MAX_CORRECTIONS rows.

    Rows with a null on either side are left out; of two corrections of one
    value the greater counts.  Its size is proven, so it may be broadcast.
    """
    if not isinstance(corrections, DataFrame):
        corrections = spark.createDataFrame(sorted((corrections or {}).items()), "before string, after string")
    once = corrections.where("before is not null and after is not null").groupBy("before").agg(F.max("after").alias("after"))
    if once.limit(MAX_CORRECTIONS + 1).count() > MAX_CORRECTIONS:
        raise ValueError(f"more than {MAX_CORRECTIONS} corrections")
    return once


def corrected(rows: DataFrame, column: str, corrections: DataFrame, into: str) -> DataFrame:
    """``rows`` with ``into``: what ``corrections`` (before, after) make of ``column``, null where they know nothing of it."""
    fixes = F.broadcast(corrections.select(F.col("before").alias("_before"), F.col("after").alias(into)))
    return rows.join(fixes, F.col(column) == F.col("_before"), "left").drop("_before")


def same_name_tag_variant(a: Column, b: Column) -> Column:
    """Whether two labels have the same name, without regard to case, and tags that may be readings of one."""
    tag_a, tag_b = label_tag(a), label_tag(b)
    alike = tag_confusable(tag_a, tag_b, confusable_key(tag_a), confusable_key(tag_b), fused_forms(tag_a), fused_forms(tag_b))
    return (tag_a != "") & (tag_b != "") & (casefold(label_name(a)) == casefold(label_name(b))) & alike


def safe_corrections(corrections: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The corrections that need no evidence of the event at hand.

    Left out are those that change only a tag into a look-alike one, and those
    of a label without a whole tag whose result is not among the ``known``
    labels.
    """
    bare = ~F.col("before").rlike(r"^\[[^]]+\]")
    listed = known.select(F.col("label").alias("after")).distinct().withColumn("_known", F.lit(True)) if known is not None else None
    rows = corrections.join(listed, "after", "left") if listed is not None else corrections.withColumn("_known", F.lit(None).cast("boolean"))
    return rows.where(~same_name_tag_variant(F.col("before"), F.col("after")) & (~bare | F.coalesce("_known", F.lit(False)))).select("before", "after")


def clean_players(players: DataFrame, home: str, corrections: DataFrame | dict[str, str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """Rows with ``alliance, alliance_tag, alliance_name, server`` in clean form; other columns stay.

    The server is the given one, else that at the end of the label, else
    ``home``; server marks are taken off the label; ``corrections`` apply to
    whole labels as far as they are safe (see ``safe_corrections``; ``known``
    are the labels of earlier events).
    """
    label = brackets(stripped(F.coalesce("alliance", F.lit(""))))
    rows = players.withColumn("server", server_code(F.col("server"), label, home)).withColumn("_l", without_server(label))
    fixes = safe_corrections(corrections_table(players.sparkSession, corrections), known)
    rows = corrected(rows, "_l", fixes, "_fix").withColumn("_l", F.coalesce("_fix", "_l")).drop("_fix")
    rows = rows.withColumn("alliance_tag", label_tag(F.col("_l"))).withColumn("alliance_name", label_name(F.col("_l")))
    return rows.withColumn("alliance", display(F.col("alliance_tag"), F.col("alliance_name"))).drop("_l")


def consolidate_labels(players: DataFrame, group: list[str]) -> DataFrame:
    """``group, variant, canonical, n``: labels that differ by look-alike characters, and the most frequent of them.

    Ties go to the label met first.  Players without an alliance are no group.
    """
    labels = players.where(F.col("alliance").isNotNull() & (F.col("alliance") != NO_ALLIANCE)).groupBy(*group, "alliance").agg(F.count("*").alias("n"), F.min("pos").alias("p")).withColumn("_k", label_key(F.col("alliance")))
    best = F.first("alliance").over(Window.partitionBy(*group, "_k").orderBy(F.desc("n"), "p"))
    return labels.withColumn("canonical", best).where("alliance <> canonical").select(*group, F.col("alliance").alias("variant"), "canonical", "n")


def known_labels(earlier: DataFrame) -> DataFrame:
    """The distinct labels of earlier events in display form."""
    return earlier.select(normal_label(F.col("alliance")).alias("label")).distinct()


def known_names(earlier: DataFrame, key: Column | None = None) -> DataFrame:
    """``server, name_key, commander, n_spellings``: each known player with the most frequent spelling, first seen on ties."""
    keyed = earlier.where(F.col("commander").isNotNull() & (F.col("commander") != UNREADABLE)).select("server", "commander", "pos", (name_key(F.col("commander")) if key is None else key).alias("name_key")).where("name_key <> ''")
    forms = keyed.groupBy("server", "name_key", "commander").agg(F.count("*").alias("n"), F.min("pos").alias("p"))
    best = F.min(F.struct((-F.col("n")).alias("m"), "p", F.col("commander").alias("v")))
    return forms.groupBy("server", "name_key").agg(best.alias("b"), F.count("*").alias("n_spellings")).select("server", "name_key", F.col("b.v").alias("commander"), "n_spellings")


def known_name_labels(earlier: DataFrame, key: Column | None = None) -> DataFrame:
    """``server, name_key, alliance``: the labels each known player was seen with."""
    keyed = earlier.where(F.col("commander").isNotNull() & (F.col("commander") != UNREADABLE)).select("server", (name_key(F.col("commander")) if key is None else key).alias("name_key"), "alliance")
    return keyed.where("name_key <> '' and alliance is not null").distinct()


def label_repairs(players: DataFrame, known: DataFrame, corrections: DataFrame | dict[str, str] | None = None, most: int = 2, group: list[str] = []) -> DataFrame:
    """What to do with each label of an event: ``group, alliance, after, reason, reviews``.

    A correction wins.  A label without a tag that ends in a known name behind
    what may be a misread bracket is repaired if one known label fits.  A label
    whose tag may be a misreading of one known label of the same name is
    repaired if it stands at most ``most`` times; else the known labels are
    listed for review.  Candidates are joined on the case-folded name, and for
    broken brackets on the last words of the label, never label by label.
    ``group`` are columns that tell events apart; ``known`` holds for all.
    """
    counted = players.groupBy(*group, "alliance").agg(F.count("*").alias("n_rows"))
    fixed = corrected(counted, "alliance", corrections_table(players.sparkSession, corrections), "_fix")
    seen = fixed.select(*group, "alliance", "n_rows", F.coalesce("_fix", normal_label(F.col("alliance"))).alias("label"), F.col("_fix").isNotNull().alias("manual"))

    def parted(labels: DataFrame) -> DataFrame:
        parts = labels.withColumn("tag", label_tag(F.col("label"))).withColumn("name", label_name(F.col("label")))
        return parts.withColumn("fold", casefold("name")).withColumn("key", confusable_key(F.col("tag"))).withColumn("fused", fused_forms(F.col("tag")))

    seen = durable(seen)
    mine = durable(parted(seen.groupBy(*group, "label").agg(F.sum("n_rows").alias("count_now"))))
    pick = lambda df, s: df.where("tag <> ''").select(*[F.col(c).alias(f"{c}_{s}") for c in df.columns])
    a, b, prior = pick(mine, "a"), pick(mine, "b"), pick(parted(known.select("label").distinct()), "b")
    alike = tag_confusable(F.col("tag_a"), F.col("tag_b"), F.col("key_a"), F.col("key_b"), F.col("fused_a"), F.col("fused_b"))
    one_event = [F.col(f"{g}_a") == F.col(f"{g}_b") for g in group]
    fit = [*[F.col(f"{g}_a").alias(g) for g in group], "label_a", "label_b"]
    tagged = [
        a.join(prior, F.col("fold_a") == F.col("fold_b")).where((F.col("label_a") != F.col("label_b")) & alike),
        a.join(b, [F.col("fold_a") == F.col("fold_b"), *one_event]).where((F.col("label_a") != F.col("label_b")) & (F.col("count_now_b") > F.col("count_now_a")) & alike),
    ]
    # Labels without a tag: every ending that begins a word is looked up as a known name.
    words = F.split(F.col("label"), " ")
    ends = mine.where("tag = ''").select(*group, "label", F.posexplode(F.transform(F.sequence(F.lit(2), F.greatest(F.size(words), F.lit(2))), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))).alias("i", "ending")).where("ending <> ''")
    ends = ends.withColumn("prefix", stripped(F.expr("substring(label, 1, length(label) - length(ending))"))).withColumn("ending_fold", casefold("ending"))
    ends = ends.where((F.length("prefix") >= 2) & F.substring("prefix", 1, 1).isin(*"[UIJ1") & F.expr("right(prefix, 1)").isin(*"]UIJ1"))
    ends = ends.withColumn("tag_a", F.expr("substring(prefix, 2, length(prefix) - 2)")).select(*[F.col(g).alias(f"{g}_a") for g in group], F.col("label").alias("label_a"), "tag_a", F.col("ending_fold").alias("fold_a"))
    ends = ends.withColumn("key_a", confusable_key(F.col("tag_a"))).withColumn("fused_a", fused_forms(F.col("tag_a")))
    broken = [ends.join(prior, F.col("fold_a") == F.col("fold_b")).where(alike), ends.join(b, [F.col("fold_a") == F.col("fold_b"), *one_event]).where(alike)]
    offers = [df.select(*fit, (F.col("count_now_a") <= most).alias("may"), F.lit("known alliance").alias("reason")) for df in tagged] + [df.select(*fit, F.lit(True).alias("may"), F.lit("bracket repair").alias("reason")) for df in broken]
    decided = reduce(DataFrame.unionByName, offers).groupBy(*group, F.col("label_a").alias("label")).agg(F.sort_array(F.collect_set("label_b")).alias("c"), F.max("may").alias("may"), F.max("reason").alias("why"))
    joined = seen.join(decided, [*group, "label"], "left")
    repair = ~F.col("manual") & F.coalesce((F.size("c") == 1) & F.col("may"), F.lit(False))
    after = F.when(repair, F.col("c")[0]).otherwise(F.col("label"))
    reason = F.when(F.col("manual"), "manual override").when(repair, F.col("why")).otherwise("known alliance")
    reviews = F.when(~F.col("manual") & ~repair & F.col("c").isNotNull(), F.col("c")).otherwise(F.array().cast("array<string>"))
    return joined.select(*group, "alliance", after.alias("after"), reason.alias("reason"), reviews.alias("reviews"))


def apply_repairs(players: DataFrame, repairs: DataFrame, group: list[str] = []) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cleaned players, changes, reviews) from ``label_repairs`` of the same ``group``."""
    told = repairs.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("alliance").alias("_a"), "after", "reason", "reviews")
    same = F.col("alliance").eqNullSafe(F.col("_a"))
    for g in group:
        same = same & (F.col(g) == F.col(f"_{g}"))
    joined = durable(players.join(told, same, "left").drop("_a", *[f"_{g}" for g in group]))
    cleaned = joined.withColumn("alliance", F.coalesce("after", "alliance")).withColumn("alliance_tag", label_tag(F.col("alliance"))).withColumn("alliance_name", label_name(F.col("alliance"))).drop("after", "reason", "reviews")
    changes = joined.where(~F.col("alliance").eqNullSafe(F.col("after"))).select(*group, "rank", F.lit("alliance").alias("field"), F.col("alliance").alias("before"), "after", "reason")
    reviews = joined.select(*group, "rank", F.coalesce("server", F.lit("")).alias("server"), F.col("after").alias("observed"), F.explode("reviews").alias("known"))
    name = F.when(label_tag(F.col("observed")) != "", label_name(F.col("observed"))).otherwise(F.col("observed"))
    return cleaned, changes, reviews.withColumn("alliance", name)


def name_overrides(players: DataFrame, overrides: DataFrame) -> DataFrame:
    """Players with names replaced by ``overrides`` (server, observed, canonical); ``overridden`` tells which."""
    fixes = overrides.where("server is not null and observed is not null").groupBy("server", "observed").agg(F.max("canonical").alias("canonical"))
    joined = players.join(fixes, (players.server == fixes.server) & (players.commander == fixes.observed), "left").select(*[players[c] for c in players.columns], fixes.canonical)
    return joined.withColumn("overridden", F.col("canonical").isNotNull()).withColumn("commander", F.coalesce("canonical", "commander")).drop("canonical")


def delete_keys(text: Column, limit: int) -> Column:
    """``text`` and what is left of it without up to ``limit`` letters: texts within ``limit`` edits share one of these."""
    without = lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
    out = level = F.array(text)
    for _ in range(limit):
        level = F.array_distinct(F.flatten(F.transform(level, without)))
        out = F.array_union(out, level)
    return out


def near_looks(left: DataFrame, right: DataFrame, on: list[str], limit: int) -> DataFrame:
    """``on, _look, _known_look`` of the looks of both sides at most ``limit`` edits apart.

    Each distinct look is spread over its delete keys, which are hashed with
    ``on``; only hashes are spread and meet, so a large group of ``on`` is
    spread too and nothing is compared with all others.  The looks of a pair
    are fetched and compared afterwards.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # rows grow many times over here, so they are not put together for their size before
    named = lambda df, look, i: df.select(*on, look).where(F.col(look).isNotNull()).distinct().withColumn(i, F.xxhash64(*on, look))
    a, b = durable(named(left, "_look", "_i")), durable(named(right, "_known_look", "_j"))
    keyed = lambda df, look, i: df.repartition(tasks, i).select(i, F.explode(F.transform(delete_keys(F.col(look), limit), lambda k: F.xxhash64(*on, k))).alias("_key"))
    pairs = keyed(a, "_look", "_i").join(keyed(b, "_known_look", "_j"), "_key").select("_i", "_j").distinct()
    met = pairs.join(a, "_i").join(b.select("_j", "_known_look", *[F.col(c).alias(f"_{c}") for c in on]), "_j")
    same = F.lit(True)
    for c in on:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return met.where(same & F.levenshtein("_look", "_known_look", limit).between(0, limit)).select(*on, "_look", "_known_look")


def name_candidates(players: DataFrame, known: DataFrame, known_with: DataFrame, key: Column | None = None, look: Column | None = None, limit: int = 1, group: list[str] = []) -> DataFrame:
    """``group, rank, server, observed, known, alliance``: known names within ``limit`` edits of an unknown one.

    Blocked by server and an alliance the known player was seen with; names
    already on the list are no candidates.  ``group`` are columns that tell
    several lists of players apart.  Only reported, never applied.
    """
    keyed = players.where(F.col("commander").isNotNull() & (F.col("commander") != UNREADABLE)).withColumn("name_key", name_key(F.col("commander")) if key is None else key).where("name_key <> ''")
    new = keyed.join(known.select("server", "name_key"), ["server", "name_key"], "left_anti").withColumn("_look", confusable_key(F.col("commander")) if look is None else look)
    free = known.join(known_with, ["server", "name_key"]).withColumn("_known_look", confusable_key(F.col("commander")) if look is None else look)
    on = ["server", "alliance"]
    new = new.select(*group, "rank", *on, F.col("commander").alias("observed"), "_look")
    free = free.select(*on, F.col("commander").alias("known"), "name_key", "_known_look")
    found = new.join(near_looks(new, free, on, limit), [*on, "_look"]).join(free, [*on, "_known_look"]).select(*group, "rank", *on, "observed", "known", "name_key").distinct()
    return found.join(keyed.select(*group, "server", "name_key").distinct(), [*group, "server", "name_key"], "left_anti").select(*group, "rank", "server", "observed", "known", "alliance").distinct()


def decide_names(players: DataFrame, known: DataFrame, known_with: DataFrame, overrides: DataFrame, group: list[str] = []) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(players with overridden names, changes, reviews): overrides are applied, near names of others only reported.

    Names that are on the list before anything is renamed are no candidates.
    A null or empty name is neither overridden nor reported.
    """
    named = name_overrides(players.withColumn("_before", F.col("commander")), overrides)
    changes = named.where("overridden and commander <> _before").select(*group, "rank", F.lit("commander").alias("field"), F.col("_before").alias("before"), F.col("commander").alias("after"), F.lit("manual override").alias("reason"))
    found = name_candidates(players, known, known_with, group=group)
    given = named.where("overridden").select(*group, "rank", F.col("_before").alias("observed")).distinct()
    reviews = found.join(given, [*group, "rank", "observed"], "left_anti")
    return named.drop("_before", "overridden"), changes, reviews


def clean_batch(players: DataFrame, home: str, known_labels: DataFrame, known: DataFrame, known_with: DataFrame, corrections=None, label_overrides=None, overrides: DataFrame | None = None, group: list[str] = []) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows cleaned, labels repaired, names decided: (players, changes, reviews).

    ``changes`` have ``group, rank, field, before, after, reason``; ``reviews``
    ``group, rank, field, server, observed, known, alliance``.  ``known_labels``
    (label), ``known`` and ``known_with`` (see ``known_names``) come from
    earlier lists.
    """
    rows = durable(clean_players(players, home, corrections, known_labels))
    repaired, changes, reviews = apply_repairs(rows, label_repairs(rows, known_labels, label_overrides, group=group), group)
    if overrides is None:
        overrides = players.sparkSession.createDataFrame([], "server string, observed string, canonical string")
    named, renamed, asked = decide_names(repaired, known, known_with, overrides, group)
    columns = [*group, "rank", "field", "server", "observed", "known", "alliance"]
    both = reviews.withColumn("field", F.lit("alliance")).select(*columns).unionByName(asked.withColumn("field", F.lit("commander")).select(*columns))
    return named, changes.unionByName(renamed), both


def running_candidates(players: DataFrame, event: str = "event_id", limit: int = 1) -> DataFrame:
    """``event, rank, server, observed, known, alliance``: what ``name_candidates`` gives for each event against all
    earlier ones, by the order of ``event``.  ``players`` have ``pos``, by which ties of spellings go to the first.

    A name is new in the first event of its key.  The most frequent spelling
    of a known player holds from one change to the next, counted by running
    sums, so no event is compared with each earlier one.
    """
    keyed = players.where(F.col("commander").isNotNull() & (F.col("commander") != UNREADABLE) & F.col(event).isNotNull()).withColumn("name_key", name_key(F.col("commander"))).where("name_key <> ''")
    player = ["server", "name_key"]
    keyed = durable(keyed.select(event, "rank", "pos", *player, "commander", "alliance"))
    firsts = keyed.groupBy(*player).agg(F.min(event).alias(event))
    new = durable(keyed.join(firsts, [event, *player], "left_semi").withColumn("_look", confusable_key(F.col("commander"))))
    forms = keyed.groupBy(*player, "commander", event).agg(F.count("*").alias("n"), F.min("pos").alias("p"))
    of_form, of_player = Window.partitionBy(*player, "commander").orderBy(event), Window.partitionBy(*player).orderBy(event)
    counted = forms.select(*player, event, F.struct((-F.sum("n").over(of_form)).alias("m"), F.min("p").over(of_form).alias("p"), F.col("commander").alias("v")).alias("b"))
    best = counted.groupBy(*player, event).agg(F.min("b").alias("b")).withColumn("v", F.min("b").over(of_player)["v"])
    changed = best.withColumn("_before", F.lag("v").over(of_player)).where("_before is null or v <> _before")
    held = changed.select(*player, F.col(event).alias("since"), F.lead(event).over(of_player).alias("until"), F.col("v").alias("known")).withColumn("_known_look", confusable_key(F.col("known")))
    seen_with = keyed.where("alliance is not null").groupBy(*player, "alliance").agg(F.min(event).alias("with_since"))
    free = held.join(seen_with, player).withColumn("since", F.greatest("since", "with_since"))
    now = F.col(f"n.{event}")
    on = ["server", "alliance"]
    new = new.select(event, "rank", *on, F.col("commander").alias("observed"), "_look")
    free = free.select(*on, "since", "until", "known", "name_key", "_known_look")
    met = new.join(near_looks(new, free, on, limit), [*on, "_look"]).alias("n").join(free.alias("k"), [*on, "_known_look"])
    near = met.where((now > F.col("k.since")) & (F.col("k.until").isNull() | (now <= F.col("k.until"))))
    found = near.select(f"n.{event}", "n.rank", "server", "n.observed", "k.known", "alliance", "k.name_key").distinct()
    return found.join(keyed.select(event, *player).distinct(), [event, *player], "left_anti").select(event, "rank", "server", "observed", "known", "alliance").distinct()


def changes_of(before: DataFrame, after: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """``key, field, before, after`` of every field that differs between two tables of the same keys."""
    pairs = before.alias("b").join(after.alias("a"), key)
    each = [F.struct(F.lit(f).alias("field"), F.col(f"b.{f}").cast("string").alias("before"), F.col(f"a.{f}").cast("string").alias("after")) for f in fields]
    return pairs.select(*key, F.explode(F.array(*each)).alias("x")).select(*key, "x.*").where(~F.col("before").eqNullSafe(F.col("after")))
