"""Joining an earlier snapshot of a list to a later one."""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.text import name_key, nfkc_fold
from podium.operators import frames, vote
from podium.operators.clean import near_looks
from podium.session import durable

#: Most edits between an early name and a later one, fixed value.
NEAR = 2


def _disagreement(a: dict, b: dict) -> int:
    """0 if two rows agree in server and alliance, 1 if not in alliance, 2 and more if not in server."""
    return 2 * (a["server"] != b["server"]) + (a["group"] != b["group"])


def pair_players(early: list[dict], later: list[dict], home: str) -> dict[int, int]:
    """Positions in ``early`` and ``later`` of the same players, each used once.

    Rows of equal name keys are paired key by key, each early row with the
    later one it disagrees with least.  A missing server means home; its number
    is the one most pairs of such rows give (first met on ties), else ``home``.
    Rows left over are paired with a name up to two edits away in the same
    server and alliance, if it is the only one and the name itself does not
    occur later.
    """
    bags: dict[str, list[int]] = defaultdict(list)
    for i, row in enumerate(later):
        bags[row["key"]].append(i)
    known, pairs, homes = set(bags), {}, []
    for n, row in enumerate(early):
        bag = bags.get(row["key"])
        if bag:
            pairs[n] = bag.pop(min(range(len(bag)), key=lambda k: _disagreement(row, later[bag[k]])))
            homes += [later[pairs[n]]["server"]] * (not row["server"])
    if homes:
        home = Counter(homes).most_common(1)[0][0]
    place = lambda row: (row["server"] or home, row["group"])
    rest: dict[tuple, list[int]] = defaultdict(list)
    for i in sorted(i for bag in bags.values() for i in bag):
        rest[place(later[i])].append(i)
    for n, row in enumerate(early):
        if n not in pairs and row["key"] and row["key"] not in known:
            near = [i for i in rest[place(row)] if within(row["key"], later[i]["key"], NEAR)]
            if len(near) == 1:
                pairs[n] = near[0]
                rest[place(row)].remove(near[0])
    return pairs


def within(a: str, b: str, limit: int) -> bool:
    """Whether two strings are at most ``limit`` edits apart."""
    if abs(len(a) - len(b)) > limit:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1] <= limit


def match_early(early: DataFrame, later: DataFrame, group: str = "event_id", home: str = "117") -> DataFrame:
    """``group, early_rank, later_pos``: pairs of each group's early and later rows, by the rules of ``pair_players``.

    Rows of a key that stands once on either side meet by joins alone.  Only
    keys repeated on both sides go through Python, key by key, and after them,
    group by group, the few pairs of left-over rows with near names, because
    there an earlier choice bars a later one.  Near names are found by their
    delete keys within server and alliance, never row by row.  Empty tables
    and null attributes are allowed; a null rank or pos pairs with nothing.
    """
    def side(df: DataFrame, order: str, s: str) -> DataFrame:
        server = F.regexp_replace(F.coalesce("server", F.lit("")), "^[Ss]+", "")
        label = nfkc_fold(F.regexp_replace(F.coalesce("alliance", F.lit("")), r"(?U)\s", ""))
        return df.where(F.col(order).isNotNull()).select(F.col(group).alias("g"), F.col(order).cast("bigint").alias(f"o_{s}"), name_key(F.col("commander")).alias("key"), server.alias(f"server_{s}"), label.alias(f"label_{s}"))

    kind = dict(early.dtypes)[group]
    left, right = durable(side(early, "rank", "a")), durable(side(later, "pos", "b"))
    many = left.groupBy("g", "key").agg(F.count("*").alias("n_a")).join(right.groupBy("g", "key").agg(F.count("*").alias("n_b")), ["g", "key"])
    twice = many.where("n_a > 1 and n_b > 1").select("g", "key")
    met = left.join(many.where("n_a = 1 or n_b = 1").select("g", "key"), ["g", "key"]).join(right, ["g", "key"])
    least = F.struct((2 * (F.col("server_a") != F.col("server_b")).cast("int") + (F.col("label_a") != F.col("label_b")).cast("int")).alias("d"), "o_b", "server_b")
    # One early row takes the later one it disagrees with least; of several early rows the first takes the only later one.
    chosen = met.groupBy("g", "key", "o_a", "server_a").agg(F.min(least).alias("c"))
    first = F.row_number().over(Window.partitionBy("g", "key", "c.o_b").orderBy("o_a"))
    single = chosen.withColumn("n", first).where("n = 1").select("g", "o_a", "c.o_b", "server_a", "c.server_b")

    def repeated(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = [d.rename(columns=lambda c: {"server_a": "server", "server_b": "server", "label_a": "group", "label_b": "group"}.get(c, c)).sort_values(o).to_dict("records") for d, o in ((a, "o_a"), (b, "o_b"))]
        found = pair_players(*rows, home)
        return pd.DataFrame([(key[0], rows[0][n]["o_a"], rows[1][i]["o_b"], rows[0][n]["server"], rows[1][i]["server"]) for n, i in found.items()], columns=["g", "o_a", "o_b", "server_a", "server_b"])

    of = lambda df: df.join(twice, ["g", "key"], "left_semi").groupBy("g", "key")
    greedy = of(left).cogroup(of(right)).applyInPandas(repeated, f"g {kind}, o_a bigint, o_b bigint, server_a string, server_b string")
    exact = durable(single.unionByName(greedy))
    votes = exact.where("server_a = ''").groupBy("g", "server_b").agg(F.count("*").alias("n"), F.min("o_a").alias("o"))
    homes = votes.groupBy("g").agg(F.min(F.struct((-F.col("n")).alias("m"), "o", F.col("server_b").alias("v"))).alias("h")).select("g", F.col("h.v").alias("home"))
    place = lambda df, s: df.join(homes, "g", "left").withColumn("place", F.when(F.col(f"server_{s}") != "", F.col(f"server_{s}")).otherwise(F.coalesce("home", F.lit(home)))).drop("home")
    free_a = place(left.where("key <> ''").join(right.select("g", "key").distinct(), ["g", "key"], "left_anti").join(exact.select("g", "o_a"), ["g", "o_a"], "left_anti"), "a").select("g", "place", F.col("label_a").alias("label"), "o_a", F.col("key").alias("_look"))
    free_b = place(right.join(exact.select("g", "o_b"), ["g", "o_b"], "left_anti"), "b").select("g", "place", F.col("label_b").alias("label"), "o_b", F.col("key").alias("_known_look"))
    on = ["g", "place", "label"]
    free_b = free_b.join(free_a.select(*on).distinct(), on, "left_semi")
    offers = near_looks(free_a, free_b, on, NEAR).join(free_a, [*on, "_look"]).join(free_b, [*on, "_known_look"]).select("g", "o_a", "o_b")

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for o_a, offered in pdf.sort_values(["o_a", "o_b"]).groupby("o_a", sort=True).o_b:
            left_over = [o for o in offered if o not in used]
            if len(left_over) == 1:
                used.add(left_over[0])
                out.append((key[0], o_a, left_over[0]))
        return pd.DataFrame(out, columns=["g", "o_a", "o_b"])

    near = offers.groupBy("g").applyInPandas(settle, f"g {kind}, o_a bigint, o_b bigint")
    return exact.select("g", "o_a", "o_b").unionByName(near).select(F.col("g").alias(group), F.col("o_a").cast("int").alias("early_rank"), F.col("o_b").alias("later_pos"))


def clean_cutoff(early: DataFrame, later: DataFrame, matches: DataFrame, group: str = "event_id") -> DataFrame:
    """``group, cutoff``: the last early rank r such that ranks 1..r are there with points, and every later row that
    is not one of these players has no more points than rank r; 0 if there is none.

    A later row counts against all ranks before that of its early partner, so
    the most points against r is a maximum over the rows with greater partner
    ranks: a running maximum from below, not a comparison of all with all.
    """
    partner = matches.select(group, F.col("later_pos").alias("pos"), F.col("early_rank").cast("bigint").alias("partner"))
    against = later.where("points is not null").join(partner, [group, "pos"], "left").select(group, F.coalesce("partner", F.lit(1 << 62)).alias("at"), F.col("points").alias("p"), F.lit(None).cast("bigint").alias("own"))
    per = Window.partitionBy(group).orderBy("rank")
    fine = early.withColumn("_n", F.row_number().over(per)).withColumn("_ok", (F.col("rank") == F.col("_n")) & F.col("points").isNotNull())
    fine = fine.withColumn("_all", F.min("_ok").over(per)).where("_all")
    own = fine.select(group, F.col("rank").cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("p"), F.col("points").cast("bigint").alias("own"))
    below = Window.partitionBy(group).orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    both = own.unionByName(against).withColumn("most", F.max("p").over(below))
    good = both.where("own is not null and (most is null or most <= own)").groupBy(group).agg(F.max("at").alias("cutoff"))
    return early.select(group).distinct().join(good, group, "left").select(group, F.coalesce("cutoff", F.lit(0)).cast("int").alias("cutoff"))


def merge_early(early: DataFrame, later: DataFrame, matches: DataFrame, cutoffs: DataFrame, group: str = "event_id") -> DataFrame:
    """The merged list: early ranks and points up to the cutoff with the later identity, then the other later rows in
    their order, renumbered.  ``passed`` marks those of the latter with more points than the cutoff's.

    A prefix row without a partner is an error, raised when its row is read.
    """
    prefix = early.join(cutoffs, group).where("rank <= cutoff").select(group, F.col("rank").alias("early_rank"), F.col("points").alias("early_points"), "cutoff")
    partner = matches.select(group, "early_rank", "later_pos")
    held = prefix.join(partner, [group, "early_rank"], "left")
    held = held.withColumn("later_pos", F.when(F.col("later_pos").isNull(), F.raise_error(F.concat(F.lit("early rank without a later row: "), F.col("early_rank").cast("string"))).cast("bigint")).otherwise(F.col("later_pos")))
    last = prefix.where("early_rank = cutoff").select(group, F.col("early_points").alias("cutoff_points"))
    marked = later.join(held.select(group, F.col("later_pos").alias("pos"), "early_rank", "early_points"), [group, "pos"], "left").join(last, group, "left")
    order = Window.partitionBy(group).orderBy(F.col("early_rank").isNull(), "early_rank", "pos")
    return marked.select(
        group, F.row_number().over(order).alias("rank"), "commander", "alliance", "server", F.coalesce("early_points", "points").alias("points"), F.col("rank").alias("later_rank"),
        F.coalesce(F.col("early_rank").isNull() & (F.col("points") > F.col("cutoff_points")), F.lit(False)).alias("passed"),
    )


def parse_early(boxes: DataFrame, frames_of: DataFrame, group: str = "event_id") -> DataFrame:
    """The list of each group from screens of any size: boxes fitted to the usual screen, parsed and voted.

    ``frames_of`` (frame, group, frame_no) tells whose screens they are and in
    which order they were taken.  Screens are read one by one, without a rank
    known before.
    """
    parsed = frames.parse_frames(frames.fit_screen(boxes)).join(frames_of.select("frame", group, "frame_no"), "frame")
    return vote.merge_readings(parsed.withColumn("seq", F.struct("frame_no", "rank")), [group, "rank"])
