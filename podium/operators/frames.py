"""From positioned text boxes of a screen to rows of a ranked list.

Boxes have ``frame, seq, text, x, y, width, height`` (0-1, origin at the bottom
left).  A frame is a few dozen boxes, gathered in one row as an array; column
zones, banner marks and the nearest slot of each box are array expressions.
Only the greedy clustering of anchors by a running mean, in which each step
depends on the last, is a pandas UDF over those arrays.
"""

from __future__ import annotations

from statistics import median

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from podium.functions.text import nfkc, stripped

# Geometry of the list screen.
PITCH, HEADER_Y, FOOTER_Y = 0.0927, 0.865, 0.050
EDGE_TOP_Y, EDGE_BOTTOM_Y = 0.830, 0.080
BANNER_LOW, BANNER_HIGH = 0.72, 0.84
OVERLAY_LOW, OVERLAY_HIGH = 0.74, 0.81
RANK_X, MIDDLE_LOW_X, MIDDLE_HIGH_X, POINTS_X = 0.20, 0.32, 0.74, 0.73
CLUSTER, LOOK_BACK, USUAL_HEIGHT = 0.035, 25, 0.022
# Centres of the header's boxes, for fitting screens of other sizes.
HEADER_X = {"RANKINGS": 0.1434, "Rank": 0.1008, "Commander": 0.4690, "Points": 0.8540}
TITLE_Y, COLUMN_Y = 0.9760, 0.8888
LIST_TITLES = ["RANKINGS", "Commander", "Points"]
CLOSE_MARKS = ["X", "x", "×", "✕", "✖"]


@F.pandas_udf(ArrayType(DoubleType()))
def cluster_means(heights: pd.Series) -> pd.Series:
    """Means of clusters of descending ``heights``: each joins the first cluster whose mean is near, or begins one."""
    def means(values) -> list[float]:
        sums: list[float] = []
        sizes: list[int] = []
        for y in values if values is not None else ():
            for k, (total, n) in enumerate(zip(sums, sizes)):
                if abs(y - total / n) < CLUSTER:
                    sums[k], sizes[k] = total + y, n + 1
                    break
            else:
                sums.append(y)
                sizes.append(1)
        return sorted((total / n for total, n in zip(sums, sizes)), reverse=True)

    return heights.map(means)


def zones(boxes: DataFrame) -> DataFrame:
    """Each box with its clean text, ``zone`` (points, rank, middle or null) and ``number``."""
    text = stripped(nfkc(F.col("text")))
    rows = boxes.withColumn("clean", F.coalesce(text, F.lit(""))).withColumn("digits", F.regexp_replace("clean", r"(?U)[^\d]", ""))
    inside = (F.col("y") <= HEADER_Y) & (F.col("y") >= FOOTER_Y)
    ascii_digits = F.col("digits").rlike("^[0-9]+$")
    zone = (
        F.when(~inside, None)
        .when((F.col("x") > POINTS_X) & ascii_digits, "points")
        .when((F.col("x") < RANK_X) & F.col("clean").rlike("^[0-9]+$"), "rank")
        .when(F.col("x").between(MIDDLE_LOW_X, MIDDLE_HIGH_X), "middle")
    )
    number = F.when(zone == "points", F.expr("try_cast(digits as bigint)")).when(zone == "rank", F.expr("try_cast(clean as bigint)"))
    return rows.withColumn("zone", zone).withColumn("number", number)


def banner_marks(boxes: DataFrame) -> DataFrame:
    """``frame, median_height, banner_detected, is_list``: whether a notification covers part of a frame, and whether it shows the list."""
    visible = (F.col("y") > FOOTER_Y) & (F.col("y") < HEADER_Y) & (F.col("height") > 0.005)
    per = boxes.groupBy("frame").agg(F.coalesce(F.median(F.when(visible, F.col("height"))), F.lit(USUAL_HEIGHT)).alias("median_height"), F.collect_set(F.trim("text")).alias("_t"))
    rows = boxes.join(per, "frame")
    x, y, right = F.col("x"), F.col("y"), F.col("x") + F.col("width")
    spans = ((x < 0.30) & (right > 0.40)) | ((x < 0.72) & (right > 0.78))
    close = F.trim("text").isin("X", "x", "×") & (x > 0.80)
    left = (x > 0.12) & (x < 0.32) & ~F.col("text").rlike(r"(?U)\d") & y.between(0.75, 0.80)
    thin = x.between(0.32, 0.74) & (F.col("height") < 0.6 * F.col("median_height")) & y.between(0.75, 0.82)
    hit = y.between(BANNER_LOW, BANNER_HIGH) & (spans | close | left | thin)
    return rows.groupBy("frame", "median_height").agg(F.max(F.coalesce(hit, F.lit(False))).alias("banner_detected"), F.first(F.size(F.array_except(F.array(*map(F.lit, LIST_TITLES)), "_t")) == 0).alias("is_list"))


def banner_close(boxes: DataFrame) -> DataFrame:
    """The first close button of a banner in each frame: ``frame, seq, x, y``."""
    hits = boxes.where(F.trim("text").isin(*CLOSE_MARKS) & (F.col("x") > 0.78) & F.col("y").between(BANNER_LOW, BANNER_HIGH))
    return hits.groupBy("frame").agg(F.min(F.struct("seq", "x", "y")).alias("b")).select("frame", "b.*")


def _half_even(value: Column) -> Column:
    return F.rint(value).cast("int")


def _slotted(boxes: DataFrame) -> DataFrame:
    """One row of each frame: its boxes by zone, banner mark, slots, their steps from the top and the offsets its rank digits offer."""
    zoned = zones(boxes)
    packed = zoned.where("zone is not null").groupBy("frame").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y", "zone", "number", F.trim("text").alias("t")))).alias("items"))
    packed = banner_marks(boxes).select("frame", "banner_detected").join(packed, "frame", "left")
    anchors = F.filter("items", lambda i: i["zone"] != "middle")
    heights = F.transform(F.sort_array(F.transform(anchors, lambda i: F.struct((-i["y"]).alias("y"), i["seq"]))), lambda s: -s["y"])
    framed = packed.withColumn("slots", cluster_means(heights))
    framed = framed.withColumn("steps", F.transform("slots", lambda c: _half_even((F.col("slots")[0] - c) / PITCH)))
    # The slot of an anchor is the nearest; anchors were clustered around those means.
    nearest = lambda y: F.array_min(F.transform(F.col("slots"), lambda c, i: F.struct(F.abs(c - y).alias("d"), i.alias("i"))))["i"]
    return framed.withColumn("offers", F.transform(F.filter("items", lambda i: i["zone"] == "rank"), lambda i: i["number"] - F.get("steps", nearest(i["y"]))))


def _fitted(framed: DataFrame, before: DataFrame | None) -> DataFrame:
    """``framed`` with the ``offset`` of each frame, null for one without anchors."""
    framed = framed.join(before.select("frame", "prev_max_rank"), "frame", "left") if before is not None else framed.withColumn("prev_max_rank", F.lit(None).cast("int"))
    framed = framed.withColumn("offers", F.filter("offers", lambda o: F.col("prev_max_rank").isNull() | (o >= F.col("prev_max_rank") - LOOK_BACK)))
    ordered = F.sort_array("offers")
    n = F.size("offers")
    median = (F.get(ordered, ((n - 1) / 2).cast("int")) + F.get(ordered, (n / 2).cast("int"))) / 2
    offset = F.when(n > 0, _half_even(median)).otherwise(F.coalesce(F.col("prev_max_rank") + 1, F.lit(1)))
    return framed.withColumn("offset", F.when(F.size("slots") > 0, F.greatest(offset, F.lit(1))))


def frame_fits(boxes: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``frame, banner_detected, offset, n_rows`` of every frame; one without a rank or points has no offset and no rows."""
    return _fitted(_slotted(boxes), before).select("frame", "banner_detected", "offset", F.greatest(F.size("slots"), F.lit(0)).alias("n_rows"))


_BEFORE = "frame string, prev_max_rank int"


def ranks_before(boxes: DataFrame, captures: DataFrame) -> DataFrame:
    """``frame, prev_max_rank``: the greatest rank that the frames before a frame of the same capture showed.

    ``captures`` (frame, capture_id, frame_no) gives the order.  A frame's
    offset depends on the rank before it, which depends on earlier offsets, so
    each capture is a fold over its frames; only a frame's offers and steps
    take part, and the fold's state is one number.
    """
    rows = captures.select("frame", "capture_id", "frame_no").join(_slotted(boxes), "frame").select("capture_id", "frame_no", "frame", F.array_max("steps").alias("last"), F.col("offers").cast("array<bigint>").alias("offers"))

    def fold(batches):
        capture, best = None, None
        for pdf in batches:
            out = []
            for key, frame, last, offers in zip(pdf.capture_id, pdf.frame, pdf["last"], pdf.offers):
                if key != capture:
                    capture, best = key, None
                out.append((frame, best))
                if last == last and last is not None:
                    fit = [o for o in offers if best is None or o >= best - LOOK_BACK] if offers is not None else []
                    offset = round(median(fit)) if fit else 1 if best is None else best + 1
                    best = max(best or 0, max(int(offset), 1) + int(last))
            yield pd.DataFrame({"frame": [o[0] for o in out], "prev_max_rank": pd.array([o[1] for o in out], dtype="Int32")})

    return rows.repartition("capture_id").sortWithinPartitions("capture_id", "frame_no", "frame").mapInPandas(fold, _BEFORE)


def parse_frames(boxes: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Rows of the list in each frame: ``frame, rank, commander, alliance, server, points, y, tainted, complete, name_unreadable``.

    ``before`` (frame, prev_max_rank; see ``ranks_before``) gives the greatest
    rank known before a frame; readings far behind it do not count for the
    frame's offset.  Frames without a rank or points give no rows here; they
    stand in ``frame_fits``.
    """
    framed = _fitted(_slotted(boxes), before).where(F.size("slots") > 0)
    # A middle box belongs to the nearest slot within half a pitch, the lower one on ties.
    lower = lambda y: F.array_min(F.transform(F.filter(F.transform(F.col("slots"), lambda c, i: F.struct(F.abs(c - y).alias("d"), (-i).alias("i"))), lambda s: s["d"] <= PITCH / 2), lambda s: s))["i"]
    framed = framed.withColumn("middle", F.transform(F.filter("items", lambda i: i["zone"] == "middle"), lambda i: F.struct((-i["y"]).alias("y"), i["seq"].alias("seq"), i["t"].alias("t"), (-lower(i["y"])).alias("slot"))))
    rows = framed.select("frame", "banner_detected", "offset", "steps", "items", "middle", F.posexplode("slots").alias("slot", "y"))
    lines = F.sort_array(F.filter("middle", lambda m: m["slot"] == F.col("slot")))
    rows = rows.withColumn("lines", F.transform(lines, lambda m: m["t"]))
    points = F.get(F.filter("items", lambda i: (i["zone"] == "points") & (F.abs(i["y"] - F.col("y")) <= PITCH / 2)), F.lit(0))["number"]
    rows = rows.withColumn("points", points).withColumn("commander", F.coalesce(F.get("lines", F.lit(0)), F.lit(""))).withColumn("rest", F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1))))
    is_server = lambda t: t.rlike(r"^S\d{2,4}$")
    at = F.get(F.filter(F.transform("rest", lambda t, i: F.when(is_server(t), i)), lambda i: i.isNotNull()), F.lit(0))
    rows = rows.withColumn("at", at).withColumn("server", F.regexp_extract(F.get("rest", F.col("at")), r"^S(\d{2,4})$", 1))
    kept = F.filter("rest", lambda t, i: F.col("at").isNull() | (i != F.col("at")))
    rows = rows.withColumn("alliance", F.array_join(kept, " "))
    edge = (F.col("y") > EDGE_TOP_Y) | (F.col("y") < EDGE_BOTTOM_Y)
    looks_tag = F.col("commander").startswith("[") & (F.col("alliance") == "")
    rows = rows.withColumn("edge", edge).withColumn("looks_tag", looks_tag).withColumn("name_unreadable", looks_tag & ~edge)
    rows = rows.withColumn("alliance", F.when(F.col("name_unreadable"), F.col("commander")).otherwise(F.col("alliance"))).withColumn("commander", F.when(F.col("name_unreadable"), F.lit("")).otherwise(F.col("commander")))
    complete = ((F.col("commander") != "") | F.col("name_unreadable")) & F.col("points").isNotNull() & ~F.col("edge") & ~(F.col("looks_tag") & ~F.col("name_unreadable"))
    tainted = F.col("banner_detected") & F.col("y").between(OVERLAY_LOW, OVERLAY_HIGH)
    return rows.select("frame", (F.col("offset") + F.get("steps", F.col("slot"))).cast("int").alias("rank"), "commander", "alliance", "server", F.col("points").cast("bigint").alias("points"), "y", tainted.alias("tainted"), complete.alias("complete"), "name_unreadable")


def fit_screen(boxes: DataFrame) -> DataFrame:
    """Boxes moved to the usual screen, frame by frame: x by least squares over the four header boxes (the last of
    each counts), y exactly through title and column headers.  Near-identity fits are left as they are; boxes whose
    centre leaves the screen are dropped; a frame without its headers, or mirrored, is an error.
    """
    centre_x, centre_y = F.col("x") + F.col("width") / 2, F.col("y") + F.col("height") / 2
    expected = F.create_map(*[F.lit(v) for pair in HEADER_X.items() for v in pair])
    heads = boxes.where(F.trim("text").isin(*HEADER_X)).groupBy("frame", F.trim("text").alias("t")).agg(F.max(F.struct("seq", centre_x.alias("cx"), centre_y.alias("cy"))).alias("h"))
    seen = heads.select("frame", "t", "h.cx", "h.cy", expected[F.col("t")].alias("ex"))
    fit = seen.groupBy("frame").agg(
        F.count("*").alias("n"), F.regr_slope("cx", "ex").alias("w"), F.regr_intercept("cx", "ex").alias("left"),
        F.max(F.when(F.col("t") == "RANKINGS", F.col("cy"))).alias("title"), F.median(F.when(F.col("t") != "RANKINGS", F.col("cy"))).alias("column"),
    )
    fit = fit.withColumn("h", (F.col("title") - F.col("column")) / (TITLE_Y - COLUMN_Y)).withColumn("bottom", F.col("title") - F.col("h") * TITLE_Y)
    near = (F.abs("bottom") < 0.01) & (F.abs(F.col("h") - 1) < 0.01)
    fit = fit.withColumn("h2", F.when(near, 1.0).otherwise(F.col("h"))).withColumn("b2", F.when(near, 0.0).otherwise(F.col("bottom")))
    joined = boxes.join(fit, "frame", "left")
    bad = F.coalesce((F.col("n") < 4) | (F.col("w") <= 0) | (F.col("h") <= 0), F.lit(True))
    joined = joined.withColumn("w", F.when(bad, F.raise_error(F.concat(F.lit("no list header on "), F.col("frame"))).cast("double")).otherwise(F.col("w")))
    moved = joined.select("frame", "seq", "text", ((F.col("x") - F.col("left")) / F.col("w")).alias("x"), ((F.col("y") - F.col("b2")) / F.col("h2")).alias("y"), (F.col("width") / F.col("w")).alias("width"), (F.col("height") / F.col("h2")).alias("height"))
    return moved.where(centre_x.between(0, 1) & centre_y.between(0, 1))


def at_top(boxes: DataFrame, parsed: DataFrame) -> DataFrame:
    """Frames that show the top of the list: some rank digits in view and the first row has rank 1."""
    digits = zones(boxes).where("zone = 'rank'").select("frame").distinct()
    first = parsed.groupBy("frame").agg(F.min("rank").alias("first_rank"))
    return first.join(digits, "frame", "left_semi").where("first_rank = 1").select("frame")


def nearest_slot(points: DataFrame, slots: DataFrame, frame: str, y: str, slot: str, slot_y: str, reach: float) -> DataFrame:
    """Each point with the nearest slot of its frame within ``reach``, the lower slot (greater number) on ties.

    Slots are cut in bands of ``reach``; a point meets its own band and the two
    beside it, so a frame with very many points or slots is no all-pairs join.
    """
    bands = slots.withColumn("_band", F.floor(F.col(slot_y) / reach)).select(F.col(frame).alias("_f"), "_band", F.col(slot).alias("_slot"), F.col(slot_y).alias("_sy"))
    spread = points.withColumn("_b", F.explode(F.array(*[F.floor(F.col(y) / reach) + d for d in (-1, 0, 1)])))
    met = spread.join(bands, (F.col(frame) == F.col("_f")) & (F.col("_b") == F.col("_band"))).withColumn("_d", F.abs(F.col(y) - F.col("_sy"))).where(F.col("_d") <= reach)
    keys = points.columns
    best = met.groupBy(*keys).agg(F.min(F.struct(F.col("_d").alias("d"), (-F.col("_slot")).alias("s"))).alias("b"))
    return best.select(*keys, (-F.col("b.s")).alias(slot), F.col("b.d").alias("distance"))


def first_per_region(boxes: DataFrame, pattern: str, x_low: float, x_high: float, y_low: float, y_high: float) -> DataFrame:
    """The first box of each frame whose text matches ``pattern`` in any case with its centre in a region (origin at the top left)."""
    cx, cy = F.col("x") + F.col("width") / 2, 1 - (F.col("y") + F.col("height") / 2)
    hits = boxes.where(F.col("text").rlike(f"(?i){pattern}") & cx.between(x_low, x_high) & cy.between(y_low, y_high))
    return hits.groupBy("frame").agg(F.min(F.struct("seq", "text", "x", "y")).alias("b")).select("frame", "b.*")


def screen_matchup(boxes: DataFrame, home: str | DataFrame) -> DataFrame:
    """``frame, home_role, opponent, battle_over, home_result`` read from a screen of two sides; frames that do not show both are left out.

    ``home`` is the home server of all frames, or a table with that of each (``frame, home``).
    """
    side = (F.col("x") + F.col("width") / 2 >= 0.5).cast("int")
    rows = boxes.withColumn("side", side).withColumn("t", F.lower(F.trim("text")))
    role = F.when(F.col("t").rlike(r"^\W*defender\W*$"), "defending").when(F.col("t").rlike(r"^\W*invader\W*$"), "attacking")
    roles = rows.withColumn("role", role).where("role is not null").groupBy("frame", "side").agg(F.count("*").alias("n"), F.max("role").alias("role"), F.max("y").alias("label_y"))
    server = F.regexp_extract("t", r"^s\s*(\d{2,4})$", 1)
    places = rows.withColumn("server", server).where("server <> ''").join(roles, ["frame", "side"]).where((F.col("label_y") - F.col("y") > 0) & (F.col("label_y") - F.col("y") < 0.25))
    ranked = places.withColumn("k", F.row_number().over(Window.partitionBy("frame", "side").orderBy(F.desc("y"), "seq"))).withColumn("next_y", F.lead("y").over(Window.partitionBy("frame", "side").orderBy(F.desc("y"), "seq")))
    top = ranked.where("k = 1 and n = 1 and (next_y is null or y - next_y >= 0.02)").select("frame", "side", "role", "server", F.col("y").alias("server_y"), "label_y")
    words = rows.where(F.col("t").isin("victory", "defeat")).select("frame", "side", "t", F.col("y").alias("wy")).join(top.select("frame", "side", "server_y", "label_y"), ["frame", "side"]).where("wy >= server_y and wy <= label_y + 0.03")
    result = words.groupBy("frame", "side").agg(F.when(F.countDistinct("t") == 1, F.max("t")).alias("result"))
    sides = top.join(result, ["frame", "side"], "left")
    over = rows.groupBy("frame").agg(F.max(F.col("t").rlike(r"^battle\s+over$")).alias("battle_over"))
    sides = sides.withColumn("home", F.lit(home)) if isinstance(home, str) else sides.join(home.select("frame", "home"), "frame")
    mine, theirs = sides.where("server = home").select("frame", F.col("role").alias("home_role"), F.col("result").alias("home_result")), sides.where("server <> home").select("frame", F.col("server").alias("opponent"), F.col("role").alias("other_role"))
    return mine.join(theirs, "frame").where("home_role <> other_role").join(over, "frame").select("frame", "home_role", "opponent", "battle_over", "home_result")
