"""The capture as a stream: readings arrive frame by frame and votes are kept up to date.

``running_votes`` is a plain streaming aggregation: re-readings of a rank only
add votes, so nothing is ever dropped.  ``running_progress`` keeps a capture's
greatest rank and how long it has stalled as state of its own and tells when
the end of the list is certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from podium.operators.evidence import IDENTICAL, STALLED, STOP_RANK

PROGRESS = T.StructType([T.StructField("capture_id", T.StringType()), T.StructField("frame_no", T.LongType()), T.StructField("max_rank", T.LongType()), T.StructField("stalled", T.LongType()), T.StructField("identical", T.LongType()), T.StructField("at_end", T.BooleanType())])
#: Greatest rank and counters before the frame at hand, that frame and what it has shown so far.
_STATE = T.StructType([*[T.StructField(c, T.LongType()) for c in ("max_rank", "stalled", "identical", "frame_no")], T.StructField("shown", T.StringType()), T.StructField("before", T.StringType())])


def read_frames(spark: SparkSession, path: str, schema: T.StructType, per_batch: int = 1) -> DataFrame:
    """Readings as parquet files that appear under ``path``, ``per_batch`` at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def running_votes(readings: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts of each value of a key so far, with the nearest and earliest reading, for update or complete mode."""
    valid = readings.where(F.col(value).isNotNull() & (F.col(value).cast("string") != ""))
    near = F.struct(F.abs(F.coalesce("y", F.lit(0.45)) - 0.45).alias("d"), F.col("seq").alias("s"))
    return valid.groupBy(*keys, value).agg(F.count("*").alias("votes"), F.min(near).alias("nearest"))


def winners(votes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The leading value of each key in a table of ``running_votes``."""
    return votes.groupBy(*keys).agg(F.min(F.struct((-F.col("votes")).alias("m"), "nearest", F.col(value).alias("v"))).alias("b")).select(*keys, F.col("b.v").alias(value), (-F.col("b.m")).alias("votes"))


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counters move when a frame is over, i.e. when a later one begins, so a frame whose rows come in two micro-batches
    counts once; what it has shown so far is told each time.
    """
    best, stalled, identical, frame, shown, before = state.get if state.exists else (0, 0, 0, None, "", None)
    rows, out = pd.concat(list(batches)), []

    def told(best: int, stalled: int, identical: int, shown: str, before: str | None) -> tuple[int, int, int]:
        ranks = [int(r) for r in shown.split(",") if r]
        top = max([best, *ranks])
        return top, 0 if top > best else stalled + 1, identical + 1 if ranks and shown == before else 0

    for number, part in rows.groupby("frame_no"):
        ranks = {int(r) for r in part["rank"]}
        if frame is not None and number < frame:
            best = max([best, *ranks])  # rows of a frame that is over count, but do not begin it again
            continue
        if number != frame:
            if frame is not None:
                best, stalled, identical = told(best, stalled, identical, shown, before)
                before = shown
            frame, shown = int(number), ""
        shown = ",".join(map(str, sorted(ranks | {int(r) for r in shown.split(",") if r})))
        now = told(best, stalled, identical, shown, before)
        out.append((key[0], frame, *now, now[0] > STOP_RANK and (now[1] >= STALLED or now[2] >= IDENTICAL)))
    state.update((best, stalled, identical, frame, shown, before))
    yield pd.DataFrame(out, columns=[f.name for f in PROGRESS])


def running_progress(readings: DataFrame) -> DataFrame:
    """Progress of each capture after each frame; readings need ``capture_id, frame_no, rank``.  A frame that is still coming in is told again."""
    return readings.select("capture_id", "frame_no", "rank").groupBy("capture_id").applyInPandasWithState(_advance, PROGRESS, _STATE, "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, time: str, kind: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Extension: counts in tumbling or sliding windows; rows later than ``late`` no longer count."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return events.withWatermark(time, late).groupBy(window, kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")
