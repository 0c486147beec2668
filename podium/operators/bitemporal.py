"""Bitemporal ledger of changing entity attributes.

Facts are readings ``(key, valid, recorded, attributes...)``: what was read of
an entity at valid time ``valid``, known from ``recorded`` on.  A null or empty
attribute was not read and keeps its last known value.  The ledger holds one
row per version and belief: a version holds over ``[valid_from, valid_to)`` and
was believed over ``[recorded_from, recorded_to)``; a null end is open.  A late
or correcting fact splits the intervals it overlaps: the rows it contradicts
get a ``recorded_to`` and their replacements a ``recorded_from``; no row's
values or valid interval are ever overwritten.

Facts recorded at one time take effect together, so no belief is empty.

Plan: facts are hashed by key and sorted by recorded time in one exchange, then
swept as a stream; repeats and readings that say nothing new change nothing
there.  The sweep's state is one key's current timeline, at most one entry per
distinct valid time, so no group is ever collected.  Keys of more than
LONG_ROWS facts are cut into ranges of valid time and swept in parallel, with
the same result (see ``bitemporal_ranges``).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.operators.bitemporal_ranges import ledger_by_ranges
from podium.session import durable


#: Facts of a key from which on it is cut into ranges of about so many.
LONG_ROWS = 1_000_000


class Timeline:
    """The versions of one key as known so far, and the ledger rows closed."""

    def __init__(self, width: int) -> None:
        self.nothing: tuple = (None,) * width
        self.points: list = []  # valid times with a reading
        self.readings: list[tuple] = []
        self.states: list[tuple | None] = []  # carried attributes at each point
        self.starts: list = []  # where a version begins
        self.open: dict = {}  # start -> [end, state, recorded_from]

    def add(self, valid, recorded, reading: tuple) -> list[tuple]:
        """Take in one fact; returns the rows it supersedes, as (start, end, state, recorded_from)."""
        i = bisect_left(self.points, valid)
        if i < len(self.points) and self.points[i] == valid:
            if self.readings[i] == reading:
                return []
            self.readings[i] = reading
        else:
            self.points.insert(i, valid)
            self.readings.insert(i, reading)
            self.states.insert(i, None)
        j, state = i, self.states[i - 1] if i else self.nothing
        while j < len(self.points):
            state = tuple(new if new is not None else old for new, old in zip(self.readings[j], state))
            if state == self.states[j]:
                break
            self.states[j] = state
            j += 1
        if j == i:
            return []
        # Versions that begin in [points[i], points[j]] may have moved; the one before may end elsewhere.
        last = min(j, len(self.points) - 1)
        lo, hi = bisect_left(self.starts, self.points[i]), bisect_right(self.starts, self.points[last])
        fresh = [self.points[k] for k in range(i, last + 1) if k == 0 or self.states[k] != self.states[k - 1]]
        first = max(lo - 1, 0)
        before = {s: self.open[s] for s in self.starts[first:hi]}
        self.starts[lo:hi] = fresh
        touched = self.starts[first : lo + len(fresh)]
        closed = []
        for s in before:
            del self.open[s]
        for n, s in enumerate(touched):
            at = first + n + 1
            end = self.starts[at] if at < len(self.starts) else None
            state = self.states[bisect_left(self.points, s)]
            old = before.get(s)
            if old and old[0] == end and old[1] == state:
                self.open[s] = old
                del before[s]
            else:
                self.open[s] = [end, state, recorded]
        for s, (end, state, since) in before.items():
            closed.append((s, end, state, since))
        return closed

    def current(self) -> Iterator[tuple]:
        for s in self.starts:
            end, state, since = self.open[s]
            yield s, end, state, since


class Sweep:
    """The ledger of one key from its facts in recorded order; facts of one recorded time count together."""

    def __init__(self, width: int) -> None:
        self.line, self.at, self.last = Timeline(width), None, None
        self.closed: dict[tuple, object] = {}  # (start, end, state) of rows closed now -> since when they were believed

    def add(self, valid, recorded, reading: tuple) -> list[tuple]:
        """Take in one fact, of several of one time the first; returns the rows superseded before ``recorded``."""
        done = self.settle() if recorded != self.at else []
        if (valid, recorded) != self.last:
            self.at, self.last = recorded, (valid, recorded)
            for s, e, state, since in self.line.add(valid, recorded, reading):
                self.closed.setdefault((s, e, state), since)
        return done

    def settle(self) -> list[tuple]:
        """The rows (start, end, state, since, until) superseded at the current time; one that is back again goes on."""
        done = []
        for (s, e, state), since in self.closed.items():
            now = self.line.open.get(s)
            if now and now[0] == e and now[1] == state:
                now[2] = since
            elif since != self.at:
                done.append((s, e, state, since, self.at))
        self.closed = {}
        return done

    def finish(self) -> list[tuple]:
        return self.settle() + [(s, e, state, since, None) for s, e, state, since in self.line.current()]


def _sweep(width: int, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sweep, out = None, None, []
        take = lambda rows: out.extend((key, *state, s, e, since, until) for s, e, state, since, until in rows)
        for pdf in batches:
            for row in zip(*(pdf[c].array.astype(object) if i in (0, 1, 2) else pdf[c].tolist() for i, c in enumerate(pdf.columns))):
                if sweep is None or row[0] != key:
                    if sweep is not None:
                        take(sweep.finish())
                    key, sweep = row[0], Sweep(width)
                reading = tuple(x if isinstance(x, str) and x else None if not isinstance(x, (int, float)) or x != x else x for x in row[3:])
                take(sweep.add(row[1], row[2], reading))
            if len(out) >= 20_000:
                yield pd.DataFrame(out, columns=columns)
                out.clear()
        if sweep is not None:
            take(sweep.finish())
        if out:
            yield pd.DataFrame(out, columns=columns)

    return run


def bitemporal_ledger(facts: DataFrame, key: str, valid: str, recorded: str, attributes: Sequence[str], long_rows: int = LONG_ROWS) -> DataFrame:
    """The full ledger of ``facts``.

    Returns ``key, *attributes, valid_from, valid_to, recorded_from,
    recorded_to``.  Facts with a null key, valid or recorded time hold for
    nobody or at no time and are left out.  Null and empty attributes count as
    unread; one never read yet is null in the version.  Of facts of one key,
    valid and recorded time that differ, the one greatest in attribute order
    counts.  Attributes must be strings or numbers.  An empty table gives an
    empty ledger; other columns are ignored, whatever their names.
    """
    attributes = list(attributes)
    types = {f.name: f.dataType for f in facts.schema}
    read = [F.when(F.col(a) != "", F.col(a)).alias(f"_a{i}") if isinstance(types[a], T.StringType) else F.col(a).alias(f"_a{i}") for i, a in enumerate(attributes)]
    names = [f"_a{i}" for i in range(len(attributes))]
    rows = facts.select(F.col(key).alias("_k"), F.col(valid).alias("_v"), F.col(recorded).alias("_r"), *read).where(
        F.col("_k").isNotNull() & F.col("_v").isNotNull() & F.col("_r").isNotNull()
    )
    schema = T.StructType(
        [
            T.StructField(key, types[key]),
            *[T.StructField(a, types[a]) for a in attributes],
            T.StructField("valid_from", types[valid]),
            T.StructField("valid_to", types[valid]),
            T.StructField("recorded_from", types[recorded]),
            T.StructField("recorded_to", types[recorded]),
        ]
    )
    # Of facts of one valid and recorded time the greatest comes first.
    swept = lambda facts: facts.repartition("_k").sortWithinPartitions("_k", "_r", "_v", *[F.desc(n) for n in names]).mapInPandas(_sweep(len(attributes), schema.fieldNames()), schema)
    counted = durable(rows.groupBy("_k").agg(F.count("*").alias("n")).where(F.col("n") > long_rows))
    long = counted.agg(F.count("*").alias("keys"), F.sum("n").alias("n")).first()
    if not long["keys"]:
        return swept(rows)
    # There are no more long keys than LONG_ROWS go into the facts; beyond what is safe to broadcast they are joined.
    keys = F.broadcast(counted.select("_k")) if long["keys"] <= 100_000 else counted.select("_k")
    pieces = ledger_by_ranges(rows.join(keys, "_k", "left_semi"), names, lambda: Timeline(len(names)), lambda: Sweep(len(names)), max(2, -(-long["n"] // long_rows)))
    return swept(rows.join(keys, "_k", "left_anti")).unionByName(pieces.toDF(*schema.fieldNames()))


def as_recorded(ledger: DataFrame, at: Column | None = None) -> DataFrame:
    """The versions believed at recorded time ``at``; by default now, i.e. rows not superseded."""
    if at is None:
        return ledger.where(F.col("recorded_to").isNull())
    return ledger.where((F.col("recorded_from") <= at) & (F.col("recorded_to").isNull() | (F.col("recorded_to") > at)))


def as_of(ledger: DataFrame, valid_at: Column, recorded_at: Column | None = None) -> DataFrame:
    """What was believed at ``recorded_at`` to hold at ``valid_at``: at most one row per key."""
    held = as_recorded(ledger, recorded_at)
    return held.where((F.col("valid_from") <= valid_at) & (F.col("valid_to").isNull() | (F.col("valid_to") > valid_at)))
