"""The bitemporal ledger of keys with very many facts, cut into ranges of valid time.

A range is swept like a key of its own, with what the ranges before it carry
into it as a reading at its beginning.  Four steps, each a stream in which no
more than a value for each range of a key is held:

1. each range tells what it carries out, whenever that changes;
2. the carries of a key's ranges are passed on from range to range: what is
   carried into a range, whenever that changes after the range has begun;
3. each range is swept with what is carried into it: versions within the range
   are done; the first (carried in) and the last (open) row may reach beyond;
4. open rows get the end that the first change in a later range gives them.
   Rows that were superseded before any later range had begun need no more.

Steps 1 and 3 hold the facts and are spread over the ranges; 2 and 4 only hold
changes at the borders of ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.session import durable

#: Where a range begins; sorts before every valid time.
BASE = (0,)


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for pdf in batches:
        yield from zip(*(pdf[c].array.astype(object) for c in pdf.columns))


def _reading(values: tuple) -> tuple:
    return tuple(x if isinstance(x, str) and x else None if not isinstance(x, (int, float)) or x != x else x for x in values)


def _batched(out: Iterator[tuple], columns: list[str], size: int = 20_000) -> Iterator[pd.DataFrame]:
    part: list[tuple] = []
    for row in out:
        part.append(row)
        if len(part) >= size:
            yield pd.DataFrame(part, columns=columns)
            part = []
    yield pd.DataFrame(part, columns=columns)


def _carried_out(make: Callable):
    """Facts (k, j, v, r, attributes) by (k, j, r): rows (k, j, r, attributes) when the last known attributes of the range change."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        at, line, told, last, now = None, None, None, None, None
        for k, j, v, r, *values in rows:
            if (k, j) != at or r != now:
                if line is not None and line.states[-1] != told:
                    told = line.states[-1]
                    yield (*at, now, *told)
                if (k, j) != at:
                    at, line, told, last = (k, j), make(), None, None
                now = r
            if (v, r) != last:
                last = (v, r)
                line.add((1, v), r, _reading(tuple(values)))
        if line is not None and line.states[-1] != told:
            yield (*at, now, *line.states[-1])

    return run


def _carried_in(width: int):
    """Carries out of ranges (k, j, r, attributes) by (k, r, j): rows (k, j, r, attributes) of what is carried into a range that has begun, when it changes."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, now, outs, ins, fresh = None, None, {}, {}, set()

        def settle() -> Iterator[tuple]:
            carried = None
            for j in sorted(outs):
                if carried is not None and ins.get(j) != carried:
                    ins[j] = carried
                    yield (key, j, now, *carried)
                carried = outs[j] if carried is None else tuple(n if n is not None else o for n, o in zip(outs[j], carried))

        for k, j, r, *values in rows:
            if k != key or r != now:
                if fresh:
                    yield from settle()
                if k != key:
                    key, outs, ins = k, {}, {}
                now, fresh = r, set()
            outs[j] = _reading(tuple(values))
            fresh.add(j)
        if fresh:
            yield from settle()

    return run


def _swept(make: Callable):
    """Facts and carries (k, j, r, base, v, attributes) by (k, j, r, base first): rows (k, j, base, start, end, since, until, attributes)."""
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        at, sweep = None, None
        shown = lambda done: ((*at, s == BASE, None if s == BASE else s[1], e[1] if e is not None else None, since, until, *state) for s, e, state, since, until in done)
        for k, j, r, base, v, *values in rows:
            if (k, j) != at:
                if sweep is not None:
                    yield from shown(sweep.finish())
                at, sweep = (k, j), make()
            yield from shown(sweep.add(BASE if base else (1, v), r, _reading(tuple(values))))
        if sweep is not None:
            yield from shown(sweep.finish())

    return run


def _stitched(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Events (k, at, j, kind, start, end, attributes) by (k, at, kind): an open version of a range is over (0), begins (1), the
    first change in a range from now on (2).  Rows (k, start, end, since, until, attributes).
    """
    key, now, ends, held, told, dirty = None, None, {}, {}, {}, False

    def settle() -> Iterator[tuple]:
        following, found = None, {}
        for j in sorted(set(ends) | set(held), reverse=True):
            found[j] = following
            if ends.get(j) is not None:
                following = ends[j]
        for j in set(told) | set(held):
            want = (*held[j], found[j]) if j in held else None
            if j in told and told[j][0] != want:
                (start, state, end), since = told.pop(j)
                if since != now:
                    yield (key, start, end, since, now, *state)
            if want is not None and j not in told:
                told[j] = (want, now)

    def finish() -> Iterator[tuple]:
        yield from settle()
        for (start, state, end), since in told.values():
            yield (key, start, end, since, None, *state)

    for k, at, j, kind, start, end, *values in rows:
        if k != key or at != now:
            if key is not None and k != key:
                yield from finish()
                ends, held, told = {}, {}, {}
            elif dirty:
                yield from settle()
            key, now, dirty = k, at, True
        if kind == 0:
            held.pop(j, None)
        elif kind == 1:
            held[j] = (start, _reading(tuple(values)))
        else:
            ends[j] = end
    if key is not None:
        yield from finish()


def ledger_by_ranges(facts: DataFrame, names: list[str], make_line: Callable, make_sweep: Callable, ranges: int) -> DataFrame:
    """The ledger (_k, _a..., _v0, _v1, _r0, _r1) of ``facts`` (_k, _v, _r, _a...), all their keys cut into ranges, ``ranges`` in all."""
    kinds = {f.name: f.dataType for f in facts.schema}
    fields = lambda *columns: T.StructType([T.StructField(n, t) for n, t in columns] + [T.StructField(n, kinds[n]) for n in names])
    k, v, r = kinds["_k"], kinds["_v"], kinds["_r"]
    through = lambda run, schema: lambda batches: _batched(run(_rows(batches)), schema.fieldNames())
    dealt = durable(facts.repartitionByRange(ranges, "_k", "_v").withColumn("_j", F.spark_partition_id()))  # stored, so a range stays what it is
    latest = [F.desc(n) for n in names]
    border = fields(("_k", k), ("_j", T.IntegerType()), ("_r", r))
    by_range = dealt.select("_k", "_j", "_v", "_r", *names).repartition(ranges, "_k", "_j").sortWithinPartitions("_k", "_j", "_r", "_v", *latest)
    outs = durable(by_range.mapInPandas(through(_carried_out(make_line), border), border))
    ins = outs.repartition("_k").sortWithinPartitions("_k", "_r", "_j").mapInPandas(through(_carried_in(len(names)), border), border)
    both = dealt.select("_k", "_j", "_r", F.lit(False).alias("_b"), "_v", *names).unionByName(ins.select("_k", "_j", "_r", F.lit(True).alias("_b"), F.lit(None).cast(v).alias("_v"), *names))
    swept = fields(("_k", k), ("_j", T.IntegerType()), ("_b", T.BooleanType()), ("_v0", v), ("_v1", v), ("_r0", r), ("_r1", r))
    rows = durable(both.repartition(ranges, "_k", "_j").sortWithinPartitions("_k", "_j", "_r", F.desc("_b"), "_v", *latest).mapInPandas(through(_swept(make_sweep), swept), swept))
    begins = outs.groupBy("_k", "_j").agg(F.min("_r").alias("_r"))
    later = begins.select("_k", "_j", F.min("_r").over(Window.partitionBy("_k").orderBy("_j").rowsBetween(1, Window.unboundedFollowing)).alias("_next"))
    marked = rows.join(F.broadcast(later) if ranges <= 10_000 else later, ["_k", "_j"])  # a row for each range of a key
    alone = ~F.col("_b") & (F.col("_v1").isNotNull() | F.col("_next").isNull() | (F.col("_r1") <= F.col("_next")))
    result = ["_k", *names, "_v0", "_v1", "_r0", "_r1"]
    done = marked.where(F.coalesce(alone, F.lit(False))).select(*result)
    open_ = marked.where(~F.coalesce(alone, F.lit(False)))
    event = lambda rows, at, kind: rows.select("_k", F.col(at).alias("_at"), "_j", F.lit(kind).alias("_kind"), "_v0", "_v1", *names)
    ends = open_.where("not _b")
    events = event(ends.where("_r1 is not null"), "_r1", 0).unionByName(event(ends, "_r0", 1)).unionByName(event(open_.where("_b"), "_r0", 2))
    final = fields(("_k", k), ("_v0", v), ("_v1", v), ("_r0", r), ("_r1", r))
    stitched = events.repartition("_k").sortWithinPartitions("_k", "_at", "_kind", "_j").mapInPandas(through(_stitched, final), final)
    return done.unionByName(stitched.select(*result))
