"""Problem 6: filling containers of fixed capacity.

Bounded-space online best fit: each partition keeps a fixed number of open
windows; an item goes into the window it fills most; if it fits in none and the
windows are all in use, the fullest is emitted.  An item larger than the
capacity is cut into full windows and a rest; no other item is ever cut.  At
the end the windows left open are merged: they are items of the same bounded
packing in fewer partitions, round after round, until one partition holds them
all.  Only sizes and ids move; texts stay where they are.

Items are dealt to partitions by their key and taken in its order, and the
number of partitions follows from the number of items, so containers do not
depend on how the input lies.  State is the number of open windows, so a
partition of any length and a single source of most items are packed as a
stream.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.session import durable

#: Open windows of a partition and capacity.
WINDOWS = 512
#: Items that a partition holds while there are no more than MOST_PARTITIONS.
PARTITION_ROWS, MOST_PARTITIONS = 20_000, 20_000
#: Leftover windows that one task of a merging round takes.
MERGE_ROWS = 200_000


class Packer:
    """Best fit with at most ``windows`` open windows of one capacity."""

    def __init__(self, capacity: int, windows: int) -> None:
        self.capacity, self.windows = capacity, windows
        self.next = 0
        self.open: list[tuple[int, int]] = []  # (free, window), ascending

    def place(self, size: int) -> int:
        """The window that takes an item of ``size``."""
        at = bisect_left(self.open, (size, -1))
        if at < len(self.open):
            free, window = self.open.pop(at)
        else:
            if len(self.open) >= self.windows:
                self.open.pop(0)  # the fullest is emitted
            free, window = self.capacity, self.next
            self.next += 1
        if free > size:
            insort(self.open, (free - size, window))
        return window

    def full(self) -> int:
        """A window of its own for a full piece."""
        self.next += 1
        return self.next - 1


def _pack(capacities: dict[str, int], windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 36
        packers = {name: Packer(c, windows) for name, c in capacities.items()}
        for batch in batches:
            out: list[tuple] = []
            for key, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name, packer in packers.items():
                    whole, rest = divmod(size, packer.capacity)
                    if size == packer.capacity or not whole:
                        out.append((name, part + packer.place(size), key, 0, 0, size))
                        continue
                    for n in range(whole):
                        out.append((name, part + packer.full(), key, n, n * packer.capacity, (n + 1) * packer.capacity))
                    if rest:
                        out.append((name, part + packer.place(rest), key, whole, whole * packer.capacity, size))
            yield _batch(out)
        # Windows still open, told apart by a null key; the sizes are what they hold.
        yield _batch([(name, part + w, None, -1, 0, packer.capacity - free) for name, packer in packers.items() for free, w in packer.open])

    return run


_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
_NAMES = ("container_class", "container_id", "item_id", "piece_no", "token_from", "token_to")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], names=list(_NAMES))


def _merge(capacities: dict[str, int], windows: int, number: int):
    """One task of merging round ``number``: where each leftover window goes, then, with a null old id, what is still open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = (1 << 62) + (number << 57) + (TaskContext.get().partitionId() << 36)
        packers = {name: Packer(c, windows) for name, c in capacities.items()}
        rows = lambda names, old, new, held: pa.RecordBatch.from_arrays([names, old, pa.array(new, pa.int64()), pa.array(held, pa.int64())], names=["container_class", "old_id", "new_id", "held"])
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            yield rows(batch.column(0), batch.column(1), [part + packers[n].place(s) for n, s in zip(names, sizes)], sizes)
        left = [(name, part + w, packer.capacity - free) for name, packer in packers.items() for free, w in packer.open]
        yield rows(pa.array([x[0] for x in left], pa.string()), pa.nulls(len(left), pa.int64()), [x[1] for x in left], [x[2] for x in left])

    return run


def pack(sizes: DataFrame, key: str, size: str, capacities: dict[str, int], windows: int = WINDOWS, merge_rows: int = MERGE_ROWS, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """Where every item goes: ``container_class, container_id, item_id, piece_no, token_from, token_to``.

    ``capacities`` are the (few) classes, each packed on its own.  Items with a
    null key, or a null or no size, are left out.  Capacities must be positive.
    ``sizes`` should be a stored table, so that a task run again meets the same
    items; items are taken in order of their key.  A merging round takes the
    leftovers in tasks of ``merge_rows``, largest first; every task leaves at
    most ``windows`` of a class open, so a few rounds bring any number to one.
    """
    if any(c < 1 for c in capacities.values()):
        raise ValueError("capacities must be positive")
    items = sizes.select(F.col(key).cast("bigint").alias("k"), F.col(size).cast("bigint").alias("n")).where("k is not null and n > 0")
    parts = max(1, min(-(-items.count() // partition_rows), MOST_PARTITIONS))
    schema = "container_class string, container_id bigint, item_id bigint, piece_no bigint, token_from bigint, token_to bigint"
    placed = durable(items.repartition(parts, "k").sortWithinPartitions("k", "n").mapInArrow(_pack(capacities, windows), schema))
    left = placed.where("piece_no = -1").select("container_class", F.col("container_id").alias("old_id"), F.col("token_to").alias("held"))
    moved, tasks, number = None, 0, 0
    while tasks != 1:
        tasks = max(1, -(-left.count() // merge_rows))
        spread = left.repartition(tasks, "old_id").sortWithinPartitions(F.desc("held"), "container_class", "old_id")
        merged = durable(spread.mapInArrow(_merge(capacities, windows if tasks > 1 else merge_rows, number), "container_class string, old_id bigint, new_id bigint, held bigint"))
        step = merged.where("old_id is not null").select(F.col("container_class").alias("c"), "old_id", "new_id")
        if moved is None:
            moved = step
        else:
            moved = durable(moved.join(step.select("c", F.col("old_id").alias("new_id"), F.col("new_id").alias("next")), ["c", "new_id"], "left").select("c", "old_id", F.coalesce("next", "new_id").alias("new_id")))
        left = merged.where("old_id is null").select("container_class", F.col("new_id").alias("old_id"), "held")
        number += 1
    rows_placed = placed.where("piece_no >= 0")
    joined = rows_placed.join(moved, (F.col("container_class") == F.col("c")) & (F.col("container_id") == F.col("old_id")), "left")
    return joined.select("container_class", F.coalesce("new_id", "container_id").alias("container_id"), "item_id", "piece_no", "token_from", "token_to")
