"""A priority queue in bounded memory, and positions within groups of any size."""

from __future__ import annotations

import heapq
import marshal
import tempfile
from collections.abc import Iterator
from itertools import chain, islice
from typing import IO, Any

from pyspark.sql import DataFrame, Window, functions as F

from punctum.llm.common import release, stored

HELD = 1 << 16
RUNS = 32
READ = 512


class SpillingQueue:
    """Entries ``(label, value)`` out in the order of their labels, then of arrival.

    At most ``held`` entries stay in memory; above that the whole heap goes to an unnamed file of the task's
    temp folder as a sorted run, and above ``runs`` files all runs are merged into one. A lost executor loses
    its queues with their tasks, and the tasks run again from the shuffle. Labels are tuples or numbers,
    values what ``marshal`` writes.
    """

    def __init__(self, held: int = HELD, runs: int = RUNS):
        self.held, self.most = max(1, held), max(1, runs)
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # the first entry of each run, with the number of its run
        self.runs: dict[int, Iterator[tuple]] = {}
        self.arrived = self.opened = self.spilled = 0

    def __bool__(self) -> bool:
        return bool(self.heap or self.heads)

    def push(self, label: Any, value: Any) -> None:
        heapq.heappush(self.heap, (label, self.arrived, value))
        self.arrived += 1
        if len(self.heap) > self.held:
            self._spill()

    def first(self) -> Any:
        """The smallest label, or None if the queue is empty."""
        if not self.heads:
            return self.heap[0][0] if self.heap else None
        return min(self.heads[0], self.heap[0])[0] if self.heap else self.heads[0][0]

    def pop(self) -> tuple[Any, Any]:
        if self.heap and not (self.heads and self.heads[0][:2] < self.heap[0][:2]):
            label, _, value = heapq.heappop(self.heap)
            return label, value
        label, _, run, value = heapq.heappop(self.heads)
        self._advance(run)
        return label, value

    def take(self, label: Any) -> list:
        """The values of all entries of this label, if it is the smallest; of a smaller one, none may be left."""
        out = []
        while self and self.first() == label:
            out.append(self.pop()[1])
        return out

    def _spill(self) -> None:
        if len(self.runs) >= self.most:
            rest = [chain([(label, arrived, value)], self.runs[run]) for label, arrived, run, value in self.heads]
            self.heads, self.runs = [], {}
            self._write(heapq.merge(*rest, key=lambda entry: entry[:2]))
        entries, self.heap = sorted(self.heap, key=lambda entry: entry[:2]), []
        self._write(iter(entries))
        self.spilled += 1

    def _write(self, entries: Iterator[tuple]) -> None:
        file = tempfile.TemporaryFile()
        while block := list(islice(entries, READ)):
            coded = marshal.dumps(block)
            file.write(len(coded).to_bytes(8, "little") + coded)
        file.seek(0)
        self.runs[self.opened] = _entries(file)
        self._advance(self.opened)
        self.opened += 1

    def _advance(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is None:
            del self.runs[run]
        else:
            heapq.heappush(self.heads, (entry[0], entry[1], run, entry[2]))


def _entries(file: IO[bytes]) -> Iterator[tuple]:
    with file:
        while size := int.from_bytes(file.read(8), "little"):
            yield from marshal.loads(file.read(size))


def placed(rows: DataFrame, group: list[str], order: list, label: str, sums: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in their group, and the table that knows where each group's parts begin.

    The rows are written, dealt into ranges of (group, order) and written again with ``part``, their range, and ``at``,
    a number that rises in the order. The second table has a row for each part of a group: ``first`` (its least ``at``),
    ``start`` (rows of the group before it), ``n`` (rows of the group), and for each of ``sums`` the sum of that column
    before it as ``<column>_start``. No group meets in one task, only its parts do: one row each. Group columns
    must not be null; rows that are equal in group and order may come either way.
    """
    given = stored(rows, label)
    ranged = given.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), label).withColumn("part", F.shiftright("at", 33))
    release(given)
    parts = ranged.groupBy("part", *group).agg(F.min("at").alias("first"), F.count("*").alias("met"), *[F.sum(c).alias(c) for c in sums])
    every = Window.partitionBy(*group)
    before = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    starts = parts.select(
        "part", *group, "first", ahead("met").alias("start"), F.sum("met").over(every).alias("n"), *[ahead(c).alias(f"{c}_start") for c in sums])
    return ranged, stored(starts, label)
