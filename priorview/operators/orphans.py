"""References to records that do not exist, were withdrawn or came later.

Keys are range-partitioned. The parents of a range are kept as sorted arrays, against which the
references of the range stream by in Arrow batches and are probed by binary search; only misses
leave the task. Ranges with many references are dealt to several tasks (salts), each with the
range's parents, so that a key which holds a large share of all references is no bottleneck.

There are as many tasks as the rows ask for, and the groups (range and salt) are placed on them by weight, the
heaviest first on the task that has least. Within a range rows are laid by finer subranges, which follow each
other in a task: it holds the parents of one subrange and one batch of references at a time.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priorview.functions.keys import current_rows, norm_id, utc_day
from priorview.session import shuffle_width

#: Keys sampled per kind of parent to lay the range bounds; they only balance the tasks.
SAMPLE = 4096
#: Cells of the equal-width grid over the keys' leading bytes, grouped to ranges of equal weight.
CELLS = 4096
#: Rows that a task is to get (they weigh some 75 bytes each), and most tasks, beyond which each gets more.
ROWS, TASKS = 60_000, 20_000
#: Parents that a subrange is to hold, where keys spread evenly.
HELD = 100_000


@dataclass(frozen=True)
class Reference:
    """``column`` of ``table`` (records keyed by ``key``) names records of kind ``parent``."""

    table: str
    key: str
    column: str
    parent: str


@dataclass(frozen=True)
class Ranges:
    """An order-preserving map from keys to ``count`` ranges, from the keys' bytes after a common prefix."""

    prefix: str
    low: int
    high: int
    cells: tuple[int, ...]
    count: int

    @staticmethod
    def number(key: str) -> int:
        return int.from_bytes(key.encode()[:6].ljust(6, b"\0"), "big")

    @classmethod
    def fit(cls, sample: list[str], count: int) -> Ranges:
        if not sample:
            return cls("", 0, 0, (0,) * CELLS, 1)
        sample = sorted(sample)
        prefix = os.path.commonprefix([sample[0], sample[-1]])
        n = np.array([cls.number(k[len(prefix):]) for k in sample], dtype=np.int64)
        low, high = int(n[0]), int(n[-1])
        at = np.minimum((n - low) / max(1, high - low) * CELLS, CELLS - 1).astype(int)
        weight = np.bincount(at, minlength=CELLS)
        before = np.concatenate([[0], np.cumsum(weight)[:-1]])
        ids = np.minimum(before * count // len(sample), count - 1)
        return cls(prefix, low, high, tuple(int(x) for x in ids), count)

    def _number(self, key: Column) -> Column:
        byte = F.rpad(F.substring(F.hex(F.substring(F.encode(F.substring(key, len(self.prefix) + 1, 6), "utf-8"), 1, 6)), 1, 12), 12, "0")
        return F.conv(byte, 16, 10).cast("bigint")

    def _cell(self, key: Column, cells: int) -> Column:
        """Keys before or after the fitted prefix and bounds go to the outer cells, in order."""
        cell = F.least(F.greatest(F.floor((self._number(key) - self.low) * (cells / max(1, self.high - self.low))), F.lit(0)), F.lit(cells - 1)).cast("int")
        if self.prefix:
            cell = F.when(key.startswith(self.prefix), cell).when(key < self.prefix, F.lit(0)).otherwise(F.lit(cells - 1))
        return cell

    def of(self, key: Column) -> Column:
        return F.element_at(_ints(self.cells), self._cell(key, CELLS) + 1)

    def sub(self, key: Column, finer: int) -> Column:
        """A finer cell; ``finer`` of them make one cell, so that they lie within the ranges."""
        return self._cell(key, CELLS * finer)


def _ints(values: tuple[int, ...]) -> Column:
    """An array literal, folded from one string."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _fixed(column: pa.Array) -> np.ndarray:
    """The bytes of strings as a numpy array of fixed width, without a Python object a key."""
    n = len(column)
    raw = column.cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, raw.offset * 8)
    sizes = np.diff(at)
    width = max(1, int(sizes.max(initial=1)))
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out = np.zeros((n, width), np.uint8)
    out[np.arange(width)[None, :] < sizes[:, None]] = bytes_[at[0] : at[-1]]
    return out.reshape(-1).view(f"S{width}")


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (part, salt, sub, kind), parents first; out go the rows of references that miss."""
    at, held, parents, flags, seen = None, [], None, None, None
    for batch in batches:
        group = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "salt", "sub", "kind")])
        cuts = [0, *(np.flatnonzero((np.diff(group, axis=0) != 0).any(axis=1)) + 1).tolist(), len(group)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            rows, place = batch.slice(a, b - a), tuple(group[a, :3])
            if place != at:
                at, held, parents = place, [], None
            if group[a, 3] == 0:
                held.append((_fixed(rows.column("key")), rows.column("flag").to_numpy(zero_copy_only=False), rows.column("ts").to_numpy(zero_copy_only=False)))
                continue
            if parents is None:
                if held:
                    parents, flags, seen = (np.concatenate(x) for x in zip(*held))
                    order = np.argsort(parents, kind="stable")
                    parents, flags, seen = parents[order], flags[order], seen[order]
                else:
                    parents, flags, seen = np.array([], "S1"), np.array([], np.int32), np.array([], np.int64)
                held = []
            keys, ts = _fixed(rows.column("key")), rows.column("ts").to_numpy(zero_copy_only=False)
            status = np.full(len(keys), 2, np.int32)
            if len(parents):
                i = np.minimum(np.searchsorted(parents, keys), len(parents) - 1)
                hit = parents[i] == keys
                status[hit] = np.where(flags[i[hit]] == 0, np.where(seen[i[hit]] > ts[hit], 3, 0), flags[i[hit]])
            miss = np.flatnonzero(status)
            if len(miss):
                out = rows.select(["ref", "record_id", "ts"]).take(pa.array(miss))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(status[miss], pa.int32())], ["ref", "record_id", "ts", "status"])


def placed(weights: list[int], tasks: int) -> list[int]:
    """The task of each group: the heaviest first, each on the task that has least so far."""
    load = [(0, t) for t in range(tasks)]
    out = [0] * len(weights)
    for i in sorted(range(len(weights)), key=lambda i: (-weights[i], i)):
        n, t = heapq.heappop(load)
        out[i] = t
        heapq.heappush(load, (n + max(1, weights[i]), t))
    return out


def orphan_references(
    children: dict[str, DataFrame],
    parents: dict[str, tuple[DataFrame, str]],
    retired: DataFrame,
    references: list[Reference],
    order: str = "scraped_at",
    ranges: int | None = None,
) -> DataFrame:
    """(table_name, column_name, record_id, status, period) for each reference that finds no record in time.

    children: table name to rows; the current row of a record (newest ``order``) is what refers.
    parents: kind to its rows and key column; a parent is there from its earliest ``order`` on.
    retired: (entity_type, entity_id, retired_at); the latest withdrawal of an id counts.

    ``deleted``: withdrawn, and no row of it newer than that. Else ``missing``: no row at all. Else
    ``late``: its earliest row is newer than the referring one. Null and blank references refer to
    nothing; blanks around ids and their case don't matter; records without a key are left out. A
    null time of a referring row counts as oldest, so any parent is late for it; its period is null.
    """
    spark = retired.sparkSession
    kinds = list(parents)
    samples, sizes = {}, {}
    for kind, (rows, key) in parents.items():
        keys = rows.select(norm_id(key).alias("k")).filter("k is not null")
        samples[kind] = [r.k for r in keys.orderBy(F.xxhash64("k"), "k").limit(SAMPLE).collect()]
        sizes[kind] = keys.count()
    refs_n = sum(children[r.table].count() for r in references)
    total = refs_n + sum(sizes.values())
    tasks = max(shuffle_width(spark), -(-total // max(ROWS, total // TASKS)))
    ranges = ranges or max(2, min(CELLS, 4 * tasks // max(1, len(kinds))))
    by_kind = {kind: Ranges.fit(samples[kind], ranges) for kind in kinds}
    finer = {kind: 1 << max(0, (sizes[kind] // (HELD * CELLS)).bit_length()) for kind in kinds}
    offset = {k: i * ranges for i, k in enumerate(kinds)}

    def part(kind: str, key: Column) -> Column:
        return by_kind[kind].of(key) + F.lit(offset[kind])

    # References per range, from the raw rows (no less than there will be): they set the salts.
    raw = [children[r.table].select(part(r.parent, norm_id(r.column)).alias("part")) for r in references]
    weights = {r.part: r.n for r in reduce(DataFrame.unionAll, raw).filter("part is not null").groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    fair = max(1, total // (4 * tasks))
    groups = len(kinds) * ranges
    salts = tuple(min(tasks, -(-weights.get(i, 0) // max(fair, sizes[kinds[i // ranges]] // ranges))) or 1 for i in range(groups))
    first = np.concatenate([[0], np.cumsum(salts)])
    heavy = [weights.get(i, 0) // salts[i] + sizes[kinds[i // ranges]] // ranges for i in range(groups) for _ in range(salts[i])]
    salted, start, place = _ints(salts), _ints(tuple(first[:-1].tolist())), _ints(tuple(placed(heavy, tasks)))
    task = lambda df: df.withColumn("task", F.element_at(place, F.element_at(start, F.col("part") + 1) + F.col("salt") + 1))

    gone = retired.select(F.col("entity_type").alias("kind_name"), norm_id("entity_id").alias("key"), F.col("retired_at")).filter("key is not null")
    held = []
    for kind, (rows, key) in parents.items():
        both = rows.select(norm_id(key).alias("key"), F.col(order).alias("at"), F.lit(None).cast("timestamp").alias("retired_at"), F.lit(1).alias("n")).unionByName(
            gone.filter(F.col("kind_name") == kind).select("key", F.lit(None).cast("timestamp").alias("at"), "retired_at", F.lit(0).alias("n"))
        )
        one = both.filter("key is not null").groupBy("key").agg(*[f(F.unix_micros(c)).alias(a) for f, c, a in ((F.min, "at", "ts"), (F.max, "at", "last"), (F.max, "retired_at", "retired"))], F.max("n").alias("n"))
        flag = F.when(F.col("retired").isNotNull() & (F.col("last").isNull() | (F.col("last") <= F.col("retired"))), 1).when(F.col("n") == 0, 2).otherwise(0)
        held.append(one.select(part(kind, F.col("key")).alias("part"), by_kind[kind].sub(F.col("key"), finer[kind]).alias("sub"), "key", F.coalesce("ts", F.lit(-(2**62))).alias("ts"), flag.cast("int").alias("flag")))
    stored = reduce(DataFrame.unionAll, held).select(
        "part", F.explode(F.sequence(F.lit(0), F.element_at(salted, F.col("part") + 1) - 1)).alias("salt"), "sub", F.lit(0).alias("kind"), "key", "ts", "flag", F.lit(-1).alias("ref"), F.lit(None).cast("string").alias("record_id")
    )

    probes = []
    for name in dict.fromkeys(r.table for r in references):
        own = [(i, r) for i, r in enumerate(references) if r.table == name]
        now = current_rows(children[name], own[0][1].key, [own[0][1].key, order, *[r.column for _, r in own]], order)
        each = F.array(*[F.struct(F.lit(i).alias("ref"), norm_id(r.column).alias("key"), part(r.parent, norm_id(r.column)).alias("part"), by_kind[r.parent].sub(norm_id(r.column), finer[r.parent]).alias("sub")) for i, r in own])
        rows = now.select(F.col(own[0][1].key).alias("record_id"), F.coalesce(F.unix_micros(order), F.lit(-(2**62))).alias("ts"), F.inline(each)).filter("key is not null")
        probes.append(rows.select("part", F.pmod(F.xxhash64("record_id"), F.element_at(salted, F.col("part") + 1)).cast("int").alias("salt"), "sub", F.lit(1).alias("kind"), "key", "ts", F.lit(0).alias("flag"), "ref", "record_id"))

    laid = task(stored.unionByName(reduce(DataFrame.unionAll, probes))).repartitionById(tasks, "task").sortWithinPartitions("part", "salt", "sub", "kind").drop("task")
    missed = laid.mapInArrow(_probe, "ref int, record_id string, ts bigint, status int")
    named = lambda f: F.element_at(F.array(*[F.lit(f(r)) for r in references]), F.col("ref") + 1)
    when = F.when(F.col("ts") > -(2**62), F.date_format(utc_day(F.timestamp_micros("ts")), "yyyy-MM"))
    return missed.select(named(lambda r: r.table).alias("table_name"), named(lambda r: r.column).alias("column_name"), "record_id", F.element_at(F.array(*map(F.lit, ("deleted", "missing", "late"))), F.col("status")).alias("status"), when.alias("period"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Misses by table, column, status and period."""
    return found.groupBy("table_name", "column_name", "status", "period").agg(F.count(F.lit(1)).alias("refs"))
