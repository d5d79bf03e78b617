"""Exact order statistics per key without sorting or moving rows.

Every wanted rank has a bracket, at first all values. A round sketches the values inside the brackets (a mergeable
equal-depth histogram per key, made map-side) and counts the rows on either side of the histogram's cell that the
rank falls into. The counts are exact, so the bracket shrinks to that cell, or the rank is met by one of its edges,
whatever the error of the sketch. Once a bracket holds few rows, these alone are gathered and the value picked.
All columns and ranks share each scan; only counts, edges and the last few values are shuffled.

Where the keys are few and the columns are doubles, a scan yields both: the rows below each bracket, counted, and a
summary of the values inside, which is whole (every distinct value with its number) once they are few. Two scans are
then the rule, and one for a column of few distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.operators.least_squares import by_key, fields, plain
from obsframe.session import bounded, cut, link

CELLS = 1024  # cells of a histogram
ACCURACY = 10_000  # of the sketch behind it
PICK_ROWS = 50_000  # rows of a bracket that one group gathers
SUMMARY = 4096  # entries of a task's summary
MERGED = 16_384  # entries of a key's summary
FOLD_ROWS = 65_536  # values that wait to be folded into a summary
SUMMARIES = 256  # most summaries that come to the driver
NEAR_CELLS = 16  # a rank is looked for within so many cells of a task's summary

#: Output name to (column, function from the number of its values to the wanted place, from 0, fractions between two).
Wanted = dict[str, tuple[str, Callable[[Column], Column]]]


def at_share(q: float) -> Callable[[Column], Column]:
    """The place of a linearly interpolated quantile."""
    return lambda n: (n - 1) * F.lit(q)


def order_statistics(rows: DataFrame, key: Sequence[str], wanted: Wanted) -> DataFrame:
    """The wanted values of every key, interpolated between neighbours; null for keys without values.

    ``rows`` are read several times, so a costly plan is written before. Null values do not count.
    """
    key, names = list(key), list(wanted)
    value = {i: F.col(wanted[name][0]) for i, name in enumerate(names)}
    sizes = rows.groupBy(*key).agg(*[F.count(v).alias(f"n{i}") for i, v in value.items()])
    first = {}
    for i, name in enumerate(names):
        h, kind = wanted[name][1](F.col(f"n{i}")), rows.schema[wanted[name][0]].dataType
        first |= {f"h{i}": h.cast("double"), f"r{i}": F.floor(h), f"below{i}": F.lit(0).cast("long"), f"inside{i}": F.col(f"n{i}")}
        first |= {f"{c}{i}": F.lit(None).cast(kind) for c in ("lo", "hi", "found")}
    state = cut(sizes.select(*key, *[c.alias(n) for n, c in first.items()]))
    while True:
        waiting = [F.max(F.when(F.col(f"found{i}").isNull(), F.col(f"inside{i}"))).alias(str(i)) for i in value]
        most = state.agg(*waiting).first()
        # rounds go on for the targets that need them; the others are not looked at
        busy = [i for i in value if (most[str(i)] or 0) > PICK_ROWS]
        if not busy:
            break
        state = narrowed(rows, key, state, value, busy)
    return picked(rows, key, state, value, names)


@dataclass
class Summary:
    """Values from ``low`` to ``high`` in ascending order: ``below`` come before them, ``w[i]`` of them lie beyond v[i - 1] up to about v[i];
    with ``whole`` exactly so many equal v[i]."""

    low: int
    high: int
    below: int
    n: int
    whole: bool
    v: np.ndarray
    w: np.ndarray

    def bracket(self, rank: int) -> tuple[int, int]:
        """A smaller bracket, about the rank."""
        ends, error = self.below + np.cumsum(self.w), NEAR_CELLS * self.n / min(len(self.v), SUMMARY)
        while True:
            a, b = (int(np.searchsorted(ends, rank + e, side="right")) for e in (-error, error))
            if b - a <= len(self.v) // 4 or error < 1:
                break
            error /= 8
        return (int(self.v[a - 1]) if a > 0 else self.low), (int(self.v[b]) if b < len(self.v) else self.high)

    def at(self, rank: int) -> int:
        return int(self.v[np.searchsorted(self.below + np.cumsum(self.w), rank, side="right")])


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def as_ordered(v: np.ndarray) -> np.ndarray:
    """Whole numbers that compare as Spark's doubles do: -0.0 equals 0.0, NaN comes last."""
    bits = np.where(np.isnan(v), np.nan, v + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & _MOST)


def as_double(k: int) -> float:
    return float(np.array([k ^ (k >> 63 & _MOST)], np.int64).view(float)[0])


def thinned(v: np.ndarray, w: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to about ``most`` of the entries, each with the weight of those left out before it.

    A cell takes its share of the weight and of the number of entries, so that neither one heavy value nor many light ones hide the rest.
    """
    if len(v) <= most:
        return v, w
    cell = ((np.cumsum(w) / w.sum() + np.arange(len(v)) / len(v)) * (most / 2)).astype(np.int64)
    last = np.flatnonzero(np.diff(cell, append=cell[-1] + 1))
    return v[last], np.diff(np.cumsum(w)[last], prepend=0)


def merged(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(v, kind="stable")
    v, w = v[order], w[order]
    first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))) if len(v) else np.zeros(0, int)
    return v[first], np.add.reduceat(w, first) if len(first) else w


Bracket = tuple[str, int, int]


def summaries(rows: DataFrame, key: list[str], columns: Sequence[str], asked: dict[tuple, list[Bracket]] | list[Bracket]) -> dict[tuple, tuple]:
    """One scan: by key its values and the summaries of its brackets. ``asked`` has the brackets by key, or those of every key."""
    shape = "b int, below bigint, n bigint, whole boolean, v binary, w binary"
    kinds = ", ".join([*fields(rows, key), shape])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        schema = None

        def fold(s: list) -> None:
            v, w = np.unique(np.concatenate(s[2]), return_counts=True)
            if s[4] is not None:
                v, w = merged(np.concatenate([s[4], v]), np.concatenate([s[5], w]))
            s[6] = s[6] and len(v) <= SUMMARY
            s[2], s[3], (s[4], s[5]) = [], 0, thinned(v, w, SUMMARY)

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = [batch.schema.field(c).type for c in key]
            value = {c: as_ordered(batch.column(c).to_numpy(zero_copy_only=False)) for c in columns}
            known = {c: batch.column(c).is_valid().to_numpy(zero_copy_only=False) for c in columns if batch.column(c).null_count}
            for head, at in by_key(batch, key, np.arange(batch.num_rows)):
                name = plain(head)
                if name not in held:
                    wanted = asked if isinstance(asked, list) else asked.get(name, [])
                    # below, inside, waiting values, their number, values, weights, whether none was left out
                    held[name] = head, wanted, [[0, 0, [], 0, None, None, True] for _ in wanted]
                for (c, low, high), s in zip(*held[name][1:]):
                    v = value[c][at[known[c][at]] if c in known else at]
                    if low > _LEAST or high < _MOST:
                        s[0] += int(np.count_nonzero(v < low))
                        v = v[(v >= low) & (v <= high)]
                    if len(v):
                        s[1] += len(v)
                        s[2].append(v)
                        s[3] += len(v)
                        if s[3] >= FOLD_ROWS:
                            fold(s)
        out = []
        for head, _, found in held.values():
            for b, s in enumerate(found):
                if s[2]:
                    fold(s)
                v, w = (np.zeros(0, np.int64),) * 2 if s[4] is None else (s[4], s[5])
                out.append((*head, b, s[0], s[1], s[6], v.tobytes(), w.astype(np.int64).tobytes()))
        if out:
            types = [*schema, pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [*key, "b", "below", "n", "whole", "v", "w"])

    def merge(part: pa.Table) -> pa.Table:
        v, w = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.int64) for c in ("v", "w"))
        v, w = merged(v, w)
        whole = all(part.column("whole").to_pylist()) and len(v) <= MERGED
        v, w = thinned(v, w, MERGED)
        below, n = (sum(part.column(c).to_pylist()) for c in ("below", "n"))
        first = part.slice(0, 1).select([*key, "b"])
        columns = (("below", [below], pa.int64()), ("n", [n], pa.int64()), ("whole", [whole], pa.bool_()), ("v", [v.tobytes()], pa.binary()), ("w", [w.tobytes()], pa.binary()))
        for name, x, t in columns:
            first = first.append_column(name, pa.array(x, t))
        return first

    found: dict[tuple, tuple] = {}
    scanned = rows.select(*key, *columns).mapInArrow(scan, kinds)
    for r in scanned.groupBy(*key, "b").applyInArrow(merge, kinds).collect():
        head = tuple(r[: len(key)])
        name = plain(head)
        _, low, high = (asked if isinstance(asked, list) else asked[name])[r["b"]]
        v, w = (np.frombuffer(r[c], np.int64) for c in ("v", "w"))
        found.setdefault(name, (head, {}))[1][r["b"]] = Summary(low, high, r["below"], r["n"], r["whole"], v, w)
    return found


def summarised_statistics(rows: DataFrame, key: Sequence[str], few: DataFrame, wanted: Wanted) -> DataFrame:
    """:func:`order_statistics` of the keys in ``few``, whose summaries the driver can hold."""
    key, names = list(key), list(wanted)
    spark, columns = rows.sparkSession, list(dict.fromkeys(c for c, _ in wanted.values()))
    rows = link(rows, few, tuple(key), "inner") if key else rows
    first = summaries(rows, key, columns, [(c, _LEAST, _MOST) for c in columns])
    if not first:
        shape = ", ".join([*fields(rows, key), *[f"`{n}` double" for n in names]])
        return spark.createDataFrame([], shape)
    every = list(first)
    # places as the caller's expressions say
    numbers = [(i, *[first[k][1][b].n for b in range(len(columns))]) for i, k in enumerate(every)]
    sizes = spark.createDataFrame(numbers, ", ".join(["i int", *[f"n{b} bigint" for b in range(len(columns))]]))
    places = sizes.select("i", *[wanted[n][1](F.col(f"n{columns.index(wanted[n][0])}")).cast("double") for n in names]).collect()
    place = {every[r[0]]: r[1:] for r in places}
    waiting: dict[tuple, Summary] = {}  # by (key, column, rank) the summary that holds it
    for k in every:
        for n, h in zip(names, place[k]):
            b = columns.index(wanted[n][0])
            s = first[k][1][b]
            for rank in dict.fromkeys((math.floor(h), math.ceil(h))) if s.n else ():
                waiting[k, b, rank] = s
    value: dict[tuple, float] = {}
    while waiting:
        asked: dict[tuple, list[Bracket]] = {}
        next_ones = {}
        for (k, b, rank), s in waiting.items():
            if isinstance(s, Summary):
                if s.whole:
                    value[k, b, rank] = as_double(s.at(rank))
                    continue
                bracket = s.bracket(rank)
            else:
                bracket = s
            mine = asked.setdefault(k, [])
            if (columns[b], *bracket) not in mine:
                mine.append((columns[b], *bracket))
            next_ones[k, b, rank] = mine.index((columns[b], *bracket))
        if not next_ones:
            break
        found = summaries(rows, key, columns, asked)
        still: dict[tuple, object] = {}
        for (k, b, rank), at in next_ones.items():
            s, held = found[k][1][at], waiting[k, b, rank]
            low, high = (held.low, held.high) if isinstance(held, Summary) else held
            # the counts are exact: a rank outside lies on a known side
            if rank < s.below:
                still[k, b, rank] = (low, s.low - 1)
            elif rank >= s.below + s.n:
                still[k, b, rank] = (s.high + 1, high)
            else:
                still[k, b, rank] = s
        waiting = still
    out = []
    for k in every:
        line = []
        for n, h in zip(names, place[k]):
            b = columns.index(wanted[n][0])
            if not first[k][1][b].n:
                line.append(None)
                continue
            low, high = (value[k, b, f(h)] for f in (math.floor, math.ceil))
            line.append(low + (high - low) * (h - math.floor(h)) if h > math.floor(h) else low)
        out.append((*first[k][0], *line))
    return spark.createDataFrame(out, ", ".join([*fields(rows, key), *[f"`{n}` double" for n in names]]))


def within(i: int, v: Column) -> Column:
    """Whether a value lies inside the bracket of a target that is not met yet."""
    above = F.col(f"lo{i}").isNull() | (v > F.col(f"lo{i}"))
    return F.col(f"found{i}").isNull() & above & (F.col(f"hi{i}").isNull() | (v < F.col(f"hi{i}")))


def narrowed(rows: DataFrame, key: list[str], state: DataFrame, value: dict[int, Column], busy: Sequence[int]) -> DataFrame:
    """One round: histogram inside the brackets, then counts around the cell of each rank."""
    small = bounded(state)
    grid = F.array(*[F.lit(c / CELLS) for c in range(CELLS + 1)])
    inside = link(rows, small, tuple(key), "inner")
    edges = inside.groupBy(*key).agg(
        *[F.percentile_approx(F.when(within(i, value[i]), value[i]), grid, ACCURACY).alias(f"e{i}") for i in busy]
    )
    cells = {}
    for i in busy:
        share = (F.col(f"r{i}") - F.col(f"below{i}")) / F.greatest(F.col(f"inside{i}") - 1, F.lit(1))
        cell = F.floor(share * CELLS).cast("int")
        cells[f"left{i}"] = F.get(f"e{i}", F.greatest(cell - 1, F.lit(0)))
        cells[f"right{i}"] = F.get(f"e{i}", F.least(cell + 2, F.lit(CELLS)))
    around = link(state, edges, tuple(key)).withColumns(cells).drop(*[f"e{i}" for i in busy])
    around = cut(around)
    seen = link(rows, bounded(around), tuple(key), "inner")
    counts = []
    for i in busy:
        v = value[i]
        for side in ("left", "right"):
            edge = F.col(f"{side}{i}")
            counts += [F.count_if(v < edge).alias(f"under_{side}{i}"), F.count_if(v <= edge).alias(f"upto_{side}{i}")]
    both = link(around, seen.groupBy(*key).agg(*counts), tuple(key))
    changed = {}
    for i in busy:
        c = lambda name: F.col(f"{name}{i}")  # noqa: B023, E731
        open_, r = c("left").isNotNull(), c("r")
        met = F.when((c("under_left") <= r) & (r < c("upto_left")), c("left"))
        met = met.when((c("under_right") <= r) & (r < c("upto_right")), c("right"))
        before, after = open_ & (r < c("under_left")), open_ & (r >= c("upto_right"))
        changed[f"found{i}"] = F.coalesce(c("found"), met)
        changed[f"lo{i}"] = F.when(before | ~open_, c("lo")).when(after, c("right")).otherwise(c("left"))
        changed[f"hi{i}"] = F.when(after | ~open_, c("hi")).when(before, c("left")).otherwise(c("right"))
        changed[f"below{i}"] = F.when(before | ~open_, c("below")).when(after, c("upto_right")).otherwise(c("upto_left"))
        end = F.when(after | ~open_, c("below") + c("inside")).when(before, c("under_left")).otherwise(c("under_right"))
        changed[f"inside{i}"] = end - changed[f"below{i}"]
    return cut(both.withColumns(changed).select(*state.columns))


def picked(rows: DataFrame, key: list[str], state: DataFrame, value: dict[int, Column], names: Sequence[str]) -> DataFrame:
    """Values of the ranks from the rows left inside the brackets, then the neighbour each one leans to."""
    inside = link(rows, bounded(state), tuple(key), "inner")
    near = F.lit(False)
    for i, v in value.items():
        near = near | within(i, v)
    lists = inside.where(near).groupBy(*key).agg(
        *[F.sort_array(F.collect_list(F.when(within(i, v), v))).alias(f"l{i}") for i, v in value.items()]
    )
    met = link(state, lists, tuple(key))
    values = {f"found{i}": F.coalesce(F.col(f"found{i}"), F.get(f"l{i}", (F.col(f"r{i}") - F.col(f"below{i}")).cast("int"))) for i in value}
    met = cut(met.withColumns(values).select(*key, *[f"{c}{i}" for i in value for c in ("found", "h", "r")]))
    after = link(rows, bounded(met), tuple(key), "inner").groupBy(*key).agg(
        *[F.count_if(v <= F.col(f"found{i}")).alias(f"upto{i}") for i, v in value.items()],
        *[F.min(F.when(v > F.col(f"found{i}"), v)).alias(f"next{i}") for i, v in value.items()],
    )
    both = link(met, after, tuple(key))
    out = []
    for i, name in enumerate(names):
        low, r = F.col(f"found{i}"), F.col(f"r{i}")
        high = F.when(r + 1 < F.col(f"upto{i}"), low).otherwise(F.col(f"next{i}"))
        part = F.col(f"h{i}") - r
        out.append(F.when(part > 0, low + (high - low) * part).otherwise(low).cast("double").alias(name))
    return both.select(*key, *out)
