"""Least squares over any number of rows: summed cross products, then small solves."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.session import bounded, cut, group_rows, link, spread

GROUPS = 64  # groups that a key's partial sums are added in before the last step
HELD = 4096  # keys whose sums a task holds before it sends them
SENT = 256  # sums sent together
MOVED_ROWS = 50_000  # most rows of a key that are brought together; the sums of a larger one are fewer than its rows
SUMS = "s array<double>, n bigint"


def fields(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names]


def gram(df: DataFrame, key: Sequence[str], vector: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Sum of v vᵀ per key as a flat array ``g``, for the vector expression v of each row; with ``carry``, columns
    that are the same in all rows of a key, and the number ``n`` of rows."""
    sums = summed(df, key, vector, lambda x: (x.T @ x).ravel(), carry).withColumnRenamed("s", "g")
    return sums if carry else sums.drop("n")


def vector_sum(df: DataFrame, key: Sequence[str], vector: Column) -> DataFrame:
    """Sum ``s`` of a vector expression per key, and the number ``n`` of rows."""
    return summed(df, key, vector, lambda x: x.sum(axis=0))


def summed(
    df: DataFrame, key: Sequence[str], vector: Column, part: Callable[[np.ndarray], np.ndarray], carry: Sequence[str] = ()
) -> DataFrame:
    """Add up ``part(matrix of rows)`` per key.

    A sum may be far larger than a row. Rows of keys up to ``MOVED_ROWS`` are therefore brought together before
    their vectors are worked out, and no sum is shuffled. Of larger keys every task adds up its own rows; only its
    sums are shuffled, and added in two steps, so that a key in all tasks meets no more than its share of them at once.
    """
    key, carry = list(key), list(carry)
    if not key or any(df.schema[k].dataType.typeName() in ("float", "double") for k in key):
        # keys that Spark and Python compare in different ways (NaN, -0.0) are left to Spark
        return spread_sums(df, key, vector, part, carry)
    large = min(MOVED_ROWS, group_rows(df.sparkSession))
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    ends = sizes.agg(F.min("__rows"), F.max("__rows")).first()
    if (ends[1] or 0) <= large:
        return moved_sums(df, key, vector, part, carry)
    if ends[0] > large:
        return spread_sums(df, key, vector, part, carry)
    few = cut(sizes.where(F.col("__rows") > large).select(*key, F.lit(True).alias("__large")))
    marked = link(df, bounded(few), tuple(key))
    most = marked.where(F.col("__large").isNull()).drop("__large")
    rest = marked.where(F.col("__large").isNotNull()).drop("__large")
    return moved_sums(most, key, vector, part, carry).unionByName(spread_sums(rest, key, vector, part, carry))


def moved_sums(df: DataFrame, key: list[str], vector: Column, part: Callable, carry: list[str]) -> DataFrame:
    """The sums of keys whose rows meet in one task, a key after the other."""
    rows = spread(df, *key).sortWithinPartitions(*key).select(*key, *carry, vector.alias("__v"))
    return rows.mapInArrow(task_sums(part, key, carry, whole=True), ", ".join([*fields(rows, [*key, *carry]), SUMS]))


def spread_sums(df: DataFrame, key: list[str], vector: Column, part: Callable, carry: list[str]) -> DataFrame:
    """The sums of keys whose rows stay where they are."""
    rows = df.select(*key, *carry, vector.alias("__v"))
    shape = ", ".join(["__group int", SUMS])
    sums = rows.mapInArrow(task_sums(part, key, carry, whole=False), ", ".join([*fields(rows, [*key, *carry]), shape]))
    for by in ([*key, "__group"], key):
        sums = sums.groupBy(*by).applyInPandas(adder((*by, *carry)), ", ".join([*fields(sums, [*by, *carry]), SUMS]))
    return sums


def task_sums(part: Callable, key: list[str], carry: list[str], whole: bool):
    """Function for mapInArrow: the sums of a task's rows. With ``whole`` the rows come sorted by key, and a key's sum
    is sent once it is complete; else sums are sent when many keys are held, marked with a group."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() % GROUPS
        sums: dict[tuple, list] = {}

        def sent(keys: list[tuple]) -> pa.RecordBatch:
            taken = [sums.pop(k) for k in keys]
            columns = {c: pa.array([k[i] for k in keys], kinds[c]) for i, c in enumerate(key)}
            columns |= {c: pa.array([t[2][i] for t in taken], kinds[c]) for i, c in enumerate(carry)}
            if not whole:
                columns["__group"] = pa.array([group] * len(keys), pa.int32())
            columns["s"] = pa.array([t[0] for t in taken], pa.list_(pa.float64()))
            columns["n"] = pa.array([t[1] for t in taken], pa.int64())
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        kinds: dict[str, pa.DataType] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = {c: batch.schema.field(c).type for c in [*key, *carry]}
            values = batch.column("__v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for keys, at in by_key(batch, key, np.arange(batch.num_rows)):
                if keys not in sums:
                    sums[keys] = [0.0, 0, [batch.column(c)[int(at[0])].as_py() for c in carry]]
                held = sums[keys]
                held[0] = held[0] + part(values[at])
                held[1] += len(at)
            if whole:
                last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in key)
                done = [k for k in sums if k != last]
            else:
                done = list(sums) if len(sums) >= HELD else []
            for i in range(0, len(done), SENT):
                yield sent(done[i : i + SENT])
        done = list(sums)
        for i in range(0, len(done), SENT):
            yield sent(done[i : i + SENT])

    return partial


def by_key(batch: pa.RecordBatch, key: Sequence[str], values: np.ndarray) -> Iterator[tuple[tuple, np.ndarray]]:
    """The rows of ``values`` that each key of a batch has; a null key is a key like any other."""
    codes = np.zeros(batch.num_rows, dtype=np.int64)
    for c in key:
        encoded = batch.column(c).dictionary_encode(null_encoding="encode")
        _, codes = np.unique(codes * len(encoded.dictionary) + encoded.indices.to_numpy(), return_inverse=True)
    order = np.argsort(codes, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
        yield tuple(batch.column(c)[int(rows[0])].as_py() for c in key), values[rows]


def plain(key: Sequence) -> tuple:
    """Key values that compare as Spark's do."""
    return tuple("NaN" if v != v else v for v in key)


def adder(by: Sequence[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return one_row(pdf, by, {"s": np.sum(np.stack(pdf["s"].to_numpy()), axis=0), "n": int(pdf["n"].sum())})

    return total


def one_row(pdf: pd.DataFrame, keys: Sequence[str], values: dict) -> pd.DataFrame:
    return pd.DataFrame({k: [pdf[k].iloc[0]] for k in keys} | {n: [v] for n, v in values.items()})


def solve_rows(df: DataFrame, keep: Sequence[str], solve: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """Apply a small solver to each row; it yields the result rows of that key."""
    keep = list(keep)
    names = [part.strip().split(" ")[0].strip("`") for part in split_schema(schema)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for record in pdf.to_dict("records"):
                head = {k: record[k] for k in keep}
                out += [head | r for r in solve(record)]
            yield pd.DataFrame(out, columns=[*keep, *names])

    return df.mapInPandas(run, ", ".join([*fields(df, keep), schema]))


def split_schema(schema: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(schema[start:i])
            start = i + 1
    return [*out, schema[start:]]


def square(flat) -> np.ndarray:
    g = np.asarray(flat, dtype=float)
    p = int(round(np.sqrt(len(g))))
    return g.reshape(p, p)


def ols(g: np.ndarray, columns: Sequence[int], target: int, ridge: np.ndarray | float = 0.0) -> tuple[np.ndarray, float]:
    """Coefficients of ``columns`` for ``target`` and the residual sum of squares."""
    c = list(columns)
    a, rhs = g[np.ix_(c, c)], g[c, target]
    penal = a + np.diag(np.broadcast_to(np.asarray(ridge, dtype=float), len(c)))
    try:
        beta = np.linalg.solve(penal, rhs)
    except np.linalg.LinAlgError:
        beta = np.linalg.lstsq(penal, rhs, rcond=None)[0]
    ssr = float(g[target, target] - 2 * beta @ rhs + beta @ a @ beta)
    return beta, max(ssr, 0.0)


def dot(a: str, b: Column) -> Column:
    """Inner product of a coefficient array column and an expression array."""
    return F.aggregate(F.zip_with(F.col(a), b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
