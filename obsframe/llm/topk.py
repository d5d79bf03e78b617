"""Exact top-k search by the three-phase uniform threshold.

The dimensions are dealt into lists; a list holds, for each query, every vector's partial score. A node owns a
list for a tile of the vectors and a block of the queries.

1. Every node sends its k best partial scores per query. The pairs named are scored exactly; the k-th best of a
   query is a cutoff tau that its k-th result cannot fall below.
2. A vector with a score of tau or more has a partial score of tau / lists or more in some list. Every node sends
   all entries that reach it. Pairs seen in all lists are scored by that, which may raise tau.
3. A pair not seen in some list has less than the threshold there. Where the sum could still reach tau, the nodes
   of the missing lists look the rest up.

Scores are inner products of integers, so they are exact and ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsframe.llm.common import blocks, stored, table

#: Vectors of a tile and queries of a block: what one node holds.
TILE_ROWS = 4096
BLOCK_ROWS = 4096
LISTS = 2
#: Float products are exact below this; beyond it integers are multiplied.
EXACT = 1 << 53

NODE = ("dim", "list", "tile", "block")
SHAPE = "dim int, list int, tile int, block int, query_id long, vec_id long, part long"


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, x (array of long): floor(scale * component); vectors that are null or hold a null, infinite or
    undefined component are left out. Of rows that share a vec_id the one with the smallest vector counts; a
    null vec_id takes no part."""
    wide = F.transform("embedding", lambda c: c.cast("double"))
    odd = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    whole = F.transform(wide, lambda c: F.floor(F.lit(scale) * c))
    return usable.select("vec_id", whole.alias("x")).groupBy("vec_id").agg(F.min("x").alias("x"))


def _slices(rows: DataFrame, lists: int) -> DataFrame:
    """A row per list, with the list's share of the dimensions."""
    size = F.size("x")
    share = F.ceil(size / F.lit(lists)).cast("int")
    cut = lambda j: F.slice("x", F.least(j * share, size) + 1, F.greatest(share, F.lit(0)))
    piece = F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), lambda j: F.struct(j.alias("list"), cut(j).alias("x")))
    return rows.withColumn("dim", size).withColumn("s", F.explode(piece)).drop("x").select("*", "s.list", "s.x").drop("s")


def _deal(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    lists = column.combine_chunks()
    rows = len(lists)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(dtype) if rows else np.zeros((0, 0), dtype)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products, exact."""
    top = lambda m: int(np.abs(m).max(initial=0))
    if max(1, vectors.shape[1]) * top(queries) * top(vectors) < EXACT:
        return queries.astype(np.float64) @ vectors.astype(np.float64).T
    return queries @ vectors.T


def _node(work):
    """Function for applyInArrow on a node's rows: kind 0 vectors, 1 queries, 2 pairs to be looked up."""
    schema = pa.schema(
        [(n, pa.int32()) for n in NODE] + [("query_id", pa.int64()), ("vec_id", pa.int64()), ("part", pa.int64())]
    )

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        kind = rows.column("kind").to_numpy()
        vectors, queries, pairs = (rows.filter(pa.array(kind == k)) for k in range(3))
        ids, asked = vectors.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        found = work(ids, _matrix(vectors.column("x"), np.int64), asked, _matrix(queries.column("x"), np.int64), queries, pairs)
        n = len(found[0])
        node = [pa.array(np.full(n, k.as_py(), np.int32)) for k in key]
        return pa.Table.from_arrays([*node, *[pa.array(np.asarray(c, dtype=np.int64)) for c in found]], schema=schema)

    return run


def _parts_of(work):
    """Runs ``work`` on 256 queries of a node at a time: the scores of all its vectors."""

    def run(ids, vectors, asked, queries, table_, pairs):
        out = [[], [], []]
        for i in range(0, len(asked) if len(ids) else 0, 256):
            part = _scores(queries[i : i + 256], vectors)
            row, column = work(part, ids, asked[i : i + 256], table_.slice(i, 256))
            for held, new in zip(out, (asked[i + row], ids[column], part[row, column])):
                held.append(new)
        return [np.concatenate(o) if o else np.zeros(0) for o in out]

    return run


def _best(k: int):
    """Positions of each query's k best partial scores, its own vector left out."""

    def work(part, ids, asked, _):
        part = np.where(ids[None, :] == asked[:, None], -np.inf, part)
        keep = min(k, part.shape[1])
        column = np.argpartition(-part, keep - 1, axis=1)[:, :keep]
        row = np.repeat(np.arange(len(asked)), keep)
        column = column.ravel()
        real = ids[column] != asked[row]
        return row[real], column[real]

    return _parts_of(work)


def _reaching(lists: int):
    """Positions of the partial scores that reach the threshold of their query."""

    def work(part, ids, asked, queries):
        tau = queries.column("tau").to_numpy()
        reach = (part * lists >= tau[:, None]) & (ids[None, :] != asked[:, None])
        return np.nonzero(reach)

    return _parts_of(work)


def _look_up(ids, vectors, asked, queries, table_, pairs):
    """Partial scores of the pairs asked for."""
    query_id, vec_id = pairs.column("query_id").to_numpy(), pairs.column("vec_id").to_numpy()
    by_query, by_id = np.argsort(asked), np.argsort(ids)
    q = by_query[np.searchsorted(asked[by_query], query_id)] if len(asked) else np.zeros(0, np.int64)
    v = by_id[np.searchsorted(ids[by_id], vec_id)] if len(ids) else np.zeros(0, np.int64)
    part = np.zeros(len(query_id), np.int64)
    for i in range(0, len(part), 1 << 16):
        part[i : i + (1 << 16)] = np.einsum("ij,ij->i", queries[q[i : i + (1 << 16)]], vectors[v[i : i + (1 << 16)]])
    return query_id, vec_id, part


def _kth(scored: DataFrame, k: int) -> DataFrame:
    """query_id, tau: the k-th best score of each query that has k."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.select("query_id", "vec_id", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    return ranked.where(F.col("rank") == k).select("query_id", F.col("score").alias("tau"))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, lists: int = LISTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors with the greatest inner product, ties to the smaller id.

    Both frames have vec_id and x (array of long, without nulls), one row per vec_id. A query's own vec_id is
    no result of it; vectors are compared with those of their own dimension; a query with fewer than k others
    gets them all. Empty frames give no rows. Products must stay within 64 bits.
    """
    spark = vectors.sparkSession
    vectors = stored(vectors.select("vec_id", "x"), "vectors")
    asked = stored(queries.select(F.col("vec_id").alias("query_id"), "x"), "queries")
    # of equal vectors only the k + 1 smallest ids can be results
    alike = Window.partitionBy("x").orderBy("vec_id")
    rows = vectors.withColumn("n", F.row_number().over(alike)).where(F.col("n") <= k + 1).drop("n")
    rows = stored(rows, "candidates")
    tiles, parts = blocks(rows.count(), TILE_ROWS), blocks(asked.count(), BLOCK_ROWS)
    tile, block = _deal("vec_id", tiles), _deal("query_id", parts)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("long")

    held = _slices(rows.withColumn("tile", tile), lists)
    held = stored(held.withColumn("block", every(parts)), "slices").select(
        *NODE, F.lit(0).alias("kind"), none.alias("query_id"), "vec_id", "x", none.alias("tau")
    )
    sought = _slices(asked.withColumn("block", block), lists)
    sought = stored(sought.withColumn("tile", every(tiles)), "sought")

    def at_nodes(work, tau: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
        asking = sought.withColumn("tau", none) if tau is None else sought.join(tau, "query_id", "left").withColumn(
            "tau", F.coalesce("tau", F.lit(-(1 << 62)))
        )
        inputs = held.union(asking.select(*NODE, F.lit(1), "query_id", none, "x", "tau"))
        if pairs is not None:
            dims = asked.select("query_id", F.size("x").alias("dim"))
            placed = pairs.join(dims, "query_id").withColumns({"tile": tile, "block": block})
            inputs = inputs.union(
                placed.select(*NODE, F.lit(2), "query_id", "vec_id", F.array().cast("array<bigint>"), none)
            )
        return inputs.groupBy(*NODE).applyInArrow(_node(work), SHAPE).select("list", "query_id", "vec_id", "part")

    def totals(parts_: DataFrame) -> DataFrame:
        seen = F.bit_or(F.expr("shiftleft(1, list)"))
        return parts_.groupBy("query_id", "vec_id").agg(F.sum("part").alias("score"), seen.alias("seen"))

    all_lists = (1 << lists) - 1
    numbers = F.sequence(F.lit(0), F.lit(lists - 1))
    absent = F.explode(F.filter(numbers, lambda j: F.getbit(F.col("seen").cast("long"), j) == 0))

    def completed(known: DataFrame) -> DataFrame:
        """Scores of pairs that some list has not sent yet."""
        missing = known.select("query_id", "vec_id", absent.alias("list"))
        rest = at_nodes(_look_up, pairs=missing).select("query_id", "vec_id", F.col("part").alias("score"))
        both = rest.union(known.select("query_id", "vec_id", "score"))
        return both.groupBy("query_id", "vec_id").agg(F.sum("score").alias("score"))

    first = stored(totals(at_nodes(_best(k))), "phase1")
    exact = stored(completed(first), "phase1-exact")
    tau = stored(_kth(exact, k), "tau")

    second = stored(totals(at_nodes(_reaching(lists), tau)), "phase2")
    whole = second.where(F.col("seen") == all_lists).select("query_id", "vec_id", "score")
    raised = _kth(whole.union(exact).distinct(), k)
    rest = second.where(F.col("seen") != all_lists)
    rest = rest.join(tau.withColumnRenamed("tau", "old"), "query_id", "left").join(raised, "query_id", "left")
    unseen = F.lit(lists) - F.bit_count("seen")
    possible = F.col("score") + unseen * F.ceil(F.col("old") / F.lit(lists)) >= F.col("tau")
    rest = stored(rest.where(F.col("tau").isNull() | F.col("old").isNull() | possible).select("query_id", "vec_id", "score", "seen"), "phase3")
    scored = completed(rest).union(whole).union(exact).distinct()

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stored(quantised(table(spark, sf_dir, "embeddings")), "quantised")
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
