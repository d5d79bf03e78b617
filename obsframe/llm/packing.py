"""Packing of token sequences into bins of several permitted lengths, by best fit.

A sequence longer than the longest bin is cut into pieces. Pieces are dealt evenly into blocks and each block is
packed on its own: longest piece first, into the open bin that it leaves fullest. Where none has room a bin is
opened, of the size that costs least per token when the largest pieces still waiting fill it up. Since that looks
no further than one bin, the block is also packed with each size opened alone wherever it holds the piece. Every
bin is then downsized to the smallest permitted length of its contents, and the cheapest outcome stays.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.common import blocks, stored, table
from obsframe.llm.tokens import token_counts

CAPACITIES = (512, 1024, 2048, 4096)
#: Pieces packed together: enough that the few bins left open in a block do not matter.
BLOCK_PIECES = 50_000
#: Length at which attention costs as much as the rest of a token's work.
ATTENTION_LENGTH = 16_384


def cost(capacity: int) -> float:
    """Work for a sequence of this length, padding included: linear, and quadratic for attention."""
    return capacity * (1 + capacity / ATTENTION_LENGTH)


def _filled(lengths: list[int], first: int, size: int) -> int:
    """Tokens in a bin of ``size`` that takes piece ``first`` and then, longest first, what still fits."""
    left, i = size - lengths[first], first + 1
    while left > 0:
        i = bisect_left(lengths, -left, lo=i, key=int.__neg__)  # lengths descend
        if i == len(lengths) or not lengths[i]:
            break
        left -= lengths[i]
        i += 1
    return size - left


def _greedy(lengths: list[int], capacities: list[int], only: int | None) -> tuple[list[int], list[list[int]]]:
    """Bins of one pass (as numbers of pieces, longest first) and each bin's contents in tokens."""

    def opened(i: int) -> int:
        sizes = [c for c in capacities if c >= lengths[i]]
        if only is not None:
            return only if only in sizes else sizes[0]
        fills = {c: max(1, _filled(lengths, i, c)) for c in sizes}
        return min(sizes, key=lambda c: (cost(next(s for s in sizes if s >= fills[c])) / fills[c], c))

    room: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]  # open bins by the room they have left
    some = 0  # bit r is set while room[r] has bins
    used, bins = [], []
    for i, length in enumerate(lengths):
        fitting = some >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            number = room[left].pop()
            if not room[left]:
                some ^= 1 << left
        else:
            left, number = opened(i), len(bins)
            bins.append([])
            used.append(0)
        bins[number].append(i)
        used[number] += length
        room[left - length].append(number)
        some |= 1 << (left - length)
    return used, bins


def pack_block(lengths: list[int], capacities: tuple[int, ...]) -> tuple[list[list[int]], list[int]]:
    """Bins as lists of positions in ``lengths``, and the capacity of each."""
    sizes = sorted(set(capacities))
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    ordered = [lengths[i] for i in order]
    best = None
    for only in (None, *sizes):
        used, bins = _greedy(ordered, sizes, only)
        downsized = [next(c for c in sizes if c >= u) for u in used]
        total = sum(map(cost, downsized))
        if best is None or total < best[0]:
            best = total, bins, downsized
    return [[order[i] for i in b] for b in best[1]], best[2]


def pieces(items: DataFrame, longest: int) -> DataFrame:
    """doc_id, piece, start, length: each row of ``items`` (doc_id, n_tokens) cut at ``longest`` tokens."""
    tokens = F.greatest(F.coalesce(F.col("n_tokens"), F.lit(0)), F.lit(0)).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(tokens - 1, F.lit(0)), F.lit(longest).cast("long"))
    cut = items.select("doc_id", tokens.alias("n_tokens"), F.posexplode(starts).alias("piece", "start"))
    return cut.select("doc_id", "piece", "start", F.least(F.col("n_tokens") - F.col("start"), F.lit(longest)).alias("length"))


def _pack(capacities: tuple[int, ...]):
    """Function for mapInArrow: one block of pieces to the same pieces with their places."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = rows.column("length").to_pylist()
        bins, sizes = pack_block(lengths, capacities)
        first = TaskContext.get().partitionId() << 33
        n = len(lengths)
        number, capacity, place = (np.zeros(n, np.int64) for _ in range(3))
        for k, (members, size) in enumerate(zip(bins, sizes)):
            at = 0
            for i in members:
                number[i], capacity[i], place[i] = first + k, size, at
                at += lengths[i]
        rows = rows.append_column("bin_id", pa.array(number)).append_column("capacity", pa.array(capacity))
        yield from rows.append_column("place", pa.array(place)).combine_chunks().to_batches()

    return run


def pack(items: DataFrame, capacities: tuple[int, ...] = CAPACITIES, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """doc_id, piece, start, length, bin_id, capacity, place: where each piece of each row of ``items``
    (doc_id, n_tokens) lies. ``start`` is its offset in the document, ``place`` its offset in the bin.

    Nothing is dropped: a null, negative or zero length is a piece without tokens, rows that repeat are packed
    each, a null doc_id is an id like others. An empty table gives no bins. Other columns are ignored.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities must be positive")
    cut = stored(pieces(items, max(capacities)), "pieces")
    # dealt in turn, not by a key: every block gets an even share whatever the ids are
    dealt = cut.repartition(blocks(cut.count(), block_pieces))
    more = [T.StructField(c, T.LongType()) for c in ("bin_id", "capacity", "place")]
    return dealt.mapInArrow(_pack(tuple(capacities)), T.StructType([*cut.schema.fields, *more]))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(stored(token_counts(table(spark, sf_dir, "documents")), "token-counts"))
