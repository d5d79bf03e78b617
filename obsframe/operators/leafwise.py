"""Boosted regression trees grown leaf by leaf, best gain first, from histograms that tasks add up."""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.session import cut

DIRECT = 16  # parts whose histograms the driver adds itself; more are added in tasks first
PENDING = 10  # trees that tasks apply on the way; then the residuals are written anew
WHOLE = 100_000  # rows up to which one task makes all passes; the trees are the same
SUMMARY = 1e-4  # rank error of the cuts, a few hundredths of a bin
SLICE = 8192  # rows whose cells are held at once
HISTOGRAM = "node int, feature int, cells binary"


@dataclass
class BinnedTree:
    """Nodes as arrays over bin numbers; a leaf leads to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def landed(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        at, row = np.zeros(len(bins), int), np.arange(len(bins))
        for _ in range(self.depth):
            at = np.where(bins[row, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return at


@dataclass
class Node:
    count: int
    total: int  # sum of the residuals, in whole units
    depth: int
    gain: float = 0.0  # 0: a leaf for good
    feature: int = 0
    cut: int = 0
    low: tuple[int, int] = (0, 0)  # count and total at or below the cut
    left: int = -1  # -1: the children are not known yet; the right one follows the left one


class LeafwiseBooster:
    """Squared-error boosting whose trees have a bound on their leaves instead of their depth.

    Always the leaf with the largest gain is split (ties: the older leaf, then the first
    feature, then the lowest cut). The splits of the leaves that may come next are looked for in
    one pass over the rows, and the choice is replayed with what the pass brought, so a tree
    takes about as many passes as it has levels and is the one that splitting leaf by leaf
    gives. Of two siblings the smaller is counted, the other is its parent less it.

    Cuts lie at quantiles, read off mergeable summaries of all rows; beyond some thousands of
    rows they are close, not exact, and may differ with how rows are dealt to tasks.

    Residuals are whole units: sums are exact, so neither the order of tasks nor a repeated
    task changes a tree once the cuts are drawn. Squared error never grows, so no sum passes the number of rows times
    the largest first residual, and the unit is chosen for that.

    Histograms are bounded by leaves, features and bins, not by rows. Rows without a label are
    left out; NaN inputs lie above every cut. No rows: a model that predicts 0. A constant label
    or fewer than 2 * ``min_leaf`` rows: its mean.
    """

    def __init__(self, rounds: int = 100, leaves: int = 31, rate: float = 0.1, bins: int = 255, min_leaf: int = 20):
        if not 2 <= bins <= 256 or leaves < 2 or not 0 < rate <= 1 or min_leaf < 1:
            raise ValueError("bins in 2..256, at least two leaves, a rate in (0, 1] and a positive min_leaf")
        self.rounds, self.leaves, self.rate, self.bins, self.min_leaf = rounds, leaves, rate, bins, min_leaf

    def fit(self, rows: DataFrame) -> LeafwiseModel:
        """``rows`` has a vector ``features`` and a number ``label``."""
        label = F.col("label").cast("double")
        rows = rows.where(label.isNotNull() & ~F.isnan(label)).select(vector_to_array("features").alias("x"), label.alias("label"))
        known = rows.agg(F.count("*").alias("n"), F.avg("label").alias("mean"), F.first(F.size("x")).alias("width")).first()
        if not known.n:
            return LeafwiseModel([], [], 0.0)
        self.width = known.width
        columns = [f"f{i}" for i in range(self.width)]
        values = rows.select(*[F.col("x")[i].alias(c) for i, c in enumerate(columns)])
        probes = [i / self.bins for i in range(1, self.bins)]
        edges = [np.unique(q) for q in values.approxQuantile(columns, probes, SUMMARY)]
        binned = self.binned(rows, edges, known.mean)
        spread = binned.select(F.abs("residual").alias("size"), F.spark_partition_id().alias("part"))
        spread = spread.agg(F.max("size").alias("top"), F.count_distinct("part").alias("parts")).first()
        self.parts = spread.parts
        bits = min(36, 62 - int(known.n).bit_length())
        self.unit = spread.top / 2.0**bits or 1.0
        trees, gains = self.in_a_task(binned) if known.n <= WHOLE else self.in_passes(binned)
        return LeafwiseModel(trees, edges, known.mean, gains)

    def in_passes(self, binned: DataFrame) -> tuple[list[BinnedTree], np.ndarray]:
        trees: list[BinnedTree] = []
        pending: list[BinnedTree] = []
        gains = np.zeros(self.width)
        for _ in range(self.rounds):
            tree = self.grown(partial(self.histograms, binned, pending), gains)
            trees.append(tree)
            pending.append(tree)
            if len(pending) == PENDING and len(trees) < self.rounds:
                binned, pending = self.renewed(binned, pending), []
        return trees, gains

    def in_a_task(self, binned: DataFrame) -> tuple[list[BinnedTree], np.ndarray]:
        """The same passes over rows that one task holds."""

        def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [unpacked(pdf, []) for pdf in batches if len(pdf)]
            if not held:
                return
            bins, residual = (np.concatenate(part) for part in zip(*held))
            trees, gains = [], np.zeros(self.width)

            def count(tree: BinnedTree, wanted: list[int]) -> dict[int, np.ndarray]:
                cells = self.cells(bins, residual, tree, wanted)
                return {node: cells[:, k] for k, node in enumerate(wanted)}

            for _ in range(self.rounds):
                trees.append(self.grown(count, gains))
                residual -= trees[-1].value[trees[-1].landed(bins)]
            yield pd.DataFrame({"model": [pickle.dumps((trees, gains))]})

        return pickle.loads(binned.coalesce(1).mapInPandas(grow, "model binary").first().model)

    def binned(self, rows: DataFrame, edges: list[np.ndarray], mean: float) -> DataFrame:
        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    bins = bin_numbers(np.stack(pdf["x"].to_numpy()), edges)
                    yield pd.DataFrame({"bins": [b.tobytes() for b in bins], "residual": pdf["label"] - mean})

        return cut(rows.mapInPandas(place, "bins binary, residual double"))

    def renewed(self, binned: DataFrame, pending: list[BinnedTree]) -> DataFrame:
        def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                bins, residual = unpacked(pdf, pending)
                if len(bins):
                    yield pdf.assign(residual=residual)

        return cut(binned.mapInPandas(apply, "bins binary, residual double"))

    def cells(self, bins: np.ndarray, residual: np.ndarray, tree: BinnedTree, wanted: list[int]) -> np.ndarray:
        """Rows and their residuals in whole units by (wanted node, feature, bin)."""
        shape = (2, len(wanted), self.width, self.bins)
        slot = np.full(len(tree.left), -1)
        slot[wanted] = np.arange(len(wanted))
        at, out = slot[tree.landed(bins)], np.zeros((2, math.prod(shape[1:])), np.int64)
        mine = np.flatnonzero(at >= 0)
        for start in range(0, len(mine), SLICE):
            part = mine[start : start + SLICE]
            cell = ((at[part][:, None] * self.width + np.arange(self.width)) * self.bins + bins[part]).ravel()
            whole = np.repeat(np.rint(residual[part] / self.unit), self.width)
            out[0] += np.bincount(cell, minlength=out.shape[1])
            out[1] += np.bincount(cell, whole, out.shape[1]).astype(np.int64)
        return out.reshape(shape)

    def histograms(
        self, binned: DataFrame, pending: list[BinnedTree], tree: BinnedTree, wanted: list[int]
    ) -> dict[int, np.ndarray]:
        """Per wanted node, rows and summed residuals by (feature, bin): an array (2, features, bins)."""
        width, bins_ = self.width, self.bins

        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            each = np.zeros((2, len(wanted), width, bins_), np.int64)
            for pdf in batches:
                if len(pdf):
                    each += self.cells(*unpacked(pdf, pending), tree, wanted)
            for k, node in enumerate(wanted):
                packed = [each[:, k, f].tobytes() for f in range(width)]
                yield pd.DataFrame({"node": node, "feature": range(width), "cells": packed})

        def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for pdf in batches:
                for node, feature, packed in pdf.itertuples(index=False):
                    held = sums.setdefault((node, feature), np.zeros(2 * bins_, np.int64))
                    held += np.frombuffer(packed, np.int64)
            for (node, feature), held in sums.items():
                yield pd.DataFrame({"node": [node], "feature": [feature], "cells": [held.tobytes()]})

        parts = binned.mapInPandas(counted, HISTOGRAM)
        if self.parts > DIRECT:
            parts = parts.repartition("node", "feature").mapInPandas(added, HISTOGRAM)
        out = {node: np.zeros((2, width, bins_), np.int64) for node in wanted}
        for node, feature, packed in parts.collect():  # at most DIRECT, or one, per node and feature
            out[node][:, feature] += np.frombuffer(packed, np.int64).reshape(2, bins_)
        return out

    def best(self, node: Node, cells: np.ndarray) -> None:
        """Note the split of the largest gain, if one leaves ``min_leaf`` rows on both sides."""
        n, s = cells[:, :, :-1].cumsum(axis=2)
        rest = node.count - n
        able = (n >= self.min_leaf) & (rest >= self.min_leaf)
        if not able.any():
            return
        own = float(node.total) ** 2 / node.count
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = s.astype(float) ** 2 / n + (node.total - s).astype(float) ** 2 / rest - own
        gain = np.where(able, gain, -1.0)
        feature, at = np.unravel_index(int(gain.argmax()), gain.shape)
        if gain[feature, at] > 1e-9 * own:  # less is rounding
            node.gain, node.feature, node.cut = float(gain[feature, at]), int(feature), int(at)
            node.low = int(n[feature, at]), int(s[feature, at])

    def replay(self, nodes: list[Node]) -> list[int]:
        """The nodes split by always taking the largest gain, as far as gains are known."""
        heap, chosen = [(-nodes[0].gain, 0)], []
        while heap and len(chosen) < self.leaves - 1:
            gain, i = heapq.heappop(heap)
            if gain == 0.0:
                break
            chosen.append(i)
            if nodes[i].left >= 0:
                for child in (nodes[i].left, nodes[i].left + 1):
                    heapq.heappush(heap, (-nodes[child].gain, child))
        return chosen

    def grown(self, count: Callable[[BinnedTree, list[int]], dict[int, np.ndarray]], gains: np.ndarray) -> BinnedTree:
        """One tree from counts of wanted nodes; ``gains`` takes in what each feature brought."""
        stump = flat([Node(0, 0, 0)], [], lambda node: 0.0)
        held = count(stump, [0])
        nodes = [Node(int(held[0][0, 0].sum()), int(held[0][1, 0].sum()), 0)]
        self.best(nodes[0], held[0])
        while True:
            chosen = self.replay(nodes)
            open_ = [i for i in chosen if nodes[i].left < 0]
            full = len(chosen) == self.leaves - 1
            # nothing is split after the last one: its children need no histogram
            asked = [i for i in open_ if not (full and i == chosen[-1])]
            wanted = []
            for i in asked or open_:
                small = with_children(nodes, i)
                if asked and nodes[2 * nodes[i].left + 1 - small].count >= 2 * self.min_leaf:
                    wanted.append((i, small))
            if wanted:
                inner = [i for i, node in enumerate(nodes) if node.left >= 0]
                got = count(flat(nodes, inner, lambda node: 0.0), [small for _, small in wanted])
                for i, small in wanted:
                    other = 2 * nodes[i].left + 1 - small
                    held[small], held[other] = got[small], held.pop(i) - got[small]
                    for child in (small, other):
                        self.best(nodes[child], held[child])
            if not asked:
                break
        for i in chosen:
            gains[nodes[i].feature] += nodes[i].gain
        return flat(nodes, chosen, lambda node: self.rate * self.unit * node.total / node.count if node.count else 0.0)


def with_children(nodes: list[Node], i: int) -> int:
    """Append the children of a node that is split; the one with fewer rows."""
    node = nodes[i]
    n, total = node.low
    node.left = len(nodes)
    nodes.append(Node(n, total, node.depth + 1))
    nodes.append(Node(node.count - n, node.total - total, node.depth + 1))
    return node.left if 2 * n <= node.count else node.left + 1


def flat(nodes: Sequence[Node], inner: Sequence[int], value) -> BinnedTree:
    """The tree that splits the nodes ``inner``, numbered so that children come after their parent."""
    split, order = set(inner), [0]
    for i in order:
        if i in split:
            order += [nodes[i].left, nodes[i].left + 1]
    if len(inner) == sum(node.left >= 0 for node in nodes):  # nothing is left out: numbers stay
        order = list(range(len(nodes)))
    at = {i: k for k, i in enumerate(order)}
    pick = [nodes[i] for i in order]
    here = [i in split for i in order]
    left = np.array([at[n.left] if s else k for k, (n, s) in enumerate(zip(pick, here))])
    return BinnedTree(
        np.array([n.feature if s else 0 for n, s in zip(pick, here)]),
        np.array([n.cut if s else 255 for n, s in zip(pick, here)]),
        left,
        np.array([at[n.left + 1] if s else k for k, (n, s) in enumerate(zip(pick, here))]),
        np.array([0.0 if s else value(n) for n, s in zip(pick, here)]),
        max(n.depth for n in pick),
    )


def bin_numbers(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """A value's bin is the number of edges below it, so that bin <= k says value <= edge k."""
    return np.column_stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]).astype(np.uint8)


def unpacked(pdf: pd.DataFrame, trees: Sequence[BinnedTree]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a batch, and its residuals less what the trees explain."""
    if not len(pdf):
        return np.zeros((0, 0), np.uint8), np.zeros(0)
    bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), -1)
    residual = pdf["residual"].to_numpy(dtype=float).copy()
    for tree in trees:
        residual -= tree.value[tree.landed(bins)]
    return bins, residual


class LeafwiseModel:
    """A mean and the trees added to it."""

    def __init__(self, trees: list[BinnedTree], edges: list[np.ndarray], mean: float, gains: np.ndarray | None = None):
        self.binned, self.edges, self.mean = trees, edges, mean
        total = 0.0 if gains is None else gains.sum()
        self.featureImportances = DenseVector(gains / total if total else np.zeros(len(edges)))

    def nodes(self) -> list[list[tuple]]:
        """Every tree as (feature, cut, left, right, value) over the inputs themselves; the mean comes first."""
        out = [[(0, math.inf, 0, 0, self.mean)]]
        for t in self.binned:
            rows = zip(t.feature, t.cut, t.left, t.right, t.value)
            out.append(
                [
                    (int(f), float(self.edges[f][c]) if a != i else math.inf, int(a), int(b), float(v))
                    for i, (f, c, a, b, v) in enumerate(rows)
                ]
            )
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` to rows with a vector ``features``."""
        trees, edges, mean = self.binned, self.edges, self.mean

        def predicted(x: pd.Series) -> pd.Series:
            total = np.full(len(x), mean)
            if len(x) and trees:
                bins = bin_numbers(np.stack(x.to_numpy()), edges)
                for tree in trees:
                    total += tree.value[tree.landed(bins)]
            return pd.Series(total)

        return df.withColumn("prediction", F.pandas_udf(predicted, "double")(vector_to_array("features")))
