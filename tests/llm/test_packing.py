"""Packing against a plain form of the same rules, the optimum of small cases, and odd tables."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from obsframe.llm import packing
from tests.conftest import SMALL


def plain(lengths, sizes):
    """The rules by scanning all open bins and all waiting pieces."""
    ordered, totals = sorted(lengths, reverse=True), []

    def filled(i, size):
        left = size - ordered[i]
        for x in ordered[i + 1 :]:
            left -= x if x <= left else 0
        return max(1, size - left)

    def price(i, size):
        return packing.cost(min(c for c in sizes if c >= filled(i, size))) / filled(i, size), size

    for only in (None, *sizes):
        bins = []
        for i, x in enumerate(ordered):
            fit = [b for b in bins if b[0] >= x]
            if fit:
                b = min(fit, key=lambda b: b[0])
            else:
                able = [c for c in sizes if c >= x]
                size = min(able, key=lambda c: price(i, c)) if only is None else only if only in able else min(able)
                b = [size, 0]
                bins.append(b)
            b[0] -= x
            b[1] += x
        totals.append(sum(packing.cost(min(c for c in sizes if c >= b[1])) for b in bins))
    return min(totals)


def optimum(lengths, sizes):
    """Least cost over all partitions of a few pieces."""
    if not lengths:
        return 0.0
    first, rest, best = lengths[0], lengths[1:], float("inf")
    for mask in range(1 << len(rest)):
        load = first + sum(x for i, x in enumerate(rest) if mask >> i & 1)
        if load <= max(sizes):
            own = packing.cost(min(c for c in sizes if c >= load))
            best = min(best, own + optimum([x for i, x in enumerate(rest) if not mask >> i & 1], sizes))
    return best


def checked(lengths, sizes):
    bins, capacities = packing.pack_block(lengths, sizes)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    for b, c in zip(bins, capacities):
        load = sum(lengths[i] for i in b)
        assert c == min(s for s in sizes if s >= load)
    return sum(map(packing.cost, capacities))


@pytest.mark.parametrize("seed", range(40))
def test_block(seed):
    rng = random.Random(seed)
    sizes = tuple(sorted(rng.sample(range(5, 60), rng.randint(1, 4))))
    lengths = [rng.randint(0, sizes[-1]) for _ in range(rng.choice([0, 1, 7, 60]))]
    got = checked(lengths, sizes)
    assert got == pytest.approx(plain(lengths, sizes))
    if len(lengths) <= 7:
        assert got <= 1.6 * optimum(lengths, sizes) + 1e-9


def test_several_sizes_beat_one():
    rng = random.Random(1)
    for lengths in ([rng.randint(1, 4096) for _ in range(2000)], [1101] * 2000, [512] * 100 + [513] * 100):
        assert checked(lengths, packing.CAPACITIES) <= min(checked(lengths, (4096,)), plain(lengths, (4096,)))


def verify(rows, items, sizes):
    """All tokens once, no overlap in a bin, bins as small as permitted."""
    tokens, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        tokens[r.doc_id].append((r.start, r.length))
        bins[r.bin_id].append((r.place, r.length, r.capacity))
    want = defaultdict(list)
    for doc_id, n in items:
        n = max(n or 0, 0)
        want[doc_id] += [(s, min(max(sizes), n - s)) for s in range(0, max(n, 1), max(sizes))]
    assert {k: sorted(v) for k, v in tokens.items()} == {k: sorted(v) for k, v in want.items()}
    for members in bins.values():
        at = 0
        for place, length, _ in sorted(members):
            assert place == at
            at += length
        assert {c for _, _, c in members} == {min(s for s in sizes if s >= at)}


def test_query(spark):
    rows = packing.op3_best_fit_packing(spark, SMALL).collect()
    counts = packing.token_counts(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    verify(rows, [(r.doc_id, r.n_tokens) for r in counts], packing.CAPACITIES)
    bins = {r.bin_id: r.capacity for r in rows}
    assert sum(r.length for r in rows) / sum(bins.values()) > 0.9


def test_odd_items_in_blocks(spark):
    items = [(1, None), (1, None), (2, -5), (None, 7), (3, 0), (4, 100), (4, 100), (5, 8)] + [(i, i % 9) for i in range(10, 60)]
    df = spark.createDataFrame([(i, n, "x") for i, n in items], "doc_id long, n_tokens long, bin_id string")
    verify(packing.pack(df, (4, 8), block_pieces=20).collect(), items, (4, 8))
    assert packing.pack(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, ())


def test_workers_forget_the_words_they_counted(spark, tmp_path):
    """Workers live on in other stages: what counting tokens remembers goes with its task."""
    import shutil

    from obsframe.llm import tokens

    path = shutil.copy(tokens.default_tokenizer(), tmp_path / "own.json")
    docs = spark.createDataFrame([(i, f"word{i} another{i} third") for i in range(400)], "doc_id long, text string")
    assert tokens.token_counts(docs, str(path)).count() == 400

    def held(batches):
        import pyarrow as pa

        for _ in batches:
            known = [len(e.known) for p, e in tokens._encoders.items() if p == str(path)]
            yield pa.RecordBatch.from_pydict({"n": pa.array(known or [0], pa.int64())})

    assert spark.range(64).repartition(16).mapInArrow(held, "n long").agg({"n": "max"}).first()[0] <= 1
