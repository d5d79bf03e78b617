"""Fingerprints and components against plain loops; crowded groups; odd tables."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from obsframe.llm import simhash
from obsframe.llm.components import labels
from tests.conftest import SMALL


def slow_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(marks):
    """doc_id to smallest doc_id, from [(doc_id, fingerprint)]."""
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(marks)), 2):
        if (marks[a][1] ^ marks[b][1]).bit_count() <= 3:
            root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(marks):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, least.get(find(i))) for i, (doc_id, _) in enumerate(marks)]


TEXTS = [None, "", " \n", "One", "one two", "ONE two\tthree", "ÀÉ x y z", "w " * 20_000, "a b c d e f g", "a b c d e f g"]


def test_fingerprints():
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choices("abcdefghij", k=rng.randint(1, 300))) for _ in range(50)]
    assert [simhash.fingerprint((t or "").encode()) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    marks = [(d.doc_id, slow_fingerprint(d.text)) for d in docs]
    want = {d: (f"{f:016x}", c) for (d, f), (_, c) in zip(marks, slow_components(marks))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op4_simhash(spark, SMALL).collect()} == want


def clustered(seed, n=400):
    """Fingerprints around a few centres, some a bit apart, the top bit included."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < n:
        fp = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, 6)):
            fp ^= 1 << b
        out.add(fp)
    return sorted(out)


@pytest.mark.parametrize("seed,crowd", [(0, 2048), (1, 12), (2, 2)])
def test_links_connect_what_pairs_connect(spark, seed, crowd):
    fps = clustered(seed)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.u: r.v for r in labels(simhash.near_links(df, 3, crowd)).collect()}
    want = dict(slow_components([(f, f % (1 << 64)) for f in signed]))
    assert {f: found.get(f, f) for f in signed} == want


@pytest.mark.parametrize("m", [2, 3, 4])
def test_thresholds_cover_all_pairs(m):
    """Every choice the dynamic programme may make finds each pair within the distance."""
    rng = np.random.default_rng(m)
    parts = simhash.correlated_parts(10, rng.integers(0, 10, (64, 64)).astype(float), m)
    assert sorted(b for p in parts for b in p) == list(range(64))
    costs = [{t: float(rng.random()) for t in range(-1, 4)} for _ in parts]
    _, thresholds = simhash.allocate(costs, 3 - m + 1)
    assert sum(thresholds) == 3 - m + 1
    for _ in range(500):
        bits = set(rng.choice(64, 3, replace=False).tolist())
        assert any(len(bits & set(p)) <= t for p, t in zip(parts, thresholds))


def test_probes_of_unequal_thresholds(spark):
    fps = clustered(5, 150)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    bits = list(range(64))
    for parts in ([(bits[:32], 1), (bits[32:], 1)], [(bits[:20], 2), (bits[20:], 0)], [(bits[::3], 1), (bits[1::3], 0), (bits[2::3], 0)]):
        rows = simhash._probes(df, parts).select("group", "fp", "base").repartition(2, "group").sortWithinPartitions("group")
        found = {r.u: r.v for r in labels(rows.mapInArrow(simhash._compare(3), "u long, v long")).collect()}
        assert {f: found.get(f, f) for f in signed} == dict(slow_components([(f, f % (1 << 64)) for f in signed]))


def test_odd_tables(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(9, "a b c d e f g"), (None, "one two"), (None, "lonely words here now")]
    df = spark.createDataFrame([(t, d, 1) for d, t in rows], "text string, doc_id long, fp int")
    want = sorted(map(str, slow_components([(d, slow_fingerprint(t)) for d, t in rows])))
    assert sorted(str((r.doc_id, r.component_id)) for r in simhash.near_duplicates(df).collect()) == want
    stay = simhash.without_near_copies(df)
    assert stay.columns == df.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == sorted([*{str(c) for d, c in slow_components([(d, slow_fingerprint(t)) for d, t in rows])}])
    empty = df.limit(0)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.without_near_copies(empty).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 299), (299, 300)]
    got = {r.u: r.v for r in labels(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {300: 299}
