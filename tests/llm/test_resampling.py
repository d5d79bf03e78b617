"""Resampling against SQL on the tables and against a plain computation for every order and head."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import pytest

from obsframe.llm import resampling as R
from tests.compare import compare
from tests.conftest import SMALL
from tests.llm.test_decontaminate import words_of


def test_query(spark, con):
    result = R.op13_resampling(spark, SMALL)
    assert compare(result, con, R.OP13_SQL) is None
    assert [t for _, t in result.dtypes] == ["bigint"] * 5


def plain(docs, target, percent, order, buckets, least):
    def features(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, order + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for _, text in target:
        t.update(features(text))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(float((t[b] + 1) * (S + buckets)) / float((s[b] + 1) * (T + buckets))))
    rows = []
    for doc_id, text in docs:
        f = features(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(f), weight, weight + noise, len(words_of(text)) >= least])
    usable = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0]))
    drawn = usable[: percent * len(usable) // 100]
    return Counter(tuple(r[:4]) for r in rows), [(r[0], r[3]) for r in drawn]


TEXT = "doc_id long, text string, score string"


def check(spark, docs, target, percent, order, buckets, least, head):
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], TEXT)
    wanted = spark.createDataFrame([(i, t, "x") for i, t in target], TEXT)
    got = R.resample(frame, wanted, percent, order, buckets, least_words=least, head=head).collect()
    rows, drawn = plain(docs, target, percent, order, buckets, least)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == rows
    ranked = sorted((r["rank"], r.doc_id, r.score) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranked] == drawn


@pytest.mark.parametrize("order,buckets,head,percent", [(1, 50, 3, 40), (2, 97, 4, 50), (2, 70_000, 10**4, 100), (3, 31, 2, 10)])
def test_orders(spark, order, buckets, head, percent):
    rng = random.Random(order * head)
    text = lambda: " ".join(rng.choice(["a", "B,", "cé", "d", "é!", "f\n"]) for _ in range(rng.randint(0, 40)))
    docs = [(i, text()) for i in range(60)] + [(7, "a d"), (7, "a d"), (None, "d " * 30)]
    check(spark, docs, [(i, text()) for i in range(5)] + [(None, None)], percent, order, buckets, 5, head)


def test_odd_tables(spark):
    docs = [(1, None), (1, None), (2, ""), (3, "x " * 50_000), (None, "x y z"), (4, "\x00!"), (5, "x y z"), (5, "x y z")]
    check(spark, docs, [(1, "x")], 50, 1, 100, 1, 10)
    check(spark, docs, [], 100, 2, 100, 3, 1)
    check(spark, docs, [(1, None)], 0, 1, 100, 1, 10)
    empty = spark.createDataFrame([], TEXT)
    assert R.resample(empty, empty).collect() == []


def test_head_is_bounded_and_holds_the_frequent(spark):
    docs = spark.createDataFrame([(i, " ".join(["often"] * 30 + ["some"] * 10 + [f"w{i}x{j}" for j in range(40)]), "") for i in range(50)], TEXT)
    states, pairs = R.frequent(docs, 2, 8)
    assert {"often", "some"} <= set(states) and len(states) <= 8 and len(pairs) <= 8
    assert states["often"] == zlib.crc32(b"often") and pairs[("often", "often")] == zlib.crc32(b"often often")
