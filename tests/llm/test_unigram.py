"""Counts against the best of all segmentations, the sharing of prefixes, and odd tables."""

from __future__ import annotations

import math
import random
from functools import cache

import pytest

from obsframe.llm import unigram
from tests.conftest import SMALL


def exhaustive(word, vocabulary):
    """(score, tokens) of the best segmentation by recursion over first pieces."""

    @cache
    def best(i):
        if i == len(word):
            return 0.0, 0
        size = len(word[i].encode())
        options = [(unigram.BYTE_SCORE * size + best(i + 1)[0], size + best(i + 1)[1])]
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in vocabulary:
                s, n = best(j)
                options.append((vocabulary[word[i:j]] + s, n + 1))
        return max(options, key=lambda o: (round(o[0], 9), -o[1]))

    return best(0)


@pytest.mark.parametrize("seed", range(20))
def test_trie(seed):
    rng = random.Random(seed)
    vocabulary = {"".join(rng.choices("abé", k=rng.randint(1, 4))): -rng.randint(1, 9) * 1.0 for _ in range(12)}
    words = sorted({"".join(rng.choices("abcé", k=rng.randint(0, 9))) for _ in range(60)})
    trie = unigram.TrieCounter(vocabulary)
    assert trie.counts(words) == [exhaustive(w, vocabulary)[1] for w in words]
    assert trie.nodes == len({w[:i] for w in words for i in range(1, len(w) + 1)})


def test_query(spark):
    vocabulary = unigram.read_vocabulary(unigram.default_vocabulary())
    assert abs(sum(map(math.exp, vocabulary.values())) - 1) < 1e-9
    got = {r.doc_id: r for r in unigram.op6_token_counts(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    known = {}
    for d in docs[:60]:
        words = (d.text or "").encode().split()
        for w in words:
            if w not in known:
                known[w] = exhaustive(unigram.SPACE + w.decode(), vocabulary)[1]
        assert (got[d.doc_id].n_words, got[d.doc_id].n_tokens) == (len(words), sum(known[w] for w in words))


def test_odd_tables(spark, monkeypatch):
    df = spark.createDataFrame(
        [(1, None, 0), (1, None, 0), (None, " \t", 0), (2, "a\n  b", 0), (3, "x" * 50_000, 0)], "doc_id long, text string, n_tokens int"
    )
    got = sorted((str(r.doc_id), r.n_words) for r in unigram.token_counts(df).collect())
    assert got == [("1", 0), ("1", 0), ("2", 2), ("3", 1), ("None", 0)]
    assert unigram.token_counts(df.limit(0)).collect() == []
