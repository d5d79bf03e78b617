"""The pair index against the library on whole texts, and against a plain merge loop on odd rules."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from obsframe.llm import bpe
from tests.conftest import SMALL
from tests.llm.test_tokens import TEXTS

MORE = ["a  b   c\n\n d \t e", " lead", "trail  ", "aaaa" * 500, "x  y\xa0  z", "　　a", "\x1c\x1c!\x1c a", "<|endoftext|>  x<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def test_as_library(spark, library):
    docs = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + TEXTS + MORE
    mine = bpe.ByteBpe(bpe.default_tokenizer())
    got = mine.encode([None if t is None else t.encode() for t in docs])
    want = [library.encode(t or "", add_special_tokens=False).ids for t in docs]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert [mine.decode(g) for g in got] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_decode_of_cut_characters(library):
    ids = library.encode("é中😀").ids
    mine = bpe.ByteBpe(bpe.default_tokenizer())
    for i in range(len(ids)):
        part = ids[i : i + 2]
        assert mine.decode(np.array(part, "<u4").tobytes()) == library.decode(part, skip_special_tokens=False)


def plain(symbols, rules):
    """One merge at a time: smallest rank, leftmost."""
    ranks = {(a, b): (r, c) for r, (a, b, c) in reversed(list(enumerate(rules)))}
    s = list(symbols)
    while True:
        found = [(ranks[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in ranks]
        if not found:
            return s
        i = min(found)[1]
        s[i : i + 2] = [ranks[s[i], s[i + 1]][1]]


@pytest.mark.parametrize("seed", range(30))
def test_random_rules(seed):
    rng = np.random.default_rng(seed)
    pairs = {tuple(p) for p in rng.integers(0, 9, (25, 2)).tolist()}
    rules = [(a, b, int(rng.integers(3, 9))) for a, b in sorted(pairs, key=lambda _: rng.random())]
    r = np.array(rules)
    words = [rng.integers(0, 3, rng.integers(0, 12)).tolist() for _ in range(40)]
    index = bpe.PairIndex(r[:, 0], r[:, 1], r[:, 2], 9)
    got = index.segment(np.array(sum(words, []), dtype=np.int64), np.array([len(w) for w in words]))
    assert [g.tolist() for g in got] == [plain(w, rules) for w in words]


def test_query_and_odd_tables(spark, library):
    got = {r.doc_id: r for r in bpe.op8_bpe(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        want = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256) == (len(ids), want)
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    odd = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "x y", 6)], "doc_id long, text string, ids long")
    assert sorted((str(r.doc_id), len(r.ids), r.decoded) for r in bpe.encode_decode(odd).collect()) == [("1", 0, ""), ("1", 0, ""), ("None", 2, "x y")]
    assert bpe.round_trip(odd.limit(0)).collect() == []
