"""Decontamination against SQL on the tables and against a plain search on odd texts and random items."""

from __future__ import annotations

import random
import re

import pytest

from obsframe.llm import decontaminate as dec
from obsframe.llm import words as W
from tests.compare import compare
from tests.conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    """n_words, longest, hit words, item ids of each text, by looking at every place."""
    listed = [(("" if i is None else str(i)), words_of(t)) for i, t in items]
    windows = {}
    for i, w in listed:
        m = min(window, len(w))
        for p in range(len(w) - m + 1) if w else ():
            windows.setdefault(tuple(w[p : p + m]), set()).add(i)
    runs = {tuple(w[a:b]) for _, w in listed for a in range(len(w)) for b in range(a + 1, len(w) + 1)}
    least = min(map(len, windows), default=window)
    out = []
    for doc_id, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for p in range(len(w)):
            for m in {len(g) for g in windows}:
                g = tuple(w[p : p + m])
                if len(g) == m and g in windows:
                    hit.update(range(p, p + m))
                    found |= windows[g]
        longest = max((b - a for a in range(len(w)) for b in range(a + 1, len(w) + 1) if tuple(w[a:b]) in runs), default=0)
        out.append((str(doc_id), len(w), longest if longest >= least else 0, sorted(hit), sorted(found)))
    return sorted(out, key=str)


def got(rows):
    out = []
    for r in rows:
        hit = [p for s in r["spans"] for p in range(s["begin"], s["end"])]
        assert all(a["end"] < b["begin"] for a, b in zip(r["spans"], r["spans"][1:]))
        out.append((str(r["doc_id"]), r["n_words"], r["longest"], hit, list(r["items"])))
    return sorted(out, key=str)


def test_query(spark, con):
    result = dec.op12_decontaminate(spark, SMALL)
    assert compare(result, con, dec.OP12_SQL) is None
    assert result.where("contaminated").count() > 0


@pytest.mark.parametrize("seed,window,block", [(1, 3, 10**6), (2, 4, 10**6), (3, 3, 25), (4, 1, 10**6), (5, 5, 40)])
def test_random(spark, monkeypatch, seed, window, block):
    rng = random.Random(seed)
    monkeypatch.setattr(dec, "BLOCK_WORDS", block)
    monkeypatch.setattr(dec, "PIECE_WORDS", 2 * window if block < 10**6 else 10**5)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.randint(0, 12))) for i in range(12)] + [(3, text(9)), (None, text(7))]
    docs = [(i, text(rng.randint(0, 60))) for i in range(25)]
    shape = "item_id long, text string"
    found = dec.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, shape), window)
    mine, want = got(found.collect()), brute(docs, items, window)
    if block < 10**6:  # a longest run may lie across pieces; windows may not
        mine, want = ([(a, b, d, e) for a, b, _, d, e in x] for x in (mine, want))
    assert mine == want


ITEM = "One two three four five six seven eight nine ten eleven"


def test_odd_texts(spark):
    docs = [
        (1, None, 5), (1, None, 5), (2, "", 5), (None, ITEM.upper(), 5), (3, "x, " + ITEM.replace(" ", "—\t--\n") + "!", 5),
        (4, "é" * 50_000 + " " + ITEM * 2, 5), (5, " ".join(["ten eleven"] * 20_000), 5), (6, "\x00tiny\x00 thing.", 5), (6, "ten one", 5),
    ]
    items = [("q", ITEM), ("r", "TINY thing"), ("s", None), ("t", "..."), (None, "three four five six seven eight nine ten eleven twelve")]
    df = spark.createDataFrame([(i, t, n) for i, t, n in docs], "doc_id long, text string, items int")
    test = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, n_words int")
    small = [d[:2] for d in docs if len(d[1] or "") < 1000]
    rows = dec.matches(df, test).collect()
    keep = [r for r in rows if r["doc_id"] not in (4, 5)]
    assert got(keep) == brute(small, items, 10)
    four = next(r for r in rows if r["doc_id"] == 4)
    assert (four["n_words"], [tuple(s) for s in four["spans"]], list(four["items"])) == (22, [(1, 11), (12, 22)], ["q"])
    assert next(r for r in rows if r["doc_id"] == 5)["spans"] == []
    assert dec.matches(df.limit(0), test).collect() == []
    assert all(r["spans"] == [] and r["longest"] == 0 for r in dec.matches(df, test.limit(0)).collect())


def test_spans_go(spark):
    pad = " ".join(f"w{i}" for i in range(30))
    docs = [(1, f"Start. {ITEM}! {pad}", "a"), (1, f"Start. {ITEM}! {pad}", "b"), (2, ITEM, "c"), (3, None, "d"), (None, pad, "e"), (4, "", "f")]
    df = spark.createDataFrame(docs, "doc_id long, text string, spans string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = sorted((r["spans"], r["doc_id"], r["text"]) for r in dec.decontaminate(df, items).collect())
    assert rows == [("a", 1, f"Start. ! {pad}"), ("b", 1, f"Start. ! {pad}"), ("d", 3, None), ("e", None, pad), ("f", 4, "")]
    assert dec.decontaminate(df, items, longest_span=11).count() == 6
    assert dec.decontaminate(df, items, most_covered=1.0).where("doc_id = 2").first()["text"] == ""
    assert sorted(map(tuple, dec.decontaminate(df, items.limit(0)).collect()), key=str) == sorted(docs, key=str)


def test_words_by_spark_and_by_arrow(spark):
    texts = ["A b-C", " É É  x ", "", None, "1a\x7fb\x00c", "ÀZ[z`", "日本 x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    by_spark = [list(r[0]) for r in df.select(W.word_array()).collect()]
    assert by_spark == [words_of(t) for t in texts]
    import pyarrow as pa

    arr = pa.array([t or "" for t in texts])
    coded, offsets = W.word_lists(arr.slice(1))
    flat = coded.to_pylist()
    assert [flat[a:b] for a, b in zip(offsets, offsets[1:])] == [words_of(t) for t in texts[1:]]
