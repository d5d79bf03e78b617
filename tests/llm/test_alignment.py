"""Alignment against a plain computation with both libraries on whole texts."""

from __future__ import annotations

import hashlib
import json
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from obsframe.llm import alignment as al
from obsframe.llm.bpe import byte_letters
from tests.conftest import SMALL
from tests.llm.test_bpe import MORE
from tests.llm.test_tokens import TEXTS

ODD = [
    "a", " ", "  ", "a ", "a  ", "  a", "\n", "a\nb \n c", "a \t b", "x y  z", "a  b", "▁", "a ▁b", "<0x0A> <s></s>", "<|endoftext|> a",
    "\x00 \x1f x", "naïve café ﬁne 日本語 😀👍🏽", "don't we'll I'M", "1234567 89", "https://a.b/c?d=e&f", "    indented", "a\r\nb", "); \r", "\x1c a \x1f b", "ÀÉ́",
]


def plain(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path_a, path_b = al.default_tokenizers()
    a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    letters = byte_letters()
    entries = {i: bytes(letters[c] for c in t) for t, i in json.load(open(path_a, encoding="utf-8"))["model"]["vocab"].items() if set(t) <= set(letters)}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    docs = []
    for doc_id, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts_a, parts_b = [entries[i] for i in ids_a], [bytes_b(i) for i in ids_b]
        want = (" " + text).encode() if text else b""
        if not text or b"".join(parts_a) != want or b"".join(parts_b) != want:
            docs.append((doc_id, [], [], [], Counter(), ""))
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]).tolist(), np.cumsum([len(p) for p in parts_b]).tolist()
        groups, links, i, j = [], Counter(), 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            ni, nj = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, ids_a[i:ni])) + "|" + ",".join(map(str, ids_b[j:nj])))
            for x in range(i, ni):
                for y in range(j, nj):
                    if max(ends_a[x] - len(parts_a[x]), ends_b[y] - len(parts_b[y])) < min(ends_a[x], ends_b[y]):
                        links[ids_a[x], ids_b[y]] += 1
            i, j = ni, nj
        docs.append((doc_id, ids_a, ids_b, groups, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    held = Counter(p for d in docs for p in d[4])
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, ids_a, ids_b, groups, links, digest in docs:
        best = sum(n for p, n in links.items() if held[p] == top[p[0]])
        total = sum(n * held[p] for p, n in links.items())
        out.append((str(doc_id), len(ids_a), len(ids_b), len(groups), sum(links.values()), best, total, digest))
    links = Counter()
    for d in docs:
        links.update(d[4])
    return sorted(out), {p: (held[p], links[p]) for p in held}


def got(frame):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r.doc_id), *[r[c] for c in names]) for r in frame.collect())


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(al.op11_alignment(spark, SMALL)) == plain(rows)[0]


def test_odd_texts_and_tables(spark):
    texts = [*ODD, *TEXTS, *MORE, None, None, "", "a", "a", " ".join(ODD), "long " * 30_000, "x" * 20_000, "x\xa0y " * 3_000]
    rows = [(i % 40 if i % 7 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, block int, docs string")
    want, pairs = plain(rows)
    assert got(al.align(frame)) == want
    counts = {(r.a, r.b): (r.n_docs, r.n_links) for r in al.pair_counts(al.index(frame)).collect()}
    assert counts == pairs
    assert al.align(frame.limit(0)).collect() == []
    nothing = spark.createDataFrame([("q", None), ("q", "")], "doc_id string, text string")
    assert got(al.align(nothing)) == [("q", 0, 0, 0, 0, 0, 0, "")] * 2


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_LINKS", 60)
    monkeypatch.setattr(al, "BLOCK_DOCS", 8)
    monkeypatch.setattr(al, "REMEMBERED", 5)
    rows = [(i, t) for i, t in enumerate([*ODD, *ODD, "the the the cat", "the cat sat on the mat " * 9])]
    assert got(al.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == plain(rows)[0]


@pytest.mark.parametrize("size", [1, 7, 64, 300, 32_768])
def test_bitmaps(size):
    rng = np.random.default_rng(size)
    sets = [np.flatnonzero(rng.random(size) < p) for p in (0.0, 0.01, 0.2, 0.9, 1.0)]
    sets = [s for s in sets if len(s)]
    counts = np.array([len(s) for s in sets])
    maps = al._packed(np.concatenate(sets), counts, size)
    assert max(pa.compute.binary_length(maps).to_pylist()) <= -(-size // 8) + 1
    for begin in (0, 1):
        values, owner = al._unpacked(maps.slice(begin), counts[begin:], size)
        for i, s in enumerate(sets[begin:]):
            assert sorted(values[owner == i].tolist()) == s.tolist()


def test_bitmaps_a_part_at_a_time(monkeypatch):
    """The links of a block come back whole from parts cut between pairs, in little memory besides."""
    rng = np.random.default_rng(3)
    a, b, text = rng.integers(0, 300, 400_000), rng.zipf(1.3, 400_000) % 1_000, np.sort(rng.integers(0, 2_000, 400_000))
    want = Counter(zip((a << 32 | b).tolist(), text.tolist()))

    def made():
        block = al.Block(0, 1_000)
        block.add((a << 32 | b)[:150_000], text[:150_000], 0)
        block.add((a << 32 | b)[150_000:], text[150_000:], 2_000)
        return block

    monkeypatch.setattr(al, "LINKS_TOGETHER", 20_000)
    have, pairs = Counter(), []
    for maps in made().bitmaps():
        pair, plane, n = (maps[c].to_numpy() for c in ("pair", "plane", "n_docs"))
        places, owner = al._unpacked(maps["docs"], n, 2_000)
        for p, t, k in zip(pair[owner].tolist(), places.tolist(), plane[owner].tolist()):
            have[p, t] += 1 << max(k - 1, 0)
        pairs.append(set(pair.tolist()))
    assert have == want and len(pairs) > 10
    assert sum(map(len, pairs)) == len(set.union(*pairs))
    block = made()
    tracemalloc.start()
    try:
        for _ in block.bitmaps():
            pass
        assert tracemalloc.get_traced_memory()[1] < 16 * len(text)  # the links sorted, and a part
    finally:
        tracemalloc.stop()

