"""Wavelet matrix files against plain arrays; encoded documents against the library on whole texts."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from obsframe.llm import tokens, wavelet
from tests.conftest import SMALL

TEXTS = [
    None, "", "   ", "Word. word, WORD!! don't it's 3.14 x2 ½", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
    "école ÉCOLE İstanbul ΣΣ Å café au lait\x1cx\x85y", "a" * 30_000, "\U0001f600\U0001f600 ok 中文字",
    "tab\tnew\nline\r\x0b\x0cend", "'s 't a's b'll ''' ...--- a_b_c", "العربية हिन्दी",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def expected(library, texts):
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def listed(words, texts):
    ids, sizes = words.encode(pa.array([t or "" for t in texts], pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes))[:-1]]


def test_words_encode_as_whole_texts(spark, library):
    docs = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + TEXTS
    assert listed(tokens.WordEncoder(tokens.default_tokenizer()), docs) == expected(library, docs)


def test_bound_on_remembered_words(monkeypatch, library):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    words = tokens.WordEncoder(tokens.default_tokenizer())
    for _ in range(2):
        some = ["one two three four five", "two six."]
        assert listed(words, some) == expected(library, some)
    assert listed(words, []) == [] and listed(words, [""]) == [[]]


@pytest.mark.parametrize("n,s", [(0, 1), (1, 1), (50, 1), (50, 2), (3000, 37), (3000, 60_000)])
def test_matrix_answers(monkeypatch, n, s):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 512)
    monkeypatch.setattr(wavelet, "BLOCK_BYTES", 64)
    ids = np.random.default_rng(n + s).integers(0, s, n).astype("<u2")
    m = wavelet.WaveletMatrix(wavelet.build(ids, [None, 7], np.array([0, n]), part=3) + b"after")
    assert (m.tokens() == ids).all() and m.doc_ids == [None, 7] and m.header["part"] == 3
    for p in range(0, n, 41):
        assert m.access(p) == ids[p]
        assert m.rank(int(ids[p]), p) == int((ids[:p] == ids[p]).sum())
        assert m.occurrences(int(ids[p]))[:50] == np.flatnonzero(ids == ids[p])[:50].tolist()
    assert m.count(65_000) == 0
    with pytest.raises(IndexError):
        m.select(65_000, 0)


def rows(df):
    return sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in df.collect())


def brute(library, pairs):
    out, start = [], 0
    for doc_id, ids in pairs:
        ids = [*ids, tokens.END_ID]
        out.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), doc_id))
        start += len(ids)
    return out


def test_query(spark, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want = brute(library, zip([d for d, _ in docs], expected(library, [t for _, t in docs])))
    assert rows(tokens.op1_wavelet_tokens(spark, SMALL)) == want


def test_small_shards_ties_and_nulls(spark, library, tmp_path):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, "no id")]
    df = spark.createDataFrame([(t, d, "x") for d, t in data], "text string, doc_id long, start string")
    tokens.write_tokens(df, f"{tmp_path}/t", parts=3, shard_tokens=5)
    got = tokens.read_tokens(spark, f"{tmp_path}/t").collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.n_tokens) for r in got) == sorted(
        (d is not None, d, len(ids) + 1) for (d, _), ids in zip(data, expected(library, [t for _, t in data]))
    )
    by_start = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert [s for s, _, _ in by_start] == np.cumsum([0, *[n for _, n, _ in by_start[:-1]]]).tolist()
    assert [d for _, _, d in by_start][0] is None and [d for _, _, d in by_start][1:] == sorted(d for d, _ in data if d is not None)


def test_empty_table(spark, tmp_path):
    tokens.write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/t")
    assert tokens.read_tokens(spark, f"{tmp_path}/t").collect() == []
