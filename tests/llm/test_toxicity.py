"""The grammar on clauses, the model on held-out labels, odd tables."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex

from obsframe.llm import toxicity as t
from tests.conftest import SMALL

LEXICON = t.Lexicon({"idiot": 4.0}, {"mor": 0.0, "moro": 2.0})


def clause(text):
    read = [LEXICON.read(w) for w in text.split()]
    return t.clause_score([c for c, _ in read], [w for _, w in read])


@pytest.mark.parametrize(
    "text,score",
    [
        ("a plain idiot here", 4.0),
        ("you are an idiot", 5.0),
        ("you are a very long way idiot", 4.0),
        ("not an idiot", 1.0),
        ("he is not an idiot", 1.0),
        ("they said idiot again", 2.0),
        ("moronic idiot", 6.0),
        ("mor", 0.0),
        ("i will kill you", 4.5),
        ("kill the lights", 0.0),
        ("never kill you", 0.75),
        ("nothing here", 0.0),
        ("", 0.0),
    ],
)
def test_clauses(text, score):
    assert clause(text) == pytest.approx(score)


def plain_scores(text):
    """Clause scores of a text by a loop over its letters and marks."""
    scores, words, run = [], [], ""
    for c in (text or "") + " ":
        inner = c in "'\u2019" and run
        if c.isalpha() or inner:
            run += "'" if inner else c.lower()
            continue
        if run:
            words.append(LEXICON.read(run.strip("'")))
            run = ""
        if c in ".,;:!?":
            scores.append(words)
            words = []
    return [t.clause_score([c for c, _ in w], [x for _, x in w]) for w in [*scores, words] if w]


def test_features_as_by_loop():
    texts = ["", "Idiot! you idiot, not idiot", "calm words. more", "said IDIOT*** moron; kill you", "a " * 5000 + "idiot", "\u201cidiot\u201d \u2014idiot/moron\xa0you idiot", "isn\u2019t idiot. 42, x.idiot,you"]
    got = t.features(pa.array(texts), LEXICON)
    for row, text in zip(got, texts):
        scores = plain_scores(text)
        assert row[0] == pytest.approx(max(scores, default=0.0))
        assert row[1] == pytest.approx(np.log1p(sum(scores)))
        assert row[2] == pytest.approx(sum(s > 0 for s in scores) / max(1, len(scores)))
    assert t.features(pa.array([], pa.string()), LEXICON).shape == (0, 4)


def test_held_out_labels(spark):
    sf = SMALL.replace("0.001", "0.1")
    found = t.op10_toxicity(spark, sf)
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert found.count() == 10_000 and found.where("score is null or score < 0 or score > 1").isEmpty()
    toxic = rows.toxic == 1
    assert (rows.predicted[toxic] == 1).mean() > 0.85 and (rows.predicted[~toxic] == 1).mean() < 0.01


def test_fold_is_not_learned_from(spark):
    words = ["quxy ", "plain "]
    docs = [(i, words[i % 2] * 3 + f"w{i}") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(400)], "doc_id long, toxic int")
    crossed = labels.withColumn("toxic", t.F.when(t.held_out(), 1 - t.F.col("toxic")).otherwise(t.F.col("toxic")))
    a = {r.doc_id: r.score for r in t.score_toxicity(df, labels).collect()}
    assert a == {r.doc_id: r.score for r in t.score_toxicity(df, crossed).collect()}
    assert all((a[i] >= 0.5) == (i % 2 == 0) for i in a)


def test_every_telling_word_is_kept(spark):
    words = ["".join("abcdefghij"[int(d)] for d in f"{i * 7919 % 10**6:06d}") + "q" for i in range(5000)]
    docs = [(i, " ".join(words) if i % 2 else "calm words") for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    entries = t.learn_lexicon(df, labels)
    assert len(set(words)) == 5000 and set(words) <= {r.word for r in entries.where("not stem").collect()}


def plain_entries(rows):
    """Entries by counting words of labelled texts in plain loops."""
    n1, n0 = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    words = {}
    for text, y in rows:
        for w in set(regex.findall(r"\p{L}+", text.lower())):
            words.setdefault(w, [0, 0])[0 if y else 1] += 1

    def told(a, c):
        base, n = n1 / (n1 + n0), a + c
        part = lambda k, p: k * math.log(k / (n * p)) if k else 0.0
        return math.log((a + 0.5) / (n1 + 1)) - math.log((c + 0.5) / (n0 + 1)), 2 * (part(a, base) + part(c, 1 - base))

    stems = {}
    for w, (a, c) in words.items():
        odds, evidence = told(a, c)
        for k in {w[:k] for k in t.STEMS if k < len(w)}:
            s = stems.setdefault(k, [0, 0, 0, 0.0])
            s[0], s[1], s[3] = s[0] + a, s[1] + c, max(s[3], evidence)
            s[2] += odds > 0 and evidence >= t.TELLING and a >= 2
    stems = {k: s for k, s in stems.items() if s[2] >= 2 and told(*s[:2])[1] > s[3]}
    stems = {k: s for k, s in stems.items() if not any(x[:-1] == k and y[0] == s[0] for x, y in stems.items())}
    least = t.EVIDENCE + 2 * math.log(len(words) + len(stems))
    kept = lambda a, c: told(a, c)[0] >= t.ODDS and told(a, c)[1] >= least and a >= t.SUPPORT
    out = {(w, False): told(a, c)[0] for w, (a, c) in words.items() if kept(a, c)}
    return out | {(k, True): told(a, c)[0] for k, (a, c, _, _) in stems.items() if kept(a, c)}


def stem_corpus():
    bad = ["grumfest", "grumfestic", "grumfests", "snark"]
    rows = [(f"{bad[i % 4]} in the {bad[(i + 1) % 4]} house", 1) for i in range(80)]
    return rows + [(f"the path {i} is worth a house snarling grumbling", 0) for i in range(200)]


def test_lexicon_as_counted(spark):
    rows = stem_corpus()
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5][: len(rows)]
    df = spark.createDataFrame([(i, x) for i, (x, _) in zip(ids, rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, rows)], "doc_id long, toxic int")
    entries = t.learn_lexicon(df, labels)
    got = {(r.word, r.stem): r.weight for r in entries.collect() if r.word not in t.INSULTS}
    want = plain_entries(rows)
    assert got.keys() == want.keys() and ("grumfes", True) in got and not {("grum", True), ("snar", True)} & got.keys()
    assert all(got[k] == pytest.approx(min(want[k], 8.0)) for k in got)
    # entries beyond the bound of a broadcast are joined to the words of the texts
    texts = spark.createDataFrame([(1, "Grumfesting. snark!", "a"), (2, None, "b"), (3, "calm", "c"), (3, "calm", "c")], "doc_id long, text string, stem string")
    held = sorted((r.stem, [round(v, 9) for v in r.x]) for r in t.with_features(texts, entries, "x").collect())
    spark.conf.set("spark.obsframe.maxBroadcastCells", "3")
    try:
        assert sorted((r.stem, [round(v, 9) for v in r.x]) for r in t.with_features(texts, entries, "x").collect()) == held
    finally:
        spark.conf.unset("spark.obsframe.maxBroadcastCells")


def test_ordinary_words_are_clean_and_marks_do_not_hide(spark):
    sf = SMALL.replace("0.001", "0.1")
    model = t.learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    texts = ["the path is clear", "it is worth it", "\u201cidiot\u201d", "you\u2014idiot", "idiot/moron", "they killed time", "i will be killing you"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    score = {r.doc_id: r.s for r in model.scored(df, "s").collect()}
    assert [score[i] >= 0.5 for i in range(7)] == [False, False, True, True, True, False, True]


def test_odd_tables(spark):
    df = spark.createDataFrame(
        [(1, None, 9), (1, None, 9), (None, "you idiot", 9), (3, "", 9)], "doc_id long, text string, score int"
    )
    labels = spark.createDataFrame([(1, None), (7, 1)], "doc_id long, toxic int")
    got = t.score_toxicity(df, labels).collect()
    assert len(got) == 4 and {r.predicted for r in got if r.doc_id is None} == {1}
    assert {r.predicted for r in got if r.doc_id is not None} == {0}
    assert t.score_toxicity(df.limit(0), labels.limit(0)).collect() == []


def test_words_of_few_texts_at_a_time(monkeypatch):
    texts = pa.array([f"you {'idiot' if i % 7 == 0 else 'friend'}. " + "plain words here. " * 100 for i in range(3000)] + [""])
    whole, plain, sizes = t.features(texts, LEXICON), t.features, []

    def seen(some, lexicon):
        sizes.append(sum(len(x) for x in some.to_pylist()))
        return plain(some, lexicon)

    monkeypatch.setattr(t, "features", seen)
    assert (t.features_in_parts(texts, LEXICON) == whole).all() and whole.any()
    assert max(sizes) <= t.TOGETHER and sum(sizes) > 2 * t.TOGETHER
    assert t.features_in_parts(pa.array([], pa.string()), LEXICON).shape == (0, len(t.FEATURES))
