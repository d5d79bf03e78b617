"""Toxicity by a weighted finite-state pattern grammar, scored clause by clause.

A lexical transducer turns each word into a class with a weight: insult, threat, target, negation, reported
speech or other. Four letter transducers are composed behind it; each reads one symbol and writes one:

    negation    an insult or threat within three words after a negation becomes "negated"
    reported    one that follows a verb of saying in its clause becomes "quoted"
    target      an insult within three words after a person or demonstrative becomes "aimed"
    threat      a threat needs a target within three words after it and then counts as "menace"

A clause scores the sum of its words' weights, each times the factor of the symbol it ends up as. A document is
judged by its best clause, the sum, the share of clauses that match and the number of different matches, through
a logistic model.

Words are runs of letters, in learning and in scoring alike. The lexicon of insults is learned: words that labelled
toxic documents use more than chance allows, however many were tried, and word beginnings that two or more such words
share and that tell more than the strongest of them. A short general list stands in where the labels say too
little about a word. Threats, targets, negations and verbs of saying are English; other languages rest on the learned words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.common import fits, stored, table, text_of
from obsframe.llm.words import together

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, NEGATED, QUOTED, AIMED, MENACE = range(10)

# General English word classes.
THREATS = "kill hurt destroy beat burn shoot stab hunt punish crush".split()
WORDS = {
    THREAT: ["shot", "beaten", "burnt"],
    TARGET: "you your he she they them him her we us this that these those".split(),
    NEGATION: "not no never neither nor isn't aren't wasn't don't doesn't didn't".split(),
    REPORT: "said says say wrote writes claimed claims called calls quoted reported".split(),
}
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown fool dumb filth vermin".split()
UNSEEN_WEIGHT = 3.0
# How much of its weight a word keeps as each symbol.
FACTORS = {INSULT: 1.0, AIMED: 1.25, MENACE: 1.5, NEGATED: 0.25, QUOTED: 0.5}

#: Word beginnings of these lengths may be learned as stems.
STEMS = (4, 5, 6, 7)
#: Least log-odds and documents of an entry. Its log-likelihood ratio must reach EVIDENCE + 2 ln(entries tried).
EVIDENCE, ODDS, SUPPORT = 8.0, 2.0, 3
#: Least log-likelihood ratio of a word that counts towards a stem.
TELLING = 6.6
#: Most labelled rows that the logistic model is fitted on.
FIT_ROWS = 200_000
FEATURES = ("best", "total", "share", "distinct")
#: Bytes of text whose words are looked at together; a word's place takes some ten times its bytes.
TOGETHER = 2 << 20


@dataclass(frozen=True)
class Transducer:
    """Letter transducer: (state, symbol) to (state, symbol written); what is not listed passes unchanged to
    ``rest[state]``. State 0 begins a clause."""

    arcs: dict[tuple[int, int], tuple[int, int]]
    rest: tuple[int, ...]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        return self.arcs.get((state, symbol), (self.rest[state], symbol))


def compose(machines: list[Transducer], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Next states and written symbols of the machines run one behind the other, as tables."""
    numbers = {(0,) * len(machines): 0}
    todo, following, written = [(0,) * len(machines)], [], []
    for states in todo:
        nexts, outs = [], []
        for symbol in range(symbols):
            reached = []
            for machine, state in zip(machines, states):
                state, symbol = machine.step(state, symbol)
                reached.append(state)
            reached = tuple(reached)
            if reached not in numbers:
                numbers[reached] = len(numbers)
                todo.append(reached)
            nexts.append(numbers[reached])
            outs.append(symbol)
        following.append(nexts)
        written.append(outs)
    return np.array(following), np.array(written)


def _within_three(opener: int, changes: dict[int, int]) -> Transducer:
    """Rewrites symbols up to three words after an opener."""
    arcs = {(s, opener): (1, opener) for s in range(4)}
    for state in (1, 2, 3):
        arcs |= {(state, a): ((state + 1) % 4, b) for a, b in changes.items()}
    return Transducer(arcs, (0, 2, 3, 0))


def grammar() -> tuple[np.ndarray, np.ndarray]:
    negation = _within_three(NEGATION, {INSULT: NEGATED, THREAT: NEGATED})
    reported = Transducer(
        {(s, REPORT): (1, REPORT) for s in (0, 1)} | {(1, INSULT): (1, QUOTED), (1, THREAT): (1, QUOTED)}, (0, 1)
    )
    target = _within_three(TARGET, {INSULT: AIMED})
    # the threat itself is written as read; its menace is written at the target
    threat = Transducer(
        {(s, THREAT): (1, THREAT) for s in range(4)} | {(s, TARGET): (0, MENACE) for s in (1, 2, 3)}, (0, 2, 3, 0)
    )
    return compose([negation, reported, target, threat], REPORT + 1)


_NEXT, _WRITTEN = grammar()
_FACTOR = np.array([FACTORS.get(s, 0.0) for s in range(10)])


def clause_score(symbols: list[int], weights: list[float]) -> float:
    """Score of one clause; a menace takes the weight of its threat."""
    state, score, threat = 0, 0.0, 0.0
    for symbol, weight in zip(symbols, weights):
        written = _WRITTEN[state, symbol]
        state = _NEXT[state, symbol]
        if symbol == THREAT:
            threat = weight
        score += _FACTOR[written] * (threat if written == MENACE else weight)
    return score


def forms(verb: str) -> list[str]:
    """A regular verb with its endings, its last letter doubled or an e dropped where that may be."""
    stem = verb.removesuffix("e")
    return [verb, f"{verb}s", f"{verb}es", *[f"{x}{e}" for x in (stem, stem + stem[-1]) for e in ("ed", "ing", "er")]]


class Lexicon:
    """The lexical transducer: class and weight of a word, by the word or its heaviest known beginning."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.classes = {w: (c, 0.0) for c, listed in WORDS.items() for w in listed}
        self.classes |= {w: (THREAT, UNSEEN_WEIGHT) for w in [*WORDS[THREAT], *[f for v in THREATS for f in forms(v)]]}

    def read(self, word: str) -> tuple[int, float]:
        """``word`` is lower-case letters; what follows an apostrophe belongs to it in the closed classes only."""
        bare = word.partition("'")[0]
        weight = max(self.words.get(bare, 0.0), *(self.stems.get(bare[:n], 0.0) for n in STEMS))
        if weight > 0:
            return INSULT, weight
        return self.classes.get(word) or self.classes.get(bare, (OTHER, 0.0))


_WORD = regex.compile(r"\p{L}+(?:['\u2019]\p{L}+)*")
_CLOSE = frozenset(".,;:!?")


def words_in(token: str) -> list[tuple[str, bool]]:
    """The words of a stretch without white space, each with whether a clause ends behind it."""
    if token.isalpha() and token.isascii():
        return [(token.lower(), False)]
    out, at = [], 0
    for found in _WORD.finditer(token):
        if _CLOSE.intersection(token[at : found.start()]):
            out = [*out[:-1], (out[-1][0], True)] if out else [("", True)]
        out.append((found[0].lower().replace("\u2019", "'"), False))
        at = found.end()
    if _CLOSE.intersection(token[at:]):
        out = [*out[:-1], (out[-1][0], True)] if out else [("", True)]
    return out


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """A row of FEATURES for each text."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    out = np.zeros((len(texts), len(FEATURES)))
    parts = [words_in(t) for t in coded.dictionary.to_pylist()]
    flat = [w for p in parts for w in p]
    if not flat:
        return out
    numbers = {w: i for i, w in enumerate(dict.fromkeys(w for w, _ in flat))}
    read = [lexicon.read(w) for w in numbers]
    # every occurrence of a stretch becomes its words
    sizes = np.array([len(p) for p in parts])
    token = coded.indices.to_numpy()
    ends = np.concatenate(([0], np.cumsum(sizes[token])))
    begins = np.concatenate(([0], np.cumsum(sizes)))[token]
    spread = np.repeat(begins - ends[:-1], sizes[token]) + np.arange(ends[-1])
    offsets = ends[lists.offsets.to_numpy()]
    which = np.array([numbers[w] for w, _ in flat])[spread]
    closes = np.array([c for _, c in flat])[spread]
    symbols = np.array([c for c, _ in read], dtype=np.int8)
    weights = np.array([w for _, w in read], dtype=np.float64)
    heavy, blank = weights[which] > 0, numbers.get("", -1)
    clause = np.concatenate(([0], np.cumsum(closes)[:-1])) if len(closes) else closes
    for i in np.unique(np.searchsorted(offsets, np.flatnonzero(heavy), side="right") - 1):
        begin, end = offsets[i], offsets[i + 1]
        numbered, matched = clause[begin:end], heavy[begin:end]
        scores = []
        for c in np.unique(numbered[matched]):
            b, e = begin + np.searchsorted(numbered, c), begin + np.searchsorted(numbered, c, side="right")
            words = which[b:e]
            scores.append(clause_score(symbols[words].tolist(), weights[words].tolist()))
        different = len(np.unique(which[begin:end][matched]))
        share = sum(s > 0 for s in scores) / len(np.unique(numbered[which[begin:end] != blank]))
        out[i] = (max(scores), np.log1p(sum(scores)), share, np.log1p(different))
    return out


def features_in_parts(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """As :func:`features`, with about ``TOGETHER`` bytes of text in memory as words."""
    parts = together(pa.record_batch([texts], ["text"]), size=TOGETHER)
    return np.concatenate([np.zeros((0, len(FEATURES))), *[features(some.column("text"), lexicon) for some in parts]])


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of the rows that may be learned from: labelled, crc32(doc_id as text) mod 5 not 0."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = stored(marks.where(~held_out()), "labels")
    return docs.join(F.broadcast(marks) if fits(marks) else marks, "doc_id")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


_ENTRY = "word string, stem boolean, weight double"


def learn_lexicon(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """word, stem, weight: every entry that passes the tests, over the words of every labelled document outside
    the held-out fold, and the general list. Without labels of both kinds that list alone."""
    spark = docs.sparkSession
    rows = _labelled(docs.select("doc_id", "text"), labels).select(
        "toxic", F.array_distinct(F.split(F.lower(text_of()), r"[^\p{L}]+")).alias("words")
    )
    words = rows.select("toxic", F.explode("words").alias("word")).where("word <> ''")
    toxic = F.sum("toxic").cast("long").alias("toxic")
    counts = stored(words.groupBy("word").agg(toxic, F.count("*").alias("n")), "word-counts")
    size = _labelled(docs.select("doc_id"), labels).agg(toxic, F.count("*").alias("n")).first()
    n1, n0 = size["toxic"] or 0, size["n"] - (size["toxic"] or 0)
    if not n1 or not n0:
        return stored(spark.createDataFrame([(w, False, UNSEEN_WEIGHT) for w in INSULTS], _ENTRY), "lexicon")
    scored = _told(counts, n1, n0)
    telling = (F.col("odds") > 0) & (F.col("evidence") >= TELLING) & (F.col("toxic") >= 2)
    cut = F.transform(F.array(*map(F.lit, STEMS)), lambda k: F.substring("word", F.lit(1), k))
    long_enough = F.filter(cut, lambda p: (F.length(p) >= STEMS[0]) & (F.length(p) < F.length("word")))
    begun = scored.select(F.explode(F.array_distinct(long_enough)).alias("word"), "toxic", "n", telling.alias("tells"), "evidence")
    stems = begun.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("n").alias("n"), F.count_if("tells").alias("tells"), F.max("evidence").alias("strongest")
    )
    stems = stored(_told(stems, n1, n0).where("tells >= 2 and evidence > strongest"), "stems")
    # of beginnings with the same toxic uses the longest: a shorter one only adds other words
    longer = stems.select(F.expr("substring(word, 1, length(word) - 1)").alias("word"), F.col("toxic").alias("__toxic"))
    stems = stems.join(longer.groupBy("word").agg(F.max("__toxic").alias("__toxic")), "word", "left")
    stems = stems.where("__toxic is null or __toxic < toxic")
    tried = counts.count() + stems.count()
    passed = (F.col("odds") >= ODDS) & (F.col("evidence") >= EVIDENCE + 2 * math.log(max(tried, 1))) & (F.col("toxic") >= SUPPORT)
    entry = lambda df, stem: df.where(passed).select("word", F.lit(stem).alias("stem"), F.least("odds", F.lit(8.0)).alias("weight"))
    learned = stored(entry(scored, False).unionByName(entry(stems, True)), "lexicon")
    listed = F.col("word").isin(INSULTS) & ~F.col("stem")
    have = {r["word"] for r in learned.where(listed).collect()}
    known = {r["word"]: r["odds"] for r in scored.where(F.col("word").isin(INSULTS) & (F.col("n") >= 8)).collect()}
    general = [(w, False, float(max(0.0, known[w]) if w in known else UNSEEN_WEIGHT)) for w in INSULTS if w not in have]
    return stored(learned.unionByName(spark.createDataFrame(general, _ENTRY)), "lexicon") if general else learned


def _told(counts: DataFrame, n1: int, n0: int) -> DataFrame:
    """``counts`` (toxic, n) with log-odds and log-likelihood ratio of the toxic share against the base rate."""
    base, clean = n1 / (n1 + n0), F.col("n") - F.col("toxic")
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((clean + 0.5) / (n0 + 1))
    share = lambda part, p: F.when(part > 0, part * F.log(part / (F.col("n") * p))).otherwise(0.0)
    evidence = 2 * (share(F.col("toxic"), base) + share(clean, 1 - base))
    return counts.withColumns({"odds": odds, "evidence": evidence})


def _lexicon(entries) -> Lexicon:
    kinds = [{r["word"]: r["weight"] for r in entries if r["stem"] == stem} for stem in (False, True)]
    return Lexicon(*kinds)


def with_features(docs: DataFrame, entries: DataFrame, name: str) -> DataFrame:
    """``docs`` with an array of FEATURES of its text.

    A lexicon within the counted bound of a broadcast goes to every task. The entries of a larger one are joined
    to the words of each distinct text, and a text is read with its own entries.
    """
    text = F.make_valid_utf8(text_of())
    if fits(entries):
        shared = docs.sparkSession.sparkContext.broadcast(_lexicon(entries.collect()))

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def read(texts: pa.Array) -> pa.Array:
            x = features_in_parts(texts, shared.value)
            pa.default_memory_pool().release_unused()  # the worker lives on
            return pa.array(list(x), pa.list_(pa.float64()))

        return docs.withColumn(name, read(text))

    digest = F.sha2(text, 256)
    words = F.explode(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")))
    begun = F.array(F.struct(F.col("word"), F.lit(False).alias("stem")), *[F.struct(F.substring("word", 1, n).alias("word"), F.lit(True).alias("stem")) for n in STEMS])
    asked = docs.select(digest.alias("__text"), words.alias("word")).distinct()
    asked = asked.select("__text", F.explode(F.array_distinct(begun)).alias("e")).select("__text", "e.word", "e.stem").distinct()
    own = asked.join(entries, ["word", "stem"]).groupBy("__text").agg(F.collect_list(F.struct("word", "stem", "weight")).alias("__entries"))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def read_own(texts: pa.Array, lists: pa.Array) -> pa.Array:
        x = [features(texts.slice(i, 1), _lexicon(own or []))[0].tolist() for i, own in enumerate(lists.to_pylist())]
        return pa.array(x, pa.list_(pa.float64()))

    joined = docs.withColumn("__text", digest).join(own, "__text", "left")
    return joined.withColumn(name, read_own(text, F.col("__entries"))).select(*docs.columns, name)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept comes first."""
    x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    w = np.zeros(x.shape[1])
    hold = ridge * np.diag([1e-3, *[1.0] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    """The lexicon's entries and the weights of FEATURES, the intercept first."""

    entries: DataFrame
    weights: np.ndarray

    def scored(self, docs: DataFrame, name: str) -> DataFrame:
        """``docs`` with a score between 0 and 1."""
        found = with_features(docs, self.entries, "__features")
        total = F.lit(float(self.weights[0]))
        for i, w in enumerate(self.weights[1:].tolist()):
            total = total + F.col("__features")[i] * w
        return found.withColumn(name, 1 / (1 + F.exp(-F.least(F.greatest(total, F.lit(-500.0)), F.lit(500.0))))).drop("__features")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon from all labelled rows outside the held-out fold, weights from FIT_ROWS of them at most."""
    entries = learn_lexicon(docs, labels)
    rows = _labelled(docs.select("doc_id", "text"), labels)
    kept = with_features(rows.select(F.xxhash64("doc_id", text_of()).alias("row"), F.col("toxic").cast("int").alias("toxic"), "text"), entries, "x")
    sample = kept.select("row", "toxic", "x").orderBy("row", "toxic", "x").limit(FIT_ROWS).toPandas()
    if 0 < sample["toxic"].sum() < len(sample):
        return Model(entries, fit(np.stack(sample["x"].to_numpy()), sample["toxic"].to_numpy(dtype=float)))
    return Model(entries, np.array([-3.0, 0.5, 1.0, 1.0, 1.0]))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    ``labels`` has doc_id and toxic (0, 1 or null); of repeated labels the highest counts. Null and empty texts
    match nothing and get the score of documents without a match. A null doc_id has no label and is not held
    out. Without labels of both kinds a fixed model over the general list stands in. Repeated rows stay
    repeated; an empty table gives no rows. Other columns are ignored.
    """
    kept = docs.select("doc_id", "text", held_out().alias("held_out"))
    rows = learn(docs, labels).scored(kept, "score").drop("text")
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns.

    Null and empty texts, repeated rows, missing labels and empty tables are as in :func:`score_toxicity`; every row
    is judged by itself.
    """
    return learn(docs, labels).scored(docs, "__score").where(F.col("__score") < 0.5).drop("__score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
