r"""Benchmark passages in training documents, found with a generalised suffix automaton.

The words of all test items go into one suffix automaton (blocks of them, if the items are many). Documents are
streamed through it: the state and the length of the longest match that ends at each word tell which windows of
which items end there. A match cannot reach across two neighbouring words that are neighbours in no item, so
only stretches without such a break are walked; the length at their first word is known to be at most one.
"""

from __future__ import annotations

import io
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.common import blocks, fits, mark_of, stored, table, text_of
from obsframe.llm.words import FOLD, folded, together, word_array, word_lists

#: Words of items in one automaton. More items make more automata, each streamed over all documents.
BLOCK_WORDS = 300_000
#: Words of one piece of an item; longer items are cut into pieces that overlap by a window less a word.
PIECE_WORDS = 100_000

_SPAN = re.compile(rb"[^ ]+")


class SuffixAutomaton:
    """Suffix automaton of several word sequences; state 0 is the start."""

    def __init__(self):
        self.length, self.link = [0], [-1]
        self.step: list[dict[int, int]] = [{}]

    def _copy(self, state: int, length: int) -> int:
        self.length.append(length)
        self.link.append(self.link[state])
        self.step.append(dict(self.step[state]))
        return len(self.length) - 1

    def _redirect(self, state: int, word: int, old: int, new: int) -> None:
        while state >= 0 and self.step[state].get(word) == old:
            self.step[state][word] = new
            state = self.link[state]

    def _after(self, state: int, word: int) -> int:
        """The state of the longest string of ``state`` followed by ``word``, which is known already."""
        known = self.step[state][word]
        if self.length[known] == self.length[state] + 1:
            return known
        split = self._copy(known, self.length[state] + 1)
        self.link[known] = split
        self._redirect(state, word, known, split)
        return split

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._after(last, word)
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        self.step.append({})
        state = len(self.length) - 1
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._after(last, word)
        return state

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)


def _pack(values: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    stops = np.cumsum([len(v) for v in values])
    return np.concatenate(([0], stops)).astype(np.int64), np.array([x for v in values for x in v], dtype=np.int64)


def build(items: list[list[str]], window: int) -> bytes:
    """The automaton of ``items`` as arrays, with the numbers of the items that hold each window."""
    vocabulary = sorted({w for words in items for w in words})
    number = {w: i for i, w in enumerate(vocabulary)}
    coded = [[number[w] for w in words] for words in items]
    automaton = SuffixAutomaton()
    for words in coded:
        automaton.add(words)
    length, link, step = automaton.length, automaton.link, automaton.step
    whole: list[set[int]] = [set() for _ in length]  # items that end a window in this state
    for item, words in enumerate(coded):
        state, size = 0, 0
        for word in words:
            state, size = step[state][word], size + 1
            while length[link[state]] >= window:
                state = link[state]
            if size >= window:
                whole[state].add(item)
        if 0 < size < window:
            whole[state].add(item)
    starts, holders = _pack([sorted(s) for s in whole])
    joined = "\n".join(vocabulary).encode()
    edges = sorted((s * len(vocabulary) + w, t) for s, d in enumerate(step) for w, t in d.items())
    pairs = {a * len(vocabulary) + b for words in coded for a, b in zip(words, words[1:])}
    out = io.BytesIO()
    np.savez_compressed(
        out, vocabulary=np.frombuffer(joined, np.uint8), length=np.array(length), link=np.array(link),
        edges=np.array([e for e, _ in edges], dtype=np.int64), targets=np.array([t for _, t in edges], dtype=np.int64),
        pairs=np.array(sorted(pairs), dtype=np.int64), starts=starts, holders=holders,
    )
    return out.getvalue()


class Matcher:
    """Streams words through an automaton made by :func:`build`."""

    def __init__(self, blob: bytes, window: int):
        with np.load(io.BytesIO(blob)) as arrays:
            self.window = window
            joined = arrays["vocabulary"].tobytes().decode()
            self.vocabulary = pa.array(joined.split("\n") if joined else [], pa.string())
            self.length, self.link = arrays["length"].tolist(), arrays["link"].tolist()
            self.pairs = arrays["pairs"]
            starts, holders = arrays["starts"], arrays["holders"].tolist()
            self.holders = {s: holders[starts[s] : starts[s + 1]] for s in np.flatnonzero(np.diff(starts)).tolist()}
            self.edges = dict(zip(arrays["edges"].tolist(), arrays["targets"].tolist()))
        # nearest state on the way of suffix links, itself included, that ends some window
        self.near = [-1] * len(self.length)
        for state in np.argsort(self.length, kind="stable").tolist():
            if state in self.holders:
                self.near[state] = state
            elif state:
                self.near[state] = self.near[self.link[state]]
        self.least = min((min(self.length[s], window) for s in self.holders), default=window)

    def walk(self, words: list[int]) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Longest match, spans (first word, word after the last) and items of a stretch of known words."""
        length, link, edges, near, window = self.length, self.link, self.edges, self.near, self.window
        size = len(self.vocabulary)
        state, matched, longest = 0, 0, 0
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for at, word in enumerate(words):
            target = edges.get(state * size + word)
            while target is None:
                state = link[state]
                matched = length[state]
                target = edges.get(state * size + word)
            state, matched = target, matched + 1
            longest = max(longest, matched)
            ends = near[state]
            while ends >= 0:
                span = min(length[ends], window)
                if span <= matched:
                    found.update(self.holders[ends])
                    begin = at + 1 - span
                    while spans and spans[-1][0] >= begin:
                        spans.pop()
                    if spans and spans[-1][1] >= begin:
                        begin = spans.pop()[0]
                    spans.append((begin, at + 1))
                ends = near[link[ends]] if ends else -1
        return longest, spans, found

    def matches(self, coded: pa.DictionaryArray, offsets: np.ndarray):
        """For each text: longest match (of those as long as the shortest window), spans and items."""
        n = len(offsets) - 1
        longest, spans, found = [0] * n, [[] for _ in range(n)], [set() for _ in range(n)]
        if not len(self.vocabulary) or not len(coded):
            return longest, spans, found
        known = pc.index_in(coded.dictionary, value_set=self.vocabulary).fill_null(-1).to_numpy()
        ids = known[coded.indices.to_numpy()].astype(np.int64)
        keys = ids[:-1] * len(self.vocabulary) + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, keys), max(len(self.pairs) - 1, 0))
        joined = (ids[:-1] >= 0) & (ids[1:] >= 0)
        joined &= (self.pairs[at] == keys) if len(self.pairs) else False
        ends = offsets[1:-1]
        joined[ends[(ends > 0) & (ends < len(ids))] - 1] = False  # a text's last word and the next one's first
        first = np.concatenate(([True], ~joined)) & (ids >= 0)
        last = np.concatenate((~joined, [True])) & (ids >= 0)
        begins, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        walked = stops - begins >= self.least
        begins, stops = begins[walked], stops[walked]
        texts = np.searchsorted(offsets, begins, side="right") - 1
        for text, begin, stop in zip(texts.tolist(), begins.tolist(), stops.tolist()):
            most, some, items = self.walk(ids[begin:stop].tolist())
            longest[text] = max(longest[text], most)
            shift = begin - int(offsets[text])
            spans[text] += [(a + shift, b + shift) for a, b in some]
            found[text] |= items
        return longest, spans, found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def automata(items: DataFrame, window: int) -> DataFrame:
    """blob, ids: the automata of ``items`` (item_id, text), one for each block, and the items' ids in them."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), word_array().alias("words"))
    # long items in pieces that share a window less a word, so that no window is lost
    reach = max(PIECE_WORDS - window + 1, 1)
    begins = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)), F.lit(reach))
    pieces = words.where(F.size("words") > 0).select("item_id", F.explode(begins).alias("begin"), "words")
    pieces = pieces.select("item_id", F.slice("words", F.col("begin"), reach + window - 1).alias("words")).distinct()
    pieces = stored(pieces, "test-items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0]
    block = F.pmod(F.xxhash64("words"), F.lit(blocks(total, BLOCK_WORDS)))

    def grow(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("item_id", kind="stable")
        blob = build([list(w) for w in some["words"]], window)
        return pd.DataFrame({"blob": [blob], "ids": [some["item_id"].tolist()]})

    grown = pieces.withColumn("block", block).groupBy("block").applyInPandas(grow, "blob binary, ids array<string>")
    return stored(grown, "automata")


_SPANS = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("begin", "end")]))
_ARROW_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("longest", T.LongType()),
    T.StructField("spans", _SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _scan(docs: DataFrame, shared, window: int) -> DataFrame:
    """All columns of ``docs`` but text (made by :func:`folded`), with what one automaton finds."""
    others = [c for c in docs.columns if c != "text"]
    kinds = T.StructType([docs.schema[c] for c in others] + _FOUND)

    def run(batches):
        blob, ids = shared.value
        matcher = Matcher(blob, window) if blob else None
        for batch in batches:
            for some in together(batch):
                coded, offsets = word_lists(some.column("text"))
                n = some.num_rows
                longest, spans, found = matcher.matches(coded, offsets) if matcher else ([0] * n, [[]] * n, [()] * n)
                arrays = [some.column(c) for c in others] + [
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(longest, pa.int64()),
                    pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], _ARROW_SPANS),
                    pa.array([sorted({ids[i] for i in f}) for f in found], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, [*others, "n_words", "longest", "spans", "items"])

    return docs.mapInArrow(run, kinds)


@F.pandas_udf(_SPANS)
def _joined(lists: pd.Series) -> pd.Series:
    out = (_merged([(s["begin"], s["end"]) for s in spans]) for spans in lists)
    return pd.Series([[{"begin": b, "end": e} for b, e in spans] for spans in out])


def matches(docs: DataFrame, items: DataFrame, window: int = 10, *extra: str) -> DataFrame:
    """doc_id, n_words, longest, spans, items of each row of ``docs`` (doc_id, text); ``extra`` columns stay.

    ``items`` (item_id, text) are the test items. A window is a run of ``window`` words of an item, or a whole
    item of fewer words. ``spans`` are the stretches of words (begin, end exclusive, from 0) inside occurrences of
    windows, touching ones joined; ``items`` the ids, as sorted strings, of items with an occurring window;
    ``longest`` the longest run shared with an item, 0 if shorter than every window.

    Null texts have no words. Rows with equal doc_id stay apart; items that share an id count as one, a null id
    as the empty string; items without words never match. Without items, or with an empty table of documents,
    there are no spans or no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    wanted = docs.select("doc_id", *extra, folded().alias("text"))
    blobs = automata(items, window)
    parts = blobs.count()
    if parts <= 1:
        row = blobs.first()
        shared = spark.sparkContext.broadcast((bytes(row["blob"]), row["ids"]) if row else (None, None))
        return _scan(wanted, shared, window)
    # one pass over the documents for each automaton; what they find is put together by row
    rows = stored(wanted.withColumn("__row", F.monotonically_increasing_id()), "folded")
    found = []
    for row in blobs.toLocalIterator():
        shared = spark.sparkContext.broadcast((bytes(row["blob"]), row["ids"]))
        scanned = _scan(rows, shared, window)
        found.append(stored(scanned if not found else scanned.where(F.size("items") > 0), "found"))
        shared.unpersist()
    both = found[0]
    for more in found[1:]:
        both = both.union(more)
    return both.groupBy("__row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", *extra)],
        F.first("n_words").alias("n_words"),
        F.max("longest").alias("longest"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).withColumn("spans", _joined("spans")).drop("__row")


def _cut_text(text: str, spans) -> str:
    data = text.encode("utf-8", "replace")
    places = [m.span() for m in _SPAN.finditer(data.translate(FOLD))]
    out, at = [], 0
    for s in spans:
        out.append(data[at : places[s["begin"]][0]])
        at = places[s["end"] - 1][1]
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, longest_span: int = 0, most_covered: float = 0.5
) -> DataFrame:
    """``docs`` without benchmark passages: spans of more than ``longest_span`` words go from the text, documents
    of which such spans cover more than ``most_covered`` go altogether.

    All columns stay as they are but for ``text``, which may have any companions. Nulls and empty texts stay;
    rows repeated whole are treated alike; without items nothing changes.
    """
    marked = docs.select("doc_id", "text", mark_of().alias("__mark"))
    spans = F.filter("spans", lambda s: s["end"] - s["begin"] > longest_span)
    hit = matches(marked, items, window, "__mark").where(F.size("spans") > 0)
    hit = hit.select(F.col("doc_id").alias("__id"), F.col("__mark").alias("__hash"), "n_words", spans.alias("__spans"))
    covered = F.aggregate("__spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"]) / F.col("n_words")
    touched = hit.where(F.size("__spans") > 0).withColumn("__covered", covered).drop("n_words")
    touched = stored(touched.dropDuplicates(["__id", "__hash"]), "contaminated")
    side = F.broadcast(touched) if fits(touched) else touched

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else _cut_text(t, s) for t, s in zip(texts, spans)])

    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("__hash"))
    joined = docs.join(side, same, "left").where(F.coalesce("__covered", F.lit(0.0)) <= most_covered)
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut(text_of(), "__spans"))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP12_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS m FROM i WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM sized)
),
places AS (
  SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM sized))
),
found AS (SELECT doc_id, places.m AS m, p, item_id FROM places JOIN windows ON places.g = windows.g AND places.m = windows.m),
words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + m)) AS pos FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""
