"""Importance resampling of documents towards the word statistics of a target corpus.

Features are the runs of one to ``order`` words, hashed by CRC-32 into buckets. A frequent word's CRC state and a
frequent pair's bucket are broadcast (the head, of bounded size); the CRC of any other feature is worked out
from its bytes, going on from the state of the run it extends. Both ways give the same bucket, so the bucket
totals are exact whatever the head holds. A Gumbel score drawn from the doc_id turns weights into a sample.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.common import stored, table
from obsframe.llm.words import folded, together, word_lists
from obsframe.operators.ordering import positions

BUCKETS = 10_000
#: Most words, and most pairs, whose states and buckets are broadcast.
HEAD = 50_000

Head = tuple[dict[str, int], dict[tuple[str, str], int]]


def _task_head(order: int, most: int):
    """Function for mapInArrow: words and pairs that make up at least one in ``most`` of a task's.

    What is that frequent over all tasks is so in one of them. A task remembers ten times ``most`` of each kind
    between batches and forgets those seen once, twice and so on when there are more.
    """

    def run(batches):
        counts = [Counter() for _ in range(min(order, 2))]
        totals, floors = [0] * len(counts), [0] * len(counts)
        for batch in batches:
            for some in together(batch):
                coded, offsets = word_lists(some.column("text"))
                words, ids = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
                counts[0].update(dict(zip(words, np.bincount(ids, minlength=len(words)).tolist())))
                totals[0] += len(ids)
                if order > 1:
                    at = _starts(offsets, 2)
                    codes, n = np.unique(ids[at] * len(words) + ids[at + 1], return_counts=True)
                    pairs = ((words[c // len(words)], words[c % len(words)]) for c in codes.tolist())
                    counts[1].update(dict(zip(pairs, n.tolist())))
                    totals[1] += int(n.sum())
                for kind, held in enumerate(counts):
                    while len(held) > 10 * most:
                        floors[kind] += 1
                        counts[kind] = held = Counter({k: n for k, n in held.items() if n > floors[kind]})
        for kind, held in enumerate(counts):
            kept = [(k, n) for k, n in held.items() if n * most >= totals[kind]]
            first = [k if kind == 0 else k[0] for k, _ in kept]
            second = [None if kind == 0 else k[1] for k, _ in kept]
            arrays = [pa.array(first, pa.string()), pa.array(second, pa.string()), pa.array([n for _, n in kept], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["first", "second", "n"])

    return run


def frequent(docs: DataFrame, order: int = 1, most: int = HEAD, buckets: int = BUCKETS) -> Head:
    """CRC states of at most ``most`` frequent words and buckets of as many frequent pairs.

    The choice speeds the counting up and changes no result.
    """
    texts = docs.select(folded().alias("text"))
    listed = texts.mapInArrow(_task_head(order, most), "first string, second string, n long")
    summed = stored(listed.groupBy("first", "second").agg(F.sum("n").alias("n")), "frequent")
    best = lambda kind: summed.where(kind).orderBy(F.desc("n"), "first", "second").limit(most).collect()
    states = {r["first"]: zlib.crc32(r["first"].encode()) for r in best("second is null")}
    pairs = {(r["first"], r["second"]): r for r in best("second is not null")} if order > 1 else {}
    return states, {p: zlib.crc32(" ".join(p).encode()) for p in pairs}


def _starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """Places at which a run of ``size`` words begins within its text."""
    n = int(offsets[-1])
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    return np.flatnonzero(left >= size)


def feature_buckets(coded: pa.DictionaryArray, offsets: np.ndarray, head: Head, order: int, buckets: int):
    """Buckets of all features, the runs of one word first, and the text of each."""
    words = coded.dictionary.to_pylist()
    ids = coded.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    states, pairs = head
    # state of each distinct run of the current length, and the run that begins at each place
    state = np.array([states[w] if w in states else zlib.crc32(w.encode()) for w in words], dtype=np.int64)
    run, distinct = ids, [(w,) for w in words] if order > 1 else words
    out, texts = [(state % buckets)[run]], [text]
    tails = [(" " + w).encode() for w in words] if order > 1 else []
    for size in range(2, order + 1):
        at = _starts(offsets, size)
        codes, inverse = np.unique(run[at] * len(words) + ids[at + size - 1], return_inverse=True)
        grown, longer = np.empty(len(codes), np.int64), []
        for i, code in enumerate(codes.tolist()):
            before, word = divmod(code, len(words))
            key = (*distinct[before], words[word])
            known = pairs.get(key) if size == 2 else None
            grown[i] = zlib.crc32(tails[word], int(state[before])) if known is None else known
            longer.append(key)
        out.append((grown % buckets)[inverse])
        texts.append(text[at])
        run = np.full(len(ids), -1)
        run[at] = inverse
        state, distinct = grown, longer
    return np.concatenate(out), np.concatenate(texts)


def hashed(docs: DataFrame, head: Head | None = None, order: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and the features' buckets (little-endian integers, 16 bits if they suffice) of each
    row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(head or ({}, {}))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    kept = docs.select("doc_id", folded().alias("text"))

    def run(batches):
        for batch in batches:
            for some in together(batch):
                coded, offsets = word_lists(some.column("text"))
                found, text = feature_buckets(coded, offsets, shared.value, order, buckets)
                n = np.bincount(text, minlength=some.num_rows)
                data = found[np.argsort(text, kind="stable")].astype(kind) if order > 1 else found.astype(kind)
                stops = np.concatenate(([0], np.cumsum(n))) * data.itemsize
                blobs = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(stops), pa.py_buffer(data)])
                arrays = [some.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), blobs.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_features", "buckets"])

    fields = [kept.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features")]]
    return kept.mapInArrow(run, T.StructType([*fields, T.StructField("buckets", T.BinaryType())]))


def totals(features: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """bucket and its number of features; every task adds up its own rows, so at most a row a bucket leaves it."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            column = batch.column("buckets")
            for begin in range(0, len(column), 4096):
                held = np.frombuffer(b"".join(column.slice(begin, 4096).to_pylist()), kind)
                counts += np.bincount(held, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    parts = features.select("buckets").mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias(name))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: a thousand times the log of the smoothed share in the target over that in the source."""
    s, t = totals(source, "s", buckets), totals(target, "t", buckets)
    both = source.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    both = both.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"])
    whole = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return both.join(F.broadcast(whole)).select("bucket", F.floor(F.log(ratio) * 1000).cast("long").alias("gain"))


def _weights(features: DataFrame, gain: list[int], buckets: int) -> DataFrame:
    """``features`` without buckets, with the floored mean gain."""
    shared = features.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    names = ["doc_id", "n_words", "n_features"]

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                some = batch.slice(begin, 4096)
                n = some.column("n_features").to_numpy()
                held = np.frombuffer(b"".join(some.column("buckets").to_pylist()), kind)
                sums = np.concatenate(([0], np.cumsum(shared.value[held])))
                stops = np.cumsum(n)
                weight = (sums[stops] - sums[stops - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in names], pa.array(weight)], [*names, "weight"])

    fields = [*[features.schema[c] for c in names], T.StructField("weight", T.LongType())]
    return features.mapInArrow(run, T.StructType(fields))


def _gumbel(seed: str) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, order: int = 1, buckets: int = BUCKETS,
    seed: str = "2024", least_words: int = 20, head: int = HEAD,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each row of ``docs`` (doc_id, text).

    ``weight`` is the floored mean of the gains of a document's features (0 without any), ``score`` adds Gumbel
    noise drawn from ``seed`` and the doc_id. Of the N documents with ``least_words`` words the
    floor(percent * N / 100) of highest score are drawn and ranked from 1, ties by smaller doc_id; rank is null
    for the others. Null texts have no words. Rows that share a doc_id are drawn apart, in any order if their scores
    agree; a null doc_id counts as the empty string and comes first among ties. Empty tables give no rows,
    respectively a target without features. Other columns are ignored.
    """
    words = frequent(docs.select("text"), order, head, buckets)
    source = stored(hashed(docs, words, order, buckets), "features")
    wanted = stored(hashed(target.select(F.lit(0).alias("doc_id"), "text"), words, order, buckets), "target-features")
    gain = [r["gain"] for r in sorted(gains(source, wanted, buckets).collect())]  # a row a bucket
    scored = _weights(source, gain, buckets).withColumn("score", F.col("weight") + _gumbel(seed))
    usable = F.col("n_words") >= least_words
    drawn = source.where(usable).count() * percent // 100
    rows = scored.withColumns({"__out": (~usable).cast("int"), "__down": -F.col("score")})
    placed = positions(rows, (), ["__out", "__down", "doc_id"], "__pos")
    rank = F.when((F.col("__out") == 0) & (F.col("__pos") < drawn), F.col("__pos") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_FEATURES = (
    "unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word"
)
_BITS = "list_reduce([n] || range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))"

OP13_SQL = f"""
WITH crc_table AS (SELECT list({_BITS} ORDER BY n) AS tab FROM range(256) r(n)),
d AS (SELECT doc_id, {_FEATURES} FROM documents),
b AS (SELECT {_FEATURES} FROM benchmark),
w AS (SELECT DISTINCT word FROM (SELECT word FROM d UNION ALL SELECT word FROM b)),
crc AS (
  SELECT word, xor(list_reduce(
    [4294967295] || list_transform(range(CAST(length(hex(encode(word))) / 2 AS BIGINT)),
      lambda i: CAST('0x' || substr(hex(encode(word)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM w, crc_table
),
s AS (SELECT bucket, count(*) AS s FROM d JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN crc USING (word) GROUP BY bucket),
whole AS (SELECT (SELECT count(*) FROM d) AS all_s, (SELECT count(*) FROM b) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (all_s + 10000)
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM crc) x LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), whole
),
weights AS (
  SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total
  FROM d JOIN crc USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
  FROM documents LEFT JOIN weights USING (doc_id)
),
ranked AS (
  SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS group_n
  FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(CASE WHEN n_features >= 20 AND place <= 10 * group_n // 100 THEN place END AS BIGINT) AS rank
FROM ranked
"""
