"""Token ids of whole documents, written as wavelet matrix files and read back.

Documents are dealt by ranges of doc_id, encoded in order and cut into shards of about ``SHARD_TOKENS``. Each
shard becomes one file through Spark's own writer, which commits what a task wrote or nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from obsframe.llm import wavelet
from obsframe.llm.common import fits, scratch_path, stored, table, tasks, text_of

SHARD_TOKENS = 4_000_000
#: Words that a Python worker remembers between batches.
REMEMBERED = 500_000
#: Bytes of text whose words are looked at together.
TOGETHER = 6 << 20
END_ID = 1
# Between records of a file Spark puts a separator: an empty skippable zstd frame.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"

_encoders: dict[str, WordEncoder] = {}
# Letters up to U+012F: their lower case and normal form depend on nothing around them.
_LETTERS = r"[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}]+"
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _take(values: np.ndarray, stops: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches of ``values`` (ended by ``stops``) those numbered ``which``, end to end; their lengths."""
    sizes = np.diff(stops, prepend=0)[which]
    ends = np.cumsum(sizes)
    shift = np.repeat(stops[which] - ends, sizes)
    return values[shift + np.arange(len(shift))], sizes


class WordEncoder:
    """Encodes texts with the library, each distinct word between white space once a batch.

    For tokenizers whose pre-tokens never hold white space. A word of simple letters followed by ASCII marks
    is two pre-tokens; the letters are lower-cased here and words sent together, as each ends with a token
    that only ends words. Any other word goes to the library as it stands.
    """

    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, dtype=bool)
        self.ends[[i for t, i in self.library.get_vocab().items() if t.endswith(self.END)]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.values, self.stops = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def _keep(self, words: list[str], ids: list[np.ndarray], stops: list[np.ndarray]) -> None:
        base = np.cumsum([len(self.values), *map(len, ids[:-1])])
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.stops = np.concatenate([self.stops, *[s + b for s, b in zip(stops, base)]])
        self.values = np.concatenate([self.values, *ids])

    def _other(self, words: list[str]) -> None:
        if words:
            done = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
            ids = np.array([i for x in done for i in x], dtype=self.dtype)
            self._keep(words, [ids], [np.cumsum([len(x) for x in done])])

    def _simple(self, words: list[str]) -> None:
        ids, stops, kept, odd = [], [], [], []
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            found = self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ids.append(np.array(found, dtype=self.dtype))
            stops.append(np.flatnonzero(self.ends[ids[-1]]) + 1)
            kept += some
            if len(stops[-1]) != len(some):
                odd += some
                ids.pop(), stops.pop()
                del kept[-len(some) :]
        if kept:
            self._keep(kept, ids, stops)
        self._other(odd)

    def _numbers(self, words: pa.Array, learn) -> np.ndarray:
        """Number of each word among those known, after learning the new ones."""
        listed = words.to_pylist()
        new = [w for w in dict.fromkeys(listed) if w not in self.known]
        if new:
            learn(new)
        return np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and each text's number of ids. ``texts`` are strings without nulls."""
        if len(self.known) > REMEMBERED:
            self.forget()
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy()
        letters = pc.utf8_rtrim(words, characters=_MARKS)
        plain = pc.match_substring_regex(letters, f"^{_LETTERS}$")
        marks = pc.replace_substring_regex(words, f"^{_LETTERS}", "", max_replacements=1)
        first = pc.if_else(plain, pc.utf8_lower(letters), "").dictionary_encode()
        second = pc.if_else(plain, marks, words).dictionary_encode()
        one = self._numbers(first.dictionary, self._simple)[first.indices.to_numpy()]
        two = self._numbers(second.dictionary, self._other)[second.indices.to_numpy()]
        ids, sizes = _take(self.values, self.stops, np.stack((one, two), axis=1).ravel())
        by_word = sizes.reshape(-1, 2).sum(axis=1)
        ids, sizes = _take(ids, np.cumsum(by_word), which)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return ids, np.diff(ends[lists.offsets.to_numpy()])


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _together(batch: pa.RecordBatch):
    """Slices of a batch with about ``TOGETHER`` bytes of text each."""
    stops = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        before = stops[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(stops, before + TOGETHER, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _shards(path: str, shard_tokens: int):
    """Function for mapInArrow: (doc_id, text), in order, to one file's content per row."""

    def run(batches):
        words, part, shard = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], words.dtype)
        ids, lengths, content, size = [], [], [], 0

        def close():
            nonlocal shard, size
            data = np.concatenate(content)
            blob = wavelet.build(data, ids, np.array(lengths), part=part, shard=shard)
            shard, size = shard + 1, 0
            for held in (ids, lengths, content):
                held.clear()
            return pa.RecordBatch.from_pydict({"content": [blob]}, schema=pa.schema([("content", pa.binary())]))

        for batch in batches:
            for some in _together(batch):
                encoded, counts = words.encode(some.column("text"))
                at = 0
                for doc_id, count in zip(some.column("doc_id").to_pylist(), counts.tolist()):
                    ids.append(doc_id)
                    content += [encoded[at : at + count], end]
                    lengths.append(count + 1)
                    at += count
                    size += count + 1
                    if size >= shard_tokens:
                        yield close()
        if ids:
            yield close()
        pa.default_memory_pool().release_unused()  # the worker lives on with its words alone

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str | None = None, parts: int | None = None, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode ``docs`` (doc_id, text) and write one wavelet matrix file per shard below ``path``.

    Ascending doc_id over the files, null ids first; rows with the same doc_id follow a hash of their text.
    Null text counts as empty, and id 1 ends every document. An empty table writes no shard.
    """
    ordered = (
        docs.select("doc_id", F.make_valid_utf8(text_of()).alias("text"))
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(parts or tasks(docs.sparkSession), "doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text")
    )
    shards = ordered.mapInArrow(_shards(tokenizer or default_tokenizer(), shard_tokens), "content binary")
    (
        shards.select(F.col("content").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def _documents(batches):
    """Function for mapInArrow: files to one row per document, the ids taken out of the planes."""
    names = ["part", "shard", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"]
    schema = pa.schema([(n, pa.int64()) for n in names])
    for batch in batches:
        for content in batch.column("content"):
            data = content.as_buffer()
            if not data.size:
                continue
            shard = wavelet.WaveletMatrix(memoryview(data))
            wide = shard.tokens().astype("<u4").tobytes()
            stops = np.cumsum(shard.lengths)
            starts = stops - shard.lengths
            crc = [zlib.crc32(wide[4 * b : 4 * e]) for b, e in zip(starts.tolist(), stops.tolist())]
            n = len(crc)
            head = shard.header
            columns = [np.full(n, head["part"]), np.full(n, head["shard"]), np.arange(n), shard.doc_ids, starts, shard.lengths, crc]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone."""
    schema = "part long, shard long, place long, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = stored(files.mapInArrow(_documents, schema), "token-rows")
    sizes = rows.groupBy("part", "shard").agg(F.sum("n_tokens").alias("size"))
    # shards of a part, then parts: the one ordered pass over everything sees a row per part
    ahead = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("size").alias("part_size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("part_start"))
    offsets = sizes.withColumn("shard_start", F.coalesce(F.sum("size").over(ahead), F.lit(0))).join(parts, "part")
    offsets = stored(offsets.select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("offset")), "offsets")
    return rows.join(F.broadcast(offsets) if fits(offsets) else offsets, ["part", "shard"]).select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens (the end id included) for each row of ``docs`` (doc_id, text)."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        for batch in batches:
            for some in _together(batch):
                counts = encoder(path).encode(some.column("text"))[1]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(counts + 1, pa.int64())], ["doc_id", "n_tokens"])
        encoder(path).forget()  # the worker lives on in stages that need the room
        pa.default_memory_pool().release_unused()

    kept = docs.select("doc_id", F.make_valid_utf8(text_of()).alias("text"))
    return kept.mapInArrow(run, T.StructType([kept.schema["doc_id"], T.StructField("n_tokens", T.LongType())]))
