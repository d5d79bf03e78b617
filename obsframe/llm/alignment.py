"""Two tokenizers aligned by bytes, with corpus-wide counts of linked id pairs from inverted pair bitmaps.

A is a byte-level BPE (tokenizers library), B a sentencepiece model with byte fallback. Both cut a text only
into tokens that never reach from other characters into a space, so the stretches between such places are encoded
and aligned once a worker, whatever the number of documents that hold them.

Documents are dealt into blocks. For each pair of ids a block holds one compressed bitmap of the documents in which
the pair is linked (plane 0), and one for each bit of the number of its further links there (planes 1, 2, ...).
Document counts are the popcounts of a pair's bitmaps of plane 0 over all blocks, link counts those of all planes
by their weights. With its count attached, each bitmap gives the count back to the documents it lists.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.bpe import byte_letters
from obsframe.llm.common import stored, table, text_of
from obsframe.llm.words import together

#: Stretches that a Python worker remembers between batches.
REMEMBERED = 300_000
#: Stretches sent to the libraries together: what those return takes far more room than the ids.
TOGETHER = 8_192
#: Bytes of text aligned together: numbers of its stretches and links take many times as much.
TEXT_TOGETHER = 1 << 20
#: Links of a block whose bitmaps are made together.
LINKS_TOGETHER = 1 << 19
#: Longer stretches are aligned anew each time.
LONG = 200
#: A block of documents is closed once it has this many links or documents.
BLOCK_LINKS = 3_000_000
BLOCK_DOCS = 32_768

_WIDE_SPACE = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_MARK = chr(0x2581)
_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = False


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _gather(values: np.ndarray, stops: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Of stretches of ``values`` (cut at ``stops``, from 0 on) those numbered ``which``, end to end."""
    sizes = np.diff(stops)[which]
    shift = np.repeat(stops[which] - (np.cumsum(sizes) - sizes), sizes)
    return values[shift + np.arange(len(shift))]


def _stops(counts) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


class Aligned:
    """What the alignment of numbered stretches gives: sizes (A tokens, B tokens, groups, links, whether both
    tokenizers give the stretch back), groups as text, pairs of ids end to end."""

    def __init__(self, sizes: np.ndarray, groups: pa.Array, pairs: np.ndarray):
        self.sizes, self.groups, self.pairs = sizes, groups, pairs
        self.stops = _stops(sizes[:, 3])

    @classmethod
    def none(cls) -> Aligned:
        return cls(np.zeros((0, 5), np.int64), pa.array([], pa.string()), np.zeros(0, np.int64))

    def and_then(self, more: Aligned) -> Aligned:
        sizes, pairs = np.concatenate((self.sizes, more.sizes)), np.concatenate((self.pairs, more.pairs))
        return Aligned(sizes, pa.concat_arrays([self.groups, more.groups]), pairs)

    def first(self, n: int) -> Aligned:
        return Aligned(self.sizes[:n], self.groups.slice(0, n), self.pairs[: self.stops[n]])


class Side:
    """The ids of one tokenizer for many stretches, with the bytes of each id."""

    def __init__(self, pieces: list[bytes]):
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.stops = _stops([len(p) for p in pieces])
        self.length = np.diff(self.stops)

    def gives_back(self, ids: np.ndarray, counts: np.ndarray, text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the bytes of each stretch's ids are those of the stretch."""
        ends = _stops(self.length[ids])[_stops(counts)]
        same = np.diff(ends) == sizes
        kept = np.repeat(same, counts)
        equal = _gather(self.flat, self.stops, ids[kept]) == text[np.repeat(same, sizes)]
        wrong = np.diff(_stops(~equal)[_stops(sizes[same])])
        same[np.flatnonzero(same)[wrong > 0]] = False
        return same


class Aligner:
    """Aligns texts under two tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.side_a = Side(pieces)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces, self.mark = [], self.b.piece_to_id(_MARK)
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            pieces.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_MARK, " ").encode())
            if not (byte or self.b.is_control(i)) and _MARK in piece.lstrip(_MARK):
                raise ValueError(f"piece {piece!r} reaches into a space")
        self.side_b = Side(pieces)
        # every id as text with what may follow it
        self.ids = max(len(self.side_a.length), len(self.side_b.length))
        self.written = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(self.ids)])
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.known = Aligned.none()

    def align(self, ids_a: np.ndarray, count_a: np.ndarray, ids_b: np.ndarray, count_b: np.ndarray, new: list[bytes]) -> Aligned:
        """Align the ids of the stretches ``new``, all at once: byte ends of both sides on one line."""
        text, sizes = np.frombuffer(b"".join(new), np.uint8), np.array([len(s) for s in new], np.int64)
        good = self.side_a.gives_back(ids_a, count_a, text, sizes) & self.side_b.gives_back(ids_b, count_b, text, sizes)
        ids_a, ids_b = ids_a[np.repeat(good, count_a)], ids_b[np.repeat(good, count_b)]
        count_a, count_b = count_a * good, count_b * good
        owner_a = np.repeat(np.arange(len(new)), count_a)
        ends_a, ends_b = np.cumsum(self.side_a.length[ids_a]), np.cumsum(self.side_b.length[ids_b])
        # between neighbouring ends of either side lies one token of each: a link
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        pairs = ids_a[at_a] << 32 | ids_b[at_b]
        last_a, last_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        count = lambda owners: np.bincount(owners, minlength=len(new))
        table = np.stack((count_a, count_b, count(owner_a[last_a]), count(owner_a[at_a]), good), axis=1)
        # ids of a group in order, A's before B's; "|" behind the last of A, ";" behind the last of B
        group = np.concatenate((2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1))
        which = np.concatenate((ids_a + last_a * self.ids, ids_b + last_b * 2 * self.ids))
        written = self.written.take(pa.array(which[np.argsort(group, kind="stable")]))
        stops = pa.array(_stops(count_a + count_b).astype(np.int32))
        return Aligned(table.astype(np.int64), pc.binary_join(pa.ListArray.from_arrays(stops, written), ""), pairs)

    def learn(self, new: list[bytes]) -> Aligned:
        """Every stretch begins with a space, which B adds by itself."""
        parts = [self._encode(new[i : i + TOGETHER]) for i in range(0, len(new), TOGETHER)]
        return self.align(*[np.concatenate(p) for p in zip(*parts)], new)

    def _encode(self, some: list[bytes]) -> tuple[np.ndarray, ...]:
        """Ids of A end to end, their number for each stretch, and the same for B."""
        texts = [s.decode() for s in some]
        coded_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # nothing after the space: B makes no token of an empty text
        coded_b = [b or [self.mark] for b in self.b.encode([t[1:] for t in texts], num_threads=1)]
        flat = lambda lists: np.fromiter(chain.from_iterable(lists), np.int64)
        sizes = lambda lists: np.fromiter(map(len, lists), np.int64, len(lists))
        return flat(coded_a), sizes(coded_a), flat(coded_b), sizes(coded_b)

    def stretches(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """Distinct stretches of all texts, and the offsets of each text's stretches.

        Texts start with a space. A stretch starts at a space behind anything but white space; texts with
        white space beyond ASCII are one stretch.
        """
        begin = texts.offset
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[begin : begin + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = (offsets - offsets[0]).astype(np.int64)
        cut = np.zeros(len(raw), dtype=bool)
        cut[1:] = (raw[1:] == 0x20) & _NOT_SPACE[raw[:-1]]
        wide = pc.match_substring_regex(texts, f"[{_WIDE_SPACE}]").to_numpy(zero_copy_only=False)
        for t in np.flatnonzero(wide).tolist():
            cut[offsets[t] : offsets[t + 1]] = False
        cut[offsets[:-1]] = True
        starts = np.flatnonzero(cut)
        stops = np.append(starts, len(raw)).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(raw))])
        return pieces.dictionary_encode(), np.append(np.searchsorted(starts, offsets[:-1]), len(starts))

    def texts(self, texts: pa.Array):
        """For each text: A tokens, B tokens, groups, links, digest of the groups; all links' pairs and texts."""
        coded, offsets = self.stretches(texts)
        listed = coded.dictionary.to_pylist()
        if len(self.numbers) > REMEMBERED:
            self.forget()
        new = [s for s in listed if len(s) <= LONG and s not in self.numbers]
        long = [s for s in listed if len(s) > LONG]  # for these texts alone
        held = self.known.and_then(self.learn(new + long)) if new or long else self.known
        self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new))))
        self.known = held.first(len(self.numbers))
        own = dict(zip(long, range(len(self.numbers), len(self.numbers) + len(long))))
        number = np.fromiter((own[s] if len(s) > LONG else self.numbers[s] for s in listed), np.int64, len(listed))
        which = number[coded.indices.to_numpy()]
        n, per_text = len(offsets) - 1, np.diff(offsets)
        sums = np.stack([np.diff(_stops(column[which])[offsets]) for column in held.sizes.T], axis=1)
        # a text that is empty, or that one stretch does not give back, has no tokens
        good = (sums[:, 4] == per_text) & (pc.binary_length(texts).to_numpy() > 1)
        which = which[np.repeat(good, per_text)]
        stops = pa.array(_stops(per_text * good).astype(np.int32))
        groups = pc.binary_join(pa.ListArray.from_arrays(stops, held.groups.take(pa.array(which))), "")
        digests = [hashlib.sha256(g[:-1].encode()).hexdigest() if g else "" for g in groups.to_pylist()]
        text = np.repeat(np.repeat(np.arange(n), per_text * good), held.sizes[which, 3])
        return sums[:, :4] * good[:, None], digests, _gather(held.pairs, held.stops, which), text


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


# ---------------------------------------------------------------- bitmaps


def _packed(values: np.ndarray, counts: np.ndarray, size: int) -> pa.Array:
    """Sorted sets of numbers below ``size``, end to end, as bitmaps: 16-bit numbers, or one bit a number if shorter."""
    bits = -(-size // 8)
    dense = counts * 2 > bits
    lengths = np.where(dense, bits, counts * 2)
    stops = np.concatenate(([0], np.cumsum(lengths)))
    out = np.zeros(stops[-1], np.uint8)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
    thin = ~dense[owner]
    at = stops[owner[thin]] + 2 * place[thin]
    out[at], out[at + 1] = values[thin] & 255, values[thin] >> 8
    thick = ~thin
    np.bitwise_or.at(out, stops[owner[thick]] + values[thick] // 8, (1 << (values[thick] % 8)).astype(np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(out)])


def _unpacked(maps: pa.Array, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in all sets, and the set each comes from."""
    offsets = np.frombuffer(maps.buffers()[1], np.int32)[maps.offset : maps.offset + len(maps) + 1].astype(np.int64)
    data = np.frombuffer(maps.buffers()[2], np.uint8)
    dense = np.flatnonzero(counts * 2 > -(-size // 8))
    thin = np.flatnonzero(counts * 2 <= -(-size // 8))
    n = counts[thin]
    at = np.repeat(offsets[thin] - 2 * (np.cumsum(n) - n), n) + 2 * np.arange(n.sum())
    values, owners = [data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8], [np.repeat(thin, n)]
    for i in dense.tolist():
        values.append(np.flatnonzero(np.unpackbits(data[offsets[i] : offsets[i + 1]], bitorder="little")))
        owners.append(np.full(len(values[-1]), i))
    return np.concatenate(values), np.concatenate(owners)


_DOC = ["doc_id", "place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_MAP = ["pair", "plane", "n_docs", "docs"]


class Block:
    """Links of the documents of one block, each as one number: pair of ids (B's below ``ids_b``), place."""

    def __init__(self, number: int, ids_b: int):
        self.number, self.ids_b, self.docs, self.links = number, ids_b, 0, 0
        self.parts: list[np.ndarray] = []

    def add(self, pairs: np.ndarray, text: np.ndarray, docs: int) -> None:
        keys = (pairs >> 32) * self.ids_b
        keys += pairs & 0xFFFFFFFF
        keys *= BLOCK_DOCS
        keys += text + self.docs
        self.parts.append(keys)
        self.docs += docs
        self.links += len(pairs)

    def bitmaps(self) -> Iterator[dict[str, pa.Array]]:
        """Bitmaps of ascending pairs, those of about ``LINKS_TOGETHER`` links at a time; takes the links out."""
        keys = np.concatenate(self.parts)
        self.parts.clear()
        keys.sort()
        begin = 0
        while begin < len(keys):
            last = keys[min(begin + LINKS_TOGETHER, len(keys)) - 1] // BLOCK_DOCS
            end = begin + int(np.searchsorted(keys[begin:], (last + 1) * BLOCK_DOCS))
            yield self._bitmaps(keys[begin:end])
            begin = end

    def _bitmaps(self, links: np.ndarray) -> dict[str, pa.Array]:
        first = np.flatnonzero(np.diff(links, prepend=-1))
        keys, times = links[first], np.diff(first, append=len(links))
        planes = [(0, keys)]
        for bit in range(int(times.max(initial=1) - 1).bit_length()):
            planes.append((bit + 1, keys[(times - 1) >> bit & 1 == 1]))
        out: dict[str, list] = {name: [] for name in _MAP}
        for plane, some in planes:
            which, counts = np.unique(some // BLOCK_DOCS, return_counts=True)
            out["pair"].append(which // self.ids_b << 32 | which % self.ids_b)
            out["plane"].append(np.full(len(which), plane))
            out["n_docs"].append(counts)
            out["docs"].append(_packed(some % BLOCK_DOCS, counts, self.docs))
        numbers = {name: pa.array(np.concatenate(out[name]), pa.int64()) for name in _MAP[:3]}
        return numbers | {"docs": pa.concat_arrays(out["docs"])}


def index(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """Written rows of two kinds: a document (``doc_id`` with its sizes, ``place`` in its ``block`` of ``size`` documents)
    or a bitmap (``pair`` of ids, A's in the upper 32 bits, ``plane``, ``n_docs``, ``docs``), told apart by ``is_map``."""
    paths = tokenizers or default_tokenizers()
    kept = docs.select("doc_id", F.concat(F.lit(" "), F.make_valid_utf8(text_of())).alias("text"))
    longs = [T.StructField(c, T.LongType()) for c in (*_DOC[1:6], "block", "size", *_MAP[:3])]
    shape = [kept.schema["doc_id"], *longs, T.StructField("groups_sha256", T.StringType()), T.StructField("docs", T.BinaryType()), T.StructField("is_map", T.BooleanType())]

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids_b = len(aligner(paths).side_b.length)
        block, seen = Block(part << 32, ids_b), []

        def rows(arrays: dict, n: int, is_map: bool):
            """A batch with all columns; those of the other kind are null."""
            arrays = arrays | {"block": pa.array(np.full(n, block.number)), "size": pa.array(np.full(n, block.docs)), "is_map": pa.array(np.full(n, is_map))}
            return pa.RecordBatch.from_arrays([arrays[c] if c in arrays else pa.nulls(n, kinds.field(c).type) for c in kinds.names], schema=kinds)

        def close():
            nonlocal seq, block
            held = [pa.concat_arrays([s[i] for s in seen]) for i in range(len(_DOC))]
            yield rows(dict(zip(_DOC, held)), block.docs, False)
            for maps in block.bitmaps():
                for begin in range(0, len(maps["pair"]), 1 << 16):
                    some = {k: v.slice(begin, 1 << 16) for k, v in maps.items()}
                    yield rows(some, len(some["pair"]), True)
            seq += 1
            block = Block(part << 32 | seq, ids_b)
            seen.clear()

        kinds = None
        for batch in batches:
            if kinds is None:
                arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_()}
                kinds = pa.schema([("doc_id", batch.schema.field("doc_id").type), *[(f.name, arrow[f.dataType]) for f in shape[1:]]])
            for some in together(batch, size=TEXT_TOGETHER):
                for begin in range(0, some.num_rows, BLOCK_DOCS // 2):
                    few = some.slice(begin, BLOCK_DOCS // 2)
                    if block.docs + few.num_rows > BLOCK_DOCS:
                        yield from close()
                    sizes, digests, pairs, text = aligner(paths).texts(few.column("text"))
                    places = pa.array(np.arange(few.num_rows) + block.docs)
                    seen.append([few.column("doc_id"), places, *map(pa.array, sizes.T), pa.array(digests, pa.string())])
                    block.add(pairs, text, few.num_rows)
                    if block.links >= BLOCK_LINKS:
                        yield from close()
        if block.docs:
            yield from close()
        pa.default_memory_pool().release_unused()  # the worker lives on with its stretches alone

    return stored(kept.mapInArrow(run, T.StructType(shape)), "pair-bitmaps")


def pair_counts(bitmaps: DataFrame) -> DataFrame:
    """pair, a, b, n_docs, n_links over all blocks: documents that hold the pair linked, and its links."""
    weight = F.expr("shiftleft(1L, cast(greatest(plane - 1, 0) as int))")
    counts = bitmaps.where("is_map").groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n_docs"))).alias("n_docs"), F.sum(F.col("n_docs") * weight).alias("n_links")
    )
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(0xFFFFFFFF)
    return counts.select("pair", a.alias("a"), b.alias("b"), "n_docs", "n_links")


def scores(bitmaps: DataFrame, counts: DataFrame) -> DataFrame:
    """block, place, n_best, count_sum of each document with links."""
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))  # a row for each id of A
    told = counts.join(F.broadcast(top), "a").select("pair", F.col("n_docs").alias("count"), (F.col("n_docs") == F.col("top")).alias("best"))
    maps = bitmaps.where("is_map").select("block", "size", "pair", "plane", "n_docs", "docs")
    # all bitmaps of a block meet in one task, which holds one block's sums at a time
    sent = maps.join(told.hint("merge"), "pair").repartition("block").sortWithinPartitions("block")

    def run(batches):
        block, best, total = None, None, None

        def out():
            used = np.flatnonzero(total)
            arrays = [np.full(len(used), block), used, best[used], total[used]]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["block", "place", "n_best", "count_sum"])

        for batch in batches:
            numbers = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                some = batch.slice(begin, end - begin)
                if not some.num_rows:
                    continue
                if numbers[begin] != block:
                    if block is not None:
                        yield out()
                    block, size = int(numbers[begin]), int(some.column("size")[0].as_py())
                    best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
                places, owner = _unpacked(some.column("docs"), some.column("n_docs").to_numpy(), len(total))
                weight = 1 << np.maximum(some.column("plane").to_numpy() - 1, 0)
                np.add.at(total, places, (weight * some.column("count").to_numpy())[owner])
                chosen = some.column("best").to_numpy(zero_copy_only=False)
                np.add.at(best, places, (weight * chosen)[owner])
        if block is not None:
            yield out()

    return sent.select("block", "size", "plane", "n_docs", "docs", "count", "best").mapInArrow(
        run, "block long, place long, n_best long, count_sum long"
    )


def align(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of ``docs`` (doc_id, text).

    Groups are cut at the byte offsets where tokens of A and of B both end; links are the pairs of token
    occurrences whose bytes overlap. ``count_sum`` adds up, over a document's links, how many documents hold that
    pair of ids linked; ``n_best`` counts links whose pair is among the most frequent of its A id.

    A null or empty text, or one that either tokenizer does not give back byte by byte, has no tokens: zeros and an
    empty digest. Each row is a document of its own, rows with equal doc_id or text included; an empty table gives no
    rows. Other columns are ignored.
    """
    bitmaps = index(docs, tokenizers)
    counts = stored(pair_counts(bitmaps), "pair-counts")
    rows = bitmaps.where("not is_map").select("block", *_DOC)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.join(scores(bitmaps, counts), ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
