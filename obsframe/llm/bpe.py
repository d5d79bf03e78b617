r"""Byte-level BPE with a pair occurrence index.

All distinct new pre-tokens of a batch lie side by side in one array of symbols. An index maps every pair that
has a rank to its positions. Ranks are applied in ascending order: all occurrences of the pair are merged at
once, and the pairs that the merges make enter the lists of their own ranks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm.common import table, text_of

#: Entries that a Python worker remembers between batches.
REMEMBERED = 600_000

# White space beyond ASCII, as Unicode has it.
_WIDE_SPACE = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_SPACE = r"\t-\r " + _WIDE_SPACE
# The published pre-token pattern of byte-level BPE, with the white space it means spelled out.
_PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# A pre-token never goes on from other characters into white space, so texts may be cut there.
_STRETCH = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_OTHER_SPACE = re.compile(f"[{_WIDE_SPACE}]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 characters for
    themselves, the other bytes in ascending order from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndex:
    """Merge rules as arrays; ``segment`` applies them to many pre-tokens together."""

    def __init__(self, first: np.ndarray, second: np.ndarray, merged: np.ndarray, size: int):
        self.size, self.first, self.second, self.merged = size, first, second, merged
        keys = first.astype(np.int64) * size + second
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        # rules whose result an earlier rule takes up: their occurrences in one pre-token go one by one
        taken = np.full(size, len(first))
        np.minimum.at(taken, first, np.arange(len(first)))
        np.minimum.at(taken, second, np.arange(len(first)))
        self.early = taken[merged] < np.arange(len(first))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)

    def segment(self, symbols: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """The final symbols of each pre-token."""
        n = len(symbols)
        symbols = symbols.astype(np.int64)
        word = np.repeat(np.arange(len(lengths)), lengths)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        stops = np.cumsum(lengths)
        after[stops[lengths > 0] - 1] = -1
        before[(stops - lengths)[lengths > 0]] = -1
        alive = np.ones(n, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(positions: np.ndarray) -> None:
            found = self.ranks(symbols[positions], symbols[after[positions]])
            positions, found = positions[found >= 0], found[found >= 0]
            if not len(found):
                return
            order = np.argsort(found, kind="stable")
            found, positions = found[order], positions[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for rank, some in zip(found[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts)):
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(some)

        enter(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            a, b = self.first[rank], self.second[rank]
            # an entry is stale once one of its two symbols was merged away
            at = at[alive[at] & (symbols[at] == a)]
            at = at[after[at] >= 0]
            at = at[symbols[after[at]] == b]
            if not len(at):
                continue
            if a == b and len(at) > 1:  # of overlapping occurrences every second one, from the left
                run = np.concatenate(([True], after[at[:-1]] != at[1:]))
                start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            if self.early[rank] and len(at) > 1:
                leftmost = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
                if not leftmost.all():
                    index[rank] = [at[~leftmost]]
                    heapq.heappush(active, rank)
                    at = at[leftmost]
            gone = after[at]
            alive[gone] = False
            symbols[at] = self.merged[rank]
            rest = after[gone]
            after[at] = rest
            before[rest[rest >= 0]] = at[rest >= 0]
            left = before[at]
            enter(np.unique(np.concatenate((left[left >= 0], at[rest >= 0]))))
        kept = symbols[alive]
        sizes = np.bincount(word[alive], minlength=len(lengths))
        return np.split(kept, np.cumsum(sizes)[:-1]) if len(lengths) else []


class ByteBpe:
    """A byte-level BPE read from a vocabulary file (JSON of the tokenizers library)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {content.encode(): i for content, i in added.items()}
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        size = max([*vocab.values(), *added.values()]) + 1
        self.pieces = [b""] * size
        for token, i in (vocab | added).items():
            whole = all(c in letters for c in token)
            self.pieces[i] = bytes(letters[c] for c in token) if whole else token.encode()
        self.start = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.start[byte] = vocab[letter]
        rules = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in rules], dtype=np.int64).reshape(-1, 3)
        self.index = PairIndex(ids[:, 0], ids[:, 1], ids[:, 2], size)
        self.stretches: dict[bytes, bytes] = {}
        self.tokens: dict[bytes, bytes] = {}

    def _pre_tokens(self, text: str) -> list[bytes | int]:
        """Pre-tokens in UTF-8; the ids of added tokens as they are."""
        out: list[bytes | int] = []
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            out += [p.encode() for p in _PRE_TOKEN.findall(text, at, found.start())] if at < found.start() else []
            out.append(self.added[found[0].encode()])
            at = found.end()
        rest = text[at:] if at else text
        return out + [p.encode() for p in _PRE_TOKEN.findall(rest)]

    def _merge(self, new: list[bytes]) -> None:
        """Segment all new pre-tokens in one pass over the index."""
        lengths = np.array([len(p) for p in new], dtype=np.int64)
        symbols = self.start[np.frombuffer(b"".join(new), np.uint8)]
        done = self.index.segment(symbols, lengths)
        self.tokens.update((p, s.astype("<u4").tobytes()) for p, s in zip(new, done))

    def learn(self, new: list[bytes]) -> None:
        split = [(s, self._pre_tokens(s.decode("utf-8", "replace"))) for s in new]
        wanted = {p for _, parts in split for p in parts if isinstance(p, bytes)}
        fresh = [p for p in wanted if p not in self.tokens]
        if fresh:
            self._merge(fresh)
        ids = {i: np.array([i], "<u4").tobytes() for i in self.added.values()}
        self.stretches.update(
            (s, b"".join([self.tokens[p] if isinstance(p, bytes) else ids[p] for p in parts])) for s, parts in split
        )

    def cut(self, text: bytes) -> list[bytes]:
        """Stretches that are encoded independently; the whole text if it holds unusual white space."""
        if not text.isascii() and _OTHER_SPACE.search(text.decode("utf-8", "replace")):
            return [text]
        return _STRETCH.findall(text)

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        out, at = [], 0
        while at < len(texts):
            docs, size = [], 0
            while at < len(texts) and (not docs or size < 8 << 20):
                docs.append(self.cut(texts[at] or b""))
                size += len(texts[at] or b"")
                at += 1
            used = set().union(*docs)
            new = used.difference(self.stretches)
            if len(self.stretches) + len(new) > REMEMBERED:
                self.stretches.clear()
                self.tokens.clear()
                new = used
            self.learn(list(new))
            out += [b"".join([self.stretches[s] for s in stretches]) for stretches in docs]
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_coders: dict[str, ByteBpe] = {}


def coder(path: str) -> ByteBpe:
    if path not in _coders:
        _coders[path] = ByteBpe(path)
    return _coders[path]


def encode_decode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded text for each row of ``docs`` (doc_id, text).

    Null text counts as empty and gives no ids; repeated rows stay repeated; an empty table gives no rows.
    Other columns of ``docs`` are ignored.
    """
    path = tokenizer or default_tokenizer()

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                ids = coder(path).encode(some.column("text").to_pylist())
                decoded = [coder(path).decode(x) for x in ids]
                lists = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
                arrays = [some.column("doc_id"), pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    kept = docs.select("doc_id", text_of().cast("binary").alias("text"))
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text: as ``encode_decode``, but only the
    digests leave the task."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                ids = coder(path).encode(some.column("text").to_pylist())
                texts = (coder(path).decode(x).encode() for x in ids)
                arrays = [
                    some.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kept = docs.select("doc_id", text_of().cast("binary").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
