"""Wavelet matrix over token ids: one self-contained compressed file per shard.

Level by level, from the highest bit down, the ids are kept as one plane of bits and then split, stably, into
those with a 0 and those with a 1. Ranks on the planes lead from a position to its token and from a token to
its positions. Ids are first numbered within the shard, so a shard with s distinct ids has ceil(log2 s) planes.

File: magic, length of the header, header (JSON), sections. A plane is cut into blocks of ``BLOCK_BITS``; each
block is one zstd frame and the header names its place and the ones before it, so a lookup reads one block a
level. Little-endian throughout.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"WTMX0001"
BLOCK_BITS = 1 << 19
BLOCK_BYTES = BLOCK_BITS // 8


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, **more) -> bytes:
    """The file of one shard. ``lengths`` are the documents' token counts; ``more`` goes into the header."""
    ids = np.ascontiguousarray(ids)
    present = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=bool)
    present[ids] = True
    alphabet = np.flatnonzero(present).astype("<u4")
    number = np.zeros(len(present), dtype=np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    number[alphabet] = np.arange(len(alphabet))
    current = number[ids]
    levels = max(len(alphabet) - 1, 0).bit_length()
    pack = zstandard.ZstdCompressor(level=1).compress
    sections: list[bytes] = []
    planes = []
    for bit in range(levels - 1, -1, -1):
        ones = (current & current.dtype.type(1 << bit)) != 0
        bits = np.packbits(ones, bitorder="little")
        frames = [pack(bits[i : i + BLOCK_BYTES].tobytes()) for i in range(0, len(bits), BLOCK_BYTES)]
        counts = np.add.reduceat(np.bitwise_count(bits), range(0, len(bits), BLOCK_BYTES), dtype=np.int64)
        planes.append({"sizes": [len(f) for f in frames], "ones": counts.tolist()})
        sections += frames
        current = np.concatenate((current[~ones], current[ones]))
    known = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    absent = np.array([d is None for d in doc_ids], dtype=bool)
    tables = [pack(x.tobytes()) for x in (alphabet, known, np.packbits(absent), lengths.astype("<i8"))]
    header = json.dumps(
        {"n": len(ids), "docs": len(doc_ids), "alphabet": len(alphabet), "planes": planes, "tables": [len(x) for x in tables]}
        | more
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *tables, *sections])


class WaveletMatrix:
    """Reads one file. Positions count from 0; ``rank`` counts before a position."""

    def __init__(self, data: bytes | memoryview):
        self._data = memoryview(data)
        if bytes(self._data[:8]) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = struct.unpack("<I", self._data[8:12])[0]
        self.header = json.loads(bytes(self._data[12 : 12 + size]))
        self._unpack = zstandard.ZstdDecompressor().decompress
        at, tables = 12 + size, []
        for n in self.header["tables"]:
            tables.append(self._unpack(self._data[at : at + n]))
            at += n
        self.alphabet = np.frombuffer(tables[0], "<u4")
        absent = np.unpackbits(np.frombuffer(tables[2], np.uint8), count=self.header["docs"])
        self.doc_ids = [None if a else d for d, a in zip(np.frombuffer(tables[1], "<i8").tolist(), absent.tolist())]
        self.lengths = np.frombuffer(tables[3], "<i8")
        self.n = self.header["n"]
        self._blocks: dict[tuple[int, int], np.ndarray] = {}
        self._places, self._before, self._zeros = [], [], []
        for plane in self.header["planes"]:
            ends = np.cumsum([at, *plane["sizes"]])
            self._places.append(list(zip(ends[:-1].tolist(), ends[1:].tolist())))
            ones = np.concatenate(([0], np.cumsum(plane["ones"], dtype=np.int64)))
            self._before.append(ones)
            self._zeros.append(self.n - int(ones[-1]))
            at = int(ends[-1])

    @property
    def levels(self) -> int:
        return len(self._places)

    def _block(self, level: int, k: int) -> np.ndarray:
        """Bytes of one block; the last ones stay unpacked."""
        if (level, k) not in self._blocks:
            if len(self._blocks) >= 4 * max(1, self.levels):
                self._blocks.pop(next(iter(self._blocks)))
            begin, end = self._places[level][k]
            self._blocks[level, k] = np.frombuffer(self._unpack(self._data[begin:end]), np.uint8)
        return self._blocks[level, k]

    def _ones(self, level: int, position: int) -> int:
        """Ones of a plane before ``position``."""
        k, rest = divmod(position, BLOCK_BITS)
        total = int(self._before[level][k])
        if rest:
            block = self._block(level, k)
            total += int(np.bitwise_count(block[: rest // 8]).sum())
            if rest % 8:
                total += int(block[rest // 8] & ((1 << rest % 8) - 1)).bit_count()
        return total

    def _bit(self, level: int, position: int) -> int:
        k, rest = divmod(position, BLOCK_BITS)
        return int(self._block(level, k)[rest // 8]) >> (rest % 8) & 1

    def access(self, position: int) -> int:
        """The token id at a position."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        code = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, position), self._ones(level, position)
            position = self._zeros[level] + ones if bit else position - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int, int] | None:
        """Where the occurrences in [begin, end) lie after the last split."""
        code = int(np.searchsorted(self.alphabet, token))
        if code == len(self.alphabet) or self.alphabet[code] != token:
            return None
        for level in range(self.levels):
            low, high = self._ones(level, begin), self._ones(level, end)
            if code >> (self.levels - 1 - level) & 1:
                begin, end = self._zeros[level] + low, self._zeros[level] + high
            else:
                begin, end = begin - low, end - high
        return code, begin, end

    def rank(self, token: int, position: int) -> int:
        found = self._range(token, 0, position)
        return found[2] - found[1] if found else 0

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) ``bit`` in a plane."""
        before = self._before[level]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK_BITS, self.n) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self._block(level, block), bitorder="little")
        bits = bits[: min(BLOCK_BITS, self.n - block * BLOCK_BITS)]
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence."""
        found = self._range(token, 0, self.n)
        if not found or not 0 <= k < found[2] - found[1]:
            raise IndexError(k)
        code, position = found[0], found[1] + k
        for level in range(self.levels - 1, -1, -1):
            bit = code >> (self.levels - 1 - level) & 1
            position = self._select_bit(level, bit, position - self._zeros[level] if bit else position)
        return position

    def occurrences(self, token: int) -> list[int]:
        """All positions of a token, ascending."""
        return [self.select(token, k) for k in range(self.count(token))]

    def _plane(self, level: int) -> np.ndarray:
        bits = np.concatenate([np.frombuffer(self._unpack(self._data[b:e]), np.uint8) for b, e in self._places[level]])
        return np.unpackbits(bits, count=self.n, bitorder="little").view(bool)

    def tokens(self) -> np.ndarray:
        """All ids in order: the splits undone from the last level up."""
        codes = np.zeros(self.n, dtype=np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            ones, zeros = self._plane(level), self._zeros[level]
            merged = np.empty_like(codes)
            merged[~ones] = codes[:zeros]
            merged[ones] = codes[zeros:] | codes.dtype.type(1 << (self.levels - 1 - level))
            codes = merged
        return self.alphabet[codes]
