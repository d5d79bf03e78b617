r"""Words of whole texts: A-Z in lower case, runs of characters outside ``[\x00-\x2F\x3A-\x60\x7B-\x7F]``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from obsframe.llm.common import text_of

#: Bytes of text whose words are looked at together.
TOGETHER = 8 << 20

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
# each byte of a word in lower case, a space for any other
FOLD = bytes(b if b in _WORD else 0x20 for b in _LOWER)


def folded(column: str = "text") -> Column:
    """The text in valid UTF-8, null as empty, ready for :func:`word_lists`."""
    return F.make_valid_utf8(text_of(column))


def fold(texts: pa.Array) -> pa.Array:
    """``texts`` with words in lower case and one space for every byte between them; offsets stay."""
    begin = texts.offset
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[begin : begin + len(texts) + 1]
    raw = texts.buffers()[2]
    data = memoryview(raw)[offsets[0] : offsets[-1]].tobytes().translate(FOLD) if raw is not None else b""
    shifted = pa.py_buffer((offsets - offsets[0]).astype(np.int32))
    return pa.StringArray.from_buffers(len(texts), shifted, pa.py_buffer(data))


def word_lists(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words end to end, dictionary-encoded, and the offsets of each text's words."""
    lists = pc.ascii_split_whitespace(fold(texts))
    flat = lists.flatten()
    present = pc.not_equal(flat, "")  # white space at an end leaves ""
    before = np.concatenate(([0], np.cumsum(present.to_numpy(zero_copy_only=False))))
    return flat.filter(present).dictionary_encode(), before[lists.offsets.to_numpy()]


def together(batch: pa.RecordBatch, column: str = "text", size: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each."""
    stops = np.cumsum(pc.binary_length(batch.column(column)).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        before = stops[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(stops, before + size, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def word_array(column: str = "text") -> Column:
    """The words of a text as an array, by Spark's functions alone."""
    lower = F.translate(text_of(column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
