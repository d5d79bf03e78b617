"""Token counts under a unigram vocabulary, by forward scores over a trie of the distinct pre-tokens.

A pre-token is cut into the pieces whose scores add up to the most (of equal sums, into the fewest pieces). The
best score of a prefix depends on the prefix alone, so pre-tokens that share a beginning share the work: the
distinct pre-tokens of a batch are walked as a trie, in sorted order, each new node scored once from its
ancestors, and the number of tokens at a pre-token's last node is kept.

Characters that no piece covers count as one token for each of their UTF-8 bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.llm.common import table, text_of

#: Pre-tokens that a Python worker remembers between batches.
REMEMBERED = 1_000_000
#: Bytes of text whose pre-tokens are looked at together.
TOGETHER = 16 << 20
#: Log score of one byte of a character that no piece covers: worse than any piece.
BYTE_SCORE = -20.0
#: What stands for the white space before a pre-token in the vocabulary file.
SPACE = chr(0x2581)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> dict[str, float]:
    """Piece to log score. The file orders pieces by frequency without giving it, so a piece of rank r gets
    the log of Zipf's 1 / (r + 2), normalised; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (r + 2) for r in range(len(usable))))
    return {model.id_to_piece(i): -math.log(r + 2) - total for r, i in enumerate(usable)}


class TrieCounter:
    """Numbers of tokens of pre-tokens, prefixes scored once per call."""

    def __init__(self, vocabulary: dict[str, float]):
        self.scores = vocabulary
        # a piece is looked up only where some piece of its length ends with that character
        self.lengths: dict[str, list[int]] = {}
        for piece in sorted(vocabulary, key=len):
            ends = self.lengths.setdefault(piece[-1:], [])
            if len(piece) not in ends:
                ends.append(len(piece))
        self.nodes = 0

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each of ``words``, which are sorted and distinct."""
        best, tokens, out = [0.0], [0], []
        previous = ""
        find, lengths = self.scores.get, self.lengths
        for word in words:
            depth = _shared(previous, word)
            del best[depth + 1 :], tokens[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):  # nodes that no earlier word has reached
                last = word[end - 1]
                size = 1 if last < "\x80" else len(last.encode("utf-8", "replace"))
                top, fewest = best[end - 1] + BYTE_SCORE * size, tokens[end - 1] + size
                for n in lengths.get(last, ()):
                    if n > end:
                        break
                    score = find(word[end - n : end])
                    if score is not None:
                        score += best[end - n]
                        count = tokens[end - n] + 1
                        if score > top or (score == top and count < fewest):
                            top, fewest = score, count
                best.append(top)
                tokens.append(fewest)
            self.nodes += len(word) - depth
            out.append(tokens[-1])
            previous = word
        return out


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Counter:
    """Token counts of texts; numbers of pre-tokens are remembered between batches."""

    def __init__(self, path: str):
        self.trie = TrieCounter(read_vocabulary(path))
        self.known: dict[str, int] = {}

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of each text."""
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten()
        present = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # white space at an end leaves ""
        coded = words.dictionary_encode()
        listed = coded.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = sorted(SPACE + w for w in listed if w not in self.known)
        self.known.update(zip([w[1:] for w in new], self.trie.counts(new)))
        tokens = np.fromiter((self.known[w] if w else 0 for w in listed), np.int64, len(listed))
        offsets = lists.offsets.to_numpy()
        sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[offsets])
        return sums(present), sums(tokens[coded.indices.to_numpy()])


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens for each row of ``docs`` (doc_id, text).

    Pre-tokens are the stretches between ASCII white space, each with one mark of white space before it. Null
    text counts as empty and has none; repeated rows stay repeated; an empty table gives no rows. Other columns
    are ignored.
    """
    path = vocabulary or default_vocabulary()

    def run(batches):
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
            begin = 0
            while begin < batch.num_rows:
                before = sizes[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, before + TOGETHER, side="right")))
                some = batch.slice(begin, end - begin)
                words, tokens = counter(path).count(some.column("text"))
                columns = [some.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_tokens"])
                begin = end

    kept = docs.select("doc_id", F.make_valid_utf8(text_of()).alias("text"))
    shape = [kept.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens")]]
    return kept.mapInArrow(run, T.StructType(shape))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
