"""Removal of word windows that occur more than once.

Difference-cover anchors: with a period p and a set D of residues whose
differences give every residue, any two equal stretches of w + p - 1 words
share an anchor, a stretch of w words that starts at a position of D modulo
p in both. So only the hashes at cover positions (5 of 21) are gathered over
the corpus; a window of 35 words has an aligned anchor of 15 words with each
of its twins. Around anchors that recur, windows are extended to their full
length and compared by 128-bit hashes of their word sequence: that decides.

Both questions are asked by ``sluice.llm.blocks``: sorted sets of hashes per
block of documents, one bit back per hash. Texts are shuffled once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm import blocks as B
from sluice.llm.common import text_buffer, window_hashes, word_hashes, word_spans

#: Fixed value: a perfect difference set modulo 21 (every residue but 0 is a difference exactly once).
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
_SECOND = 0xC2B2AE3D27D4EB4F | 1

OUTPUT = [
    T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())]))),
]


class _Block:
    """The words of a block's texts and their windows."""

    def __init__(self, column, window: int):
        self.window, self.anchor = window, window - PERIOD + 1
        self.raw, offsets = text_buffer(column)
        self.starts, self.ends, self.first = word_spans(self.raw, offsets)
        self.hash = word_hashes(self.raw, self.starts, self.ends)
        counts = np.diff(self.first)
        self.position = np.arange(len(self.starts)) - np.repeat(self.first[:-1], counts)
        self.left = np.repeat(self.first[1:], counts) - np.arange(len(self.starts))  # words from here to the end of the text

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors."""
        at = np.flatnonzero((self.left >= self.anchor) & np.isin(self.position % PERIOD, COVER))
        return at, window_hashes(self.hash, at, at + self.anchor)

    def candidates(self, recurs: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a recurring anchor at the right distance."""
        change = np.zeros(len(self.starts) + 1, np.int64)
        document = recurs - self.position[recurs]
        np.add.at(change, np.maximum(recurs - PERIOD + 1, document), 1)
        np.add.at(change, recurs + 1, -1)
        return np.flatnonzero((np.cumsum(change[:-1]) > 0) & (self.left >= self.window))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows at some starts, from independent hashes of their words."""
        second = word_hashes(self.raw, self.starts, self.ends, seed=1)
        return window_hashes(self.hash, at, at + self.window), window_hashes(second, at, at + self.window, _SECOND)


def _distinct(high: np.ndarray, low: np.ndarray | None = None):
    """Sorted distinct hashes, how often each occurs, and the place of every input in them."""
    if low is None:
        return (*np.unique(high, return_counts=True, return_inverse=True),)
    order = np.lexsort((low, high))
    new = np.ones(len(high), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    first = np.flatnonzero(new)
    inverse = np.empty(len(high), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return high[order][first], low[order][first], inverse, np.diff(np.append(first, len(high)))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with kept_text (words joined by one space), n_words, n_removed
    and removed (runs of removed words, end exclusive).

    Every word covered by a window of ``window`` words whose word sequence
    starts at another place too (same text included) is removed; windows are
    judged on the input. Null and empty texts have no words and an empty
    kept_text; texts shorter than a window keep all. Rows are texts of their
    own, whatever their ids. Input columns named like the new ones are replaced.
    """
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    docs = docs.drop(*[f.name for f in OUTPUT])
    n = B.count_blocks(docs, text_col)
    held = B.dealt(docs, n, id_col, text_col)
    names = docs.columns

    def ask_anchors(table):
        block = _Block(table.column(text_col), window)
        high, _, count = _distinct(block.anchors()[1])
        return B.ask(table.column("__block")[0].as_py(), n, high, None, count)

    def recurring(table, answer):
        """The block and the starts of its windows to be judged."""
        block = _Block(table.column(text_col), window)
        at, hashes = block.anchors()
        high, inverse, _ = _distinct(hashes)
        return block, at, high, inverse

    def ask_windows(table, answer):
        if not table.num_rows:
            return B.ask(0, n, np.zeros(0, np.uint64), None, np.zeros(0))
        block, at, high, inverse = recurring(table, answer)
        bits = B.answered(answer, n, high)
        a, b = block.windows(block.candidates(at[bits[inverse]]))
        a, b, _, count = _distinct(a, b)
        return B.ask(table.column("__block")[0].as_py(), n, a, b, count, keep=np.packbits(bits).tobytes())

    def remove(table, answer):
        block, at, high, inverse = recurring(table, answer)
        bits = np.unpackbits(np.frombuffer(B.kept(answer), np.uint8), count=len(high)).astype(bool)
        starts = block.candidates(at[bits[inverse]])
        a, b = block.windows(starts)
        a, b, inverse, _ = _distinct(a, b)
        repeated = starts[B.answered(answer, n, a)[inverse]]
        change = np.zeros(len(block.starts) + 1, np.int64)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + window, -1)
        keep = np.cumsum(change[:-1]) == 0
        texts, words, removed, runs = [], [], [], []
        for x, y in zip(block.first[:-1].tolist(), block.first[1:].tolist()):
            k = keep[x:y]
            s, e = block.starts[x:y][k].tolist(), block.ends[x:y][k].tolist()
            texts.append(b" ".join([block.raw[p:q].tobytes() for p, q in zip(s, e)]).decode())
            words.append(y - x)
            removed.append(y - x - len(s))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], ~k, [0]]))).reshape(-1, 2)
            runs.append([{"first_word": p, "end_word": q} for p, q in edge.tolist()])
        out = table.select(names)
        for f, values in zip(OUTPUT, (texts, words, removed, runs)):
            kind = {"kept_text": pa.string(), "removed": pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))}.get(f.name, pa.int64())
            out = out.append_column(f.name, pa.array(values, kind))
        return out

    by_block = held.groupBy("__block")
    first = B.answers(by_block.applyInArrow(ask_anchors, B.ASKED), 2)
    second = B.answers(by_block.cogroup(first.groupBy("__block")).applyInArrow(ask_windows, B.ASKED), 2)
    schema = T.StructType([*docs.schema.fields, *OUTPUT])
    return held.groupBy("__block").cogroup(second.groupBy("__block")).applyInArrow(remove, schema)
