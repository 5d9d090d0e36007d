"""Line dedup by a fixed-depth tree of line templates.

A line goes down the tree by its number of words and its leading words; a
word with a digit is a variable field. In the leaf it reaches, a further
word is constant if at least ``min_docs`` documents have it at its place in
that leaf, else it is a variable field too: that is the line's template. A
template is recurring if at least ``min_docs`` documents have it, and names
something if at least one word is constant and a share of ``similarity`` of
the words after the leading ones (fields with digits aside) is. Lines of
recurring templates are dropped; the first document (least id) keeps the
first of them, so no content leaves the corpus altogether.

What is constant takes many documents to tell, but a line that stands again
word for word (words with digits included) has nothing variable: it recurs
from ``min_copies`` documents on, whatever its template, and is dropped by
the same rule.

Leaves, constants and templates are counted by ``sluice.llm.blocks``: a
block reduces them to sorted sets of hashes with document counts, so a line
that every document has costs one entry per block. The three questions go
one after the other, each narrowing the next, and whole lines are asked with
the leaves; texts are shuffled once and nothing depends on the order of
lines or documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import blocks as B
from sluice.llm.common import giving_back_group, mix64, text_buffer, word_hashes, word_spans

_FIELD = np.uint64(0x5851F42D4C957F2D)
_ODD = np.uint64(1)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

OUTPUT = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]


def _salt(n: np.ndarray) -> np.ndarray:
    return mix64(n.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def _per_document(keys: np.ndarray, docs: np.ndarray, order: np.ndarray):
    """Sorted distinct keys, in how many documents each is, the least order of
    its documents, and each input's place among the keys."""
    high, inverse = np.unique(keys, return_inverse=True)
    at = np.lexsort((docs, inverse))
    new = np.ones(len(at), bool)
    new[1:] = (inverse[at][1:] != inverse[at][:-1]) | (docs[at][1:] != docs[at][:-1])
    count = np.bincount(inverse[at][new], minlength=len(high))
    least = np.full(len(high), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, order[docs])
    return high, inverse, count, least


def _surplus(inverse: np.ndarray, rows: np.ndarray, order: np.ndarray, least: np.ndarray, recurs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The lines with recurring keys but for the one of each that stays: in the
    block with the least id, the first line of the first row with that id."""
    gone = recurs[inverse]
    own = np.flatnonzero(gone & first[inverse] & (order[rows] == least[inverse]))
    gone[own[np.unique(inverse[own], return_index=True)[1]]] = False
    return gone


class _Block:
    """The lines of a block's texts."""

    def __init__(self, table: pa.Table, text_col: str, depth: int):
        self.raw, offsets = text_buffer(table.column(text_col))
        self.order = table.column("__order").to_numpy()
        starts, ends, _ = word_spans(self.raw, offsets)
        breaks = np.flatnonzero(self.raw == 10) + 1
        # the first byte of every line; the lines of a row are those between its offsets
        nth = np.searchsorted(breaks, offsets[:-1], "right")
        after = np.searchsorted(breaks, offsets[1:], "right")  # breaks up to the end of a row belong to it
        self.row_lines = after - nth + 1
        self.line_start = np.insert(breaks, nth, offsets[:-1])
        self.line_row = np.repeat(np.arange(len(offsets) - 1), self.row_lines)
        stop = offsets[1:][self.line_row]
        self.line_end = np.append(self.line_start[1:] - 1, len(self.raw))
        last = np.cumsum(self.row_lines) - 1
        self.line_end[last] = stop[last]
        self.first_word = np.searchsorted(starts, self.line_start)
        self.words = np.searchsorted(starts, self.line_end) - self.first_word
        self.line_of = np.repeat(np.arange(len(self.words)), self.words)
        self.place = np.arange(len(starts)) - self.first_word[self.line_of]
        digits = np.concatenate([[0], np.cumsum(_DIGIT[self.raw], dtype=np.int32)])
        self.field = digits[ends] > digits[starts]
        hashes = word_hashes(self.raw, starts, ends)
        self.hash = np.where(self.field, _FIELD, hashes)
        self.depth = depth
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ _salt(self.place)), dtype=np.uint64)])
        self.whole = mix64(_salt(self.words) ^ (sums[self.first_word + self.words] - sums[self.first_word]))
        leaf = _salt(self.words)
        for k in range(depth):
            has = np.flatnonzero(self.words > k)
            leaf[has] = mix64(leaf[has] ^ (self.hash[self.first_word[has] + k] + np.uint64(k)))
        self.leaf = leaf
        self.filled = np.flatnonzero(self.words > 0)

    def leaves(self):
        """The leaves (odd keys) and whole lines (even keys) of the lines with words, one after the other."""
        keys = np.concatenate([self.leaf[self.filled] | _ODD, self.whole[self.filled] & ~_ODD])
        return _per_document(keys, np.tile(self.line_row[self.filled], 2), self.order)

    def narrowed(self, bits: np.ndarray, inverse: np.ndarray) -> None:
        """Go on with the lines of frequent leaves only."""
        self.lines = self.filled[bits[inverse[:len(self.filled)]]]
        hot = np.zeros(len(self.words), bool)
        hot[self.lines] = True
        self.inner = np.flatnonzero(hot[self.line_of] & (self.place >= self.depth) & ~self.field)

    def constants(self):
        w = self.inner
        key = mix64(self.leaf[self.line_of[w]] ^ _salt(self.place[w]) ^ (self.hash[w] * np.uint64(0x9E3779B97F4A7C15)))
        return _per_document(key, self.line_row[self.line_of[w]], self.order)

    def templates(self, bits: np.ndarray, inverse: np.ndarray, similarity: float):
        """The lines whose template names something, and their templates."""
        constant = np.zeros(len(self.hash), bool)
        constant[self.inner[bits[inverse]]] = True
        lead = self.place < self.depth
        token = np.where(constant | lead, self.hash, _FIELD)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(token ^ _salt(self.place)), dtype=np.uint64)])
        a = self.first_word[self.lines]
        b = a + self.words[self.lines]

        def per_line(flag):
            total = np.concatenate([[0], np.cumsum(flag)])
            return total[b] - total[a]

        inner = np.zeros(len(self.hash), bool)
        inner[self.inner] = True
        named = per_line(constant) >= similarity * per_line(inner)
        named &= per_line(constant | (lead & ~self.field)) > 0
        lines = self.lines[named]
        key = mix64(self.leaf[lines] ^ (sums[b] - sums[a])[named])
        return lines, *_per_document(key, self.line_row[lines], self.order)


def _pack(*flags: np.ndarray) -> bytes:
    return b"".join(len(f).to_bytes(8, "little") + np.packbits(f).tobytes() for f in flags)


def _unpack(raw: bytes) -> list[np.ndarray]:
    out = []
    while raw:
        n = int.from_bytes(raw[:8], "little")
        size = 8 + -(-n // 8)
        out.append(np.unpackbits(np.frombuffer(raw[8:size], np.uint8), count=n).astype(bool))
        raw = raw[size:]
    return out


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, depth: int = 2, similarity: float = 0.7, min_copies: int = 2) -> DataFrame:
    """``docs`` with the recurring lines gone from the text, and n_lines, n_dropped.

    Lines end at line feeds and are kept byte for byte. Lines without words
    are never dropped. Null texts stay null, with no lines; an empty text is
    one line without words. Rows are documents of their own, whatever their
    ids; null ids come last for "first", ids that are not integers are
    ordered by hash. Input columns named like the new ones are replaced.
    """
    docs = docs.drop(*[f.name for f in OUTPUT])
    n = B.count_blocks(docs, text_col)
    kind = docs.schema[id_col].dataType
    order = F.col(id_col).cast("long") if isinstance(kind, T.IntegralType) else F.xxhash64(id_col)
    held = B.dealt(docs.withColumn("__order", F.coalesce(order, F.lit(2**63 - 1))), n, id_col, text_col)
    names = docs.columns

    def ask_leaves(table):
        high, _, count, least = _Block(table, text_col, depth).leaves()
        return B.ask(table.column("__block")[0].as_py(), n, high, None, count, order=least)

    def ask_constants(table, answer):
        block = _Block(table, text_col, depth)
        high, inverse, _, _ = block.leaves()
        hot, early = B.answered(answer, n, high), B.answered(answer, n, high, "__first")
        block.narrowed(hot, inverse)
        high, _, count, _ = block.constants()
        return B.ask(table.column("__block")[0].as_py(), n, high, None, count, keep=_pack(hot, early))

    def ask_templates(table, answer):
        block = _Block(table, text_col, depth)
        hot, early = _unpack(B.kept(answer))
        block.narrowed(hot, block.leaves()[1])
        high, inverse, _, _ = block.constants()
        constant = B.answered(answer, n, high)
        _, high, _, count, least = block.templates(constant, inverse, similarity)
        return B.ask(table.column("__block")[0].as_py(), n, high, None, count, order=least, keep=_pack(hot, early, constant))

    def drop(table, answer):
        block = _Block(table, text_col, depth)
        hot, early, constant = _unpack(B.kept(answer))
        _, keys, _, earliest = block.leaves()
        block.narrowed(hot, keys)
        copies = _surplus(keys[len(block.filled):], block.line_row[block.filled], block.order, earliest, hot, early)
        lines, high, inverse, _, least = block.templates(constant, block.constants()[1], similarity)
        recurs, first = B.answered(answer, n, high), B.answered(answer, n, high, "__first")
        # the line of a template that stays is also the one that stays of its copies
        keep = np.ones(len(block.words), bool)
        keep[lines[_surplus(inverse, block.line_row[lines], block.order, least, recurs, first)]] = False
        keep[block.filled[copies]] = False
        last = np.cumsum(block.row_lines)
        texts, dropped = [], []
        raw, start, end = block.raw.tobytes(), block.line_start.tolist(), block.line_end.tolist()
        for a, b in zip((last - block.row_lines).tolist(), last.tolist()):
            k = keep[a:b]
            dropped.append(int(b - a - k.sum()))
            texts.append((raw[start[a]:end[b - 1]] if k.all() else b"\n".join(raw[start[i]:end[i]] for i in range(a, b) if keep[i])).decode())
        null = np.array(table.column(text_col).is_null().to_pylist(), bool)
        text = pa.array([None if z else t for z, t in zip(null, texts)], table.schema.field(text_col).type)
        out = table.select(names).set_column(names.index(text_col), text_col, text)
        return out.append_column("n_lines", pa.array(np.where(null, 0, block.row_lines))).append_column("n_dropped", pa.array(dropped, pa.int64()))

    def cogrouped(left, right, fn, schema):
        def guarded(table, answer):  # a block always has documents; an empty side is an empty result
            return fn(table, answer) if table.num_rows else pa.table({})
        return left.groupBy("__block").cogroup(right.groupBy("__block")).applyInArrow(giving_back_group(guarded), schema)

    leaves = B.answers(held.groupBy("__block").applyInArrow(giving_back_group(ask_leaves), B.ASKED), (min_copies, min_docs))
    constants = B.answers(cogrouped(held, leaves, ask_constants, B.ASKED), min_docs)
    templates = B.answers(cogrouped(held, constants, ask_templates, B.ASKED), min_docs)
    return cogrouped(held, templates, drop, T.StructType([*docs.schema.fields, *OUTPUT]))
