"""Byte-level BPE encoding and decoding.

Encoding cuts a text by the tokenizer's pattern and merges each match by
rank. Matches not seen before are merged together: they are put in matrices
by length (one row per match, one column per byte, padded), every row merges
its leftmost pair of least rank in each round, pair ranks come from a hash
table held in numpy arrays, the merged column is closed up, and rows without
a pair leave the matrix. Everything is map-only: no shuffle, memory bounded
by the longest text.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.chunks import PieceCodes, groups, simple_pieces
from sluice.llm.common import giving_back, prepare

_NONE = np.int32(2**31 - 1)
_WIDTHS = (2, 4, 6, 8, 12, 16, 24, 32, 64, 128)


def read_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: base64 of the token, a space, its rank."""
    return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in content.splitlines() if line)}


class PairTable:
    """(left id, right id) -> merged id, an open-addressing hash table in arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        size = 1 << int(4 * max(1, len(left)) - 1).bit_length()
        self._mask = np.int64(size - 1)
        self._keys = np.full(size, -1, np.int64)
        self._values = np.full(size, _NONE, np.int32)
        keys, values = self._key(left, right), merged.astype(np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] < 0
            self._keys[slot[free]] = keys[free]
            mine = self._keys[slot] == keys
            self._values[slot[mine]] = values[mine]
            keys, values, slot = keys[~mine], values[~mine], (slot[~mine] + 1) & self._mask

    @staticmethod
    def _key(left, right):
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys):
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(32)).astype(np.int64) & self._mask

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids (which are ranks), or the largest integer where a pair does not merge or holds padding."""
        keys = self._key(np.maximum(left, 0), np.maximum(right, 0))
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._values[slot], _NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self._mask
            found = self._keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self._values[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        out[(left < 0) | (right < 0)] = _NONE
        return out


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._pattern = regex.compile(pattern)
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, merged = (np.array(x, np.int32) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int32),) * 3
        self._pairs = PairTable(left, right, merged)
        self._matches: dict[str, bytes] = {}
        self._pieces = PieceCodes(self._encode_pieces, limit=80_000)
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        for t, r in ranks.items():
            lengths[r] = len(t)
        self._token_end = np.cumsum(lengths)
        self._token_length = lengths
        flat = np.zeros(int(self._token_end[-1]), np.uint8)
        for t, r in ranks.items():
            flat[self._token_end[r] - len(t):self._token_end[r]] = np.frombuffer(t, np.uint8)
        self._token_bytes = flat

    # ------------------------------------------------------------ encoding --

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        for i, j in groups(texts):
            pieces = [simple_pieces(t) for t in texts[i:j]]
            coded = self._pieces.code([p or [] for p in pieces])
            for text, p, c in zip(texts[i:j], pieces, coded):
                if p is None:
                    c = b"".join(self._codes_of(self._pattern.findall(text)))
                out.append(np.frombuffer(c, "<i4"))
        return out

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        matches = [self._pattern.findall(p) for p in pieces]
        codes = self._codes_of([m for ms in matches for m in ms])
        out, i = [], 0
        for ms in matches:
            out.append(b"".join(codes[i:i + len(ms)]))
            i += len(ms)
        return out

    def _codes_of(self, matches: list[str]) -> list[bytes]:
        known = self._matches
        if len(known) > 50_000:
            known = self._matches = {}
        new = list({m for m in matches if m not in known})
        codes = dict(zip(new, self._merge([m.encode() for m in new])))
        out = [codes[m] if m in codes else known[m] for m in matches]
        known.update((m, c) for m, c in codes.items() if len(m) <= 64)
        return out

    def _merge(self, matches: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(matches)
        lengths = np.array([len(m) for m in matches], np.int64)
        low = 0
        for width in _WIDTHS:
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            for k in range(0, len(rows), 8192):
                self._merge_rows(matches, rows[k:k + 8192], lengths, width, out)
            low = width
        for r in np.flatnonzero(lengths > low):
            out[r] = self._merge_long(matches[r])
        return out

    def _merge_rows(self, matches, rows, lengths, width, out) -> None:
        n = lengths[rows]
        raw = np.frombuffer(b"".join(matches[r] for r in rows), np.uint8)
        ids = np.full((len(rows), width), -1, np.int32)
        ids[np.arange(width) < n[:, None]] = self._byte[raw]
        ranks = self._pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            if done.any():
                flat, step = ids[done].astype("<i4").tobytes(), 4 * ids.shape[1]
                for k, (r, m) in enumerate(zip(rows[done].tolist(), n[done].tolist())):
                    out[r] = flat[k * step:k * step + 4 * m]
                go = ~done
                rows, n, ids, ranks, at, best = rows[go], n[go], ids[go], ranks[go], at[go], best[go]
            if not len(rows):
                return
            each = np.arange(len(rows))
            ids[each, at] = best
            shift = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, shift + (shift > at[:, None]), axis=1)
            n = n - 1
            if ids.shape[1] < 2:
                ranks = np.zeros((len(rows), 0), np.int32)
                continue
            shift = shift[:-1]
            ranks = np.take_along_axis(ranks, shift + (shift >= at[:, None]), axis=1)
            for k in (at - 1, at):  # the pairs that hold the merged token
                ok = (k >= 0) & (k < ids.shape[1] - 1)
                r, c = each[ok], k[ok]
                ranks[r, c] = self._pairs(ids[r, c], ids[r, c + 1])

    def _merge_long(self, match: bytes) -> bytes:
        """The same merges for one long match: a heap of pairs over a linked list, so the time stays near-linear."""
        ids = self._byte[np.frombuffer(match, np.uint8)]
        first = self._pairs(ids[:-1], ids[1:])
        tokens = ids.tolist()
        after = list(range(1, len(tokens) + 1))
        before = list(range(-1, len(tokens) - 1))
        heap = [(int(first[i]), i, tokens[i], tokens[i + 1]) for i in np.flatnonzero(first != _NONE).tolist()]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if tokens[i] == a else len(tokens)
            if j >= len(tokens) or tokens[j] != b:
                continue
            tokens[i], tokens[j] = rank, -1
            after[i] = after[j]
            if after[j] < len(tokens):
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(tokens):
                    pair = np.array([tokens[k]], np.int32), np.array([tokens[after[k]]], np.int32)
                    r = int(self._pairs(*pair)[0])
                    if r != _NONE:
                        heapq.heappush(heap, (r, k, tokens[k], tokens[after[k]]))
        return np.array([t for t in tokens if t >= 0], "<i4").tobytes()

    # ------------------------------------------------------------ decoding --

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a run of ids, and the end of each id's bytes in them."""
        lengths = self._token_length[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return np.zeros(0, np.uint8), ends
        source = np.repeat(self._token_end[ids] - ends, lengths) + np.arange(int(ends[-1]))
        return self._token_bytes[source], ends


_LOADED: dict[tuple, ByteBPE] = {}


def _bpe(ranks: bytes, pattern: str) -> ByteBPE:
    key = (hash(ranks), pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBPE(read_ranks(ranks), pattern)
    return _LOADED[key]


def _rank_file(spark, path: str):
    """The vocabulary's content for the executors: a fixed file of about a megabyte."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _bytes_of(bpe: ByteBPE, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The decoded bytes of consecutive lists of ids, as a binary column."""
    raw, ends = bpe.decode(flat.astype(np.int64))
    offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` array<int>, the codes of the whole text; with
    ``decoded`` also the bytes that these ids decode to, in the same pass.

    Null and empty texts have no ids. Repeated rows stay rows. Columns of
    these names in the input are replaced.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("ids", *["decoded"] * decoded)
    ranks = _rank_file(docs.sparkSession, ranks_path)
    names = docs.columns

    def run(batches):
        bpe = _bpe(ranks.value, pattern)
        for big in batches:
            for i in range(0, big.num_rows, 500):
                batch = big.slice(i, 500)
                texts = [t or "" for t in batch.column(names.index(text_col)).to_pylist()]
                ids = bpe.encode(texts)
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                columns = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))]
                if decoded:
                    columns.append(_bytes_of(bpe, flat, np.diff(ends)))
                yield pa.RecordBatch.from_arrays(columns, [*names, "ids", *["decoded"] * decoded])

    fields = [*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), *[T.StructField("decoded", T.BinaryType())] * decoded]
    return docs.mapInArrow(giving_back(run), T.StructType(fields))


def decode(coded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``coded`` with ``decoded`` binary, the bytes of its ids (none for null).

    A column named ``decoded`` in the input is replaced.
    """
    prepare(coded.sparkSession)
    coded = coded.drop("decoded")
    ranks = _rank_file(coded.sparkSession, ranks_path)
    names = coded.columns

    def run(batches):
        bpe = _bpe(ranks.value, pattern)
        for big in batches:
            for i in range(0, big.num_rows, 500):
                batch = big.slice(i, 500)
                lists = batch.column(names.index(ids_col))
                counts = np.array([n or 0 for n in pa.compute.list_value_length(lists).to_pylist()], np.int64)
                column = _bytes_of(bpe, lists.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, "decoded"])

    import pyarrow.compute  # noqa: F401  (pa.compute in the tasks)

    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return coded.mapInArrow(giving_back(run), schema)
