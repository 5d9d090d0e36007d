"""Shared pieces of the operators: scratch tables and vectorised words."""

from __future__ import annotations

import ctypes
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.plans.session import scratch_path
from sluice.plans.ship import ship_package

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD_RE = r"[^\x20\x09-\x0D]+"

_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Rolling hashes over the ring of 64-bit integers: an odd base has an inverse.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Everything an operator needs from the session before Python tasks run."""
    ship_package(spark)


def materialise(df: DataFrame, name: str, compression: str | None = None, partition: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: cuts lineage and survives lost executors. ``compression`` "none" is
    for values that are compressed already: codecs hold whole pages of large
    values outside the heap. ``partition`` names a column that becomes folders."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression, partitionBy=partition)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_of(col: str):
    """crc32 of a column's decimal text, unsigned."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of each row (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no rows
        column = pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the number of the first word of each row (one more entry than rows)."""
    if len(raw) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = _NOT_SPACE[raw]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    size = 1 << max(10, (n - 1).bit_length())
    key = (base, size)
    if key not in _POWERS:
        p = np.full(size, base, np.uint64)
        p[0] = 1
        p = np.cumprod(p, dtype=np.uint64)
        if size > 4 * _PIECE:  # very long texts: not kept
            return p[:n]
        _POWERS[key] = p
    return _POWERS[key][:n]


def window_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of values[start:end] for each pair, by prefix sums of a rolling hash."""
    n = len(values)
    inverse = _BASE_INV if base == _BASE else pow(base, -1, 1 << 64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * powers(inverse, n + 1)[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word's bytes, in pieces so that temporaries stay small.

    A word is cut into blocks of eight bytes; each is scrambled with its place
    and the seed before they are summed, so words of up to eight bytes never
    collide with one of their length, and no regular sequence of longer ones
    cancels out. Hashes of different seeds are independent.
    """
    out = np.empty(len(starts), np.uint64)
    salt = np.uint64((seed + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _PIECE, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        padded = np.zeros(hi - lo + 8, np.uint8)
        padded[:hi - lo] = raw[lo:hi]
        eight = np.ndarray((hi - lo + 1,), "<u8", padded, strides=(1,))
        begin, size = starts[i:j] - lo, ends[i:j] - starts[i:j]
        blocks = (size + 7) >> 3
        first = np.cumsum(blocks) - blocks
        nth = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        value = eight[np.repeat(begin, blocks) + 8 * nth].astype(np.uint64, copy=False)
        left = np.repeat(size, blocks) - 8 * nth
        short = left < 8
        value[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        nth = nth.astype(np.uint64)
        nth *= np.uint64(0x9E3779B97F4A7C15)
        nth += salt
        value = mix64(value ^ mix64(nth))
        out[i:j] = mix64(np.add.reduceat(value, first) + size.astype(np.uint64) * (salt | np.uint64(1)))
        i = j
    return out


def rows_in_batches(batches, size: int):
    """Split record batches into batches of at most ``size`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, size):
            yield b.slice(i, size)


def _trim() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def giving_back(run):
    """``run``, a function of record batches, with freed memory handed back after
    it: Python workers outlive their task, beside the next stage's."""
    @wraps(run)
    def wrapped(batches):
        yield from run(batches)
        _trim()
    return wrapped


def giving_back_group(run):
    """The same for a function of the table of a group, or of the tables of a cogroup."""
    if run.__code__.co_argcount == 2:
        def wrapped(left, right):
            out = run(left, right)
            _trim()
            return out
        return wrapped

    def wrapped(table):
        out = run(table)
        _trim()
        return out
    return wrapped
