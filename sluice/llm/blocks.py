"""Asking, for blocks of documents, which of their hashes recur anywhere.

Documents are dealt into blocks of bounded size once. A block reduces its
hashes to a sorted set before anything leaves the task, so a passage that a
third of all documents share costs one entry per block, not one per
document. The sets meet in buckets by hash range; a bucket answers with one
bit per entry, in the order sent, and the block takes the bits up again. No
text and no position is shuffled for it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import giving_back_group, prepare

#: Bytes of text in a block; also bounds what one task holds.
BLOCK_BYTES = 4_000_000

ASKED = "__bucket int, __block long, __high binary, __low binary, __count binary, __order binary, __keep binary"
ANSWER = "__block long, __bucket int, __bits binary, __first binary, __keep binary"


def count_blocks(docs: DataFrame, text_col: str = "text") -> int:
    """Blocks for all bytes of text: one pass that reads only the texts."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, -(-size // BLOCK_BYTES))


def dealt(docs: DataFrame, blocks: int, id_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__block``, partitioned by it. Rows of one id are spread by
    their text as well, so a hot id is not a hot block."""
    prepare(docs.sparkSession)
    block = F.pmod(F.xxhash64(F.col(id_col), F.xxhash64(text_col), F.octet_length(text_col)), F.lit(blocks)).cast("long")
    return docs.withColumn("__block", block).repartition("__block")


def ask(block: int, buckets: int, high: np.ndarray, low: np.ndarray | None, count: np.ndarray, order: np.ndarray | None = None, keep: bytes | None = None) -> pa.Table:
    """The rows that send a block's distinct hashes (sorted by ``high``, then
    ``low``) with their counts and, if given, the least ``order`` of their
    documents; ``keep`` comes back with the answers as it is."""
    bucket = ((high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    names, first = np.unique(bucket, return_index=True)
    cuts = np.append(first, len(high))
    rows = [{
        "__bucket": int(names[i]), "__block": block, "__high": high[a:b].tobytes(), "__low": None if low is None else low[a:b].tobytes(),
        "__count": np.minimum(count[a:b], 2**31 - 1).astype(np.int32).tobytes(), "__order": None if order is None else order[a:b].astype(np.int64).tobytes(), "__keep": None,
    } for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    if keep is not None:
        rows.append({"__bucket": block % buckets, "__block": block, "__high": b"", "__low": None, "__count": b"", "__order": None, "__keep": keep})
    return pa.Table.from_pylist(rows, schema=pa.schema([
        ("__bucket", pa.int32()), ("__block", pa.int64()), ("__high", pa.binary()), ("__low", pa.binary()), ("__count", pa.binary()), ("__order", pa.binary()), ("__keep", pa.binary())]))


def answers(asked: DataFrame, least: int | tuple[int, int]) -> DataFrame:
    """For each row asked, a bit per hash: its counts over all blocks reach
    ``least`` (of a pair, the first for even and the second for odd hashes);
    and a second one: this block has the least order of all (the lowest block
    among equals)."""
    floor = np.broadcast_to(least, 2)

    def bucket(table):
        def joined(name, kind):
            return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist() if x is not None] or [np.zeros(0, kind)])

        sizes = [len(x) // 8 for x in table.column("__high").to_pylist()]
        a, b, order = joined("__high", np.uint64), joined("__low", np.uint64), joined("__order", np.int64)
        count = joined("__count", np.int32).astype(np.int64)
        bits, first = np.zeros(len(a), bool), np.zeros(len(a), bool)
        if len(a):
            keys = (b, a) if len(b) else (a,)
            if len(order):
                keys = (np.repeat(table.column("__block").to_numpy(), sizes), order, *keys)
            at = np.lexsort(keys)
            new = np.ones(len(a), bool)
            new[1:] = a[at][1:] != a[at][:-1]
            if len(b):
                new[1:] |= b[at][1:] != b[at][:-1]
            total = np.add.reduceat(count[at], np.flatnonzero(new))
            bits[at] = total[np.cumsum(new) - 1] >= floor[(a[at] & np.uint64(1)).astype(np.intp)]
            first[at] = new
        ends = np.cumsum(sizes)
        packed = [pa.array([np.packbits(x[e - n:e]).tobytes() for n, e in zip(sizes, ends)], pa.binary()) for x in (bits, first)]
        return pa.table({
            "__block": table.column("__block"), "__bucket": table.column("__bucket"),
            "__bits": packed[0], "__first": packed[1], "__keep": table.column("__keep")})

    return asked.groupBy("__bucket").applyInArrow(giving_back_group(bucket), ANSWER)


def answered(table: pa.Table, buckets: int, high: np.ndarray, column: str = "__bits") -> np.ndarray:
    """The bits of a block's hashes, in their order, from its answers."""
    bucket = ((high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    names, sizes = np.unique(bucket, return_counts=True)
    got = {k: x for k, x, keep in zip(table.column("__bucket").to_pylist(), table.column(column).to_pylist(), table.column("__keep").to_pylist()) if keep is None}
    parts = [np.unpackbits(np.frombuffer(got[int(k)], np.uint8), count=int(n)) for k, n in zip(names, sizes)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def kept(table: pa.Table) -> bytes | None:
    """What the block had sent along."""
    return next((x for x in table.column("__keep").to_pylist() if x is not None), None)
