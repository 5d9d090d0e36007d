"""Token ids as directly addressable codes.

``write_tokens`` encodes every document and stores the ids of all documents,
in ascending id order, as a table of shards. A shard holds the ids of a run
of documents cut into byte-sized chunks: level 0 has the lowest byte of every
id, level 1 the next byte of the ids that have one, and so on. Each level has
a bitmap that tells which of its chunks continue on the next level and a rank
directory (ones before every 512th bit), so the chunk of a continuing id on
the next level is found by counting ones: any token is read on its own with
no block to decode.

The shards are rows of a Parquet table, so a write is committed by Spark as a
whole and any store that Spark reaches will do. One range shuffle of the
texts orders the documents; positions come from sums per partition.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.chunks import TextCodes, groups, single_spaced
from sluice.llm.common import prepare, rows_in_batches

RANK_STEP = 512
_LEVEL = T.StructType([T.StructField(n, T.BinaryType()) for n in ("chunks", "more", "ranks")])
SHARD_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("before", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("doc_ends", T.ArrayType(T.LongType())),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("levels", T.ArrayType(_LEVEL)),
])


# ----------------------------------------------------------------- the codes --

def pack(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of a run of unsigned ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_STEP)) if len(more) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]) if len(ones) else ones
        levels.append({
            "chunks": (rest & 255).astype(np.uint8).tobytes(),
            "more": np.packbits(more, bitorder="little").tobytes(),
            "ranks": ranks.astype("<u4").tobytes(),
        })
        if not more.any():
            return levels
        rest = rest[more] >> 8


def unpack(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a shard."""
    out = np.zeros(0, np.uint32)
    for level in reversed(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(chunks), bitorder="little").astype(bool)
        chunks[more] |= out << 8
        out = chunks
    return out


def access(levels: list[dict[str, bytes]], at: np.ndarray) -> np.ndarray:
    """The ids at some positions of a shard, without decoding anything else."""
    out = np.zeros(len(at), np.uint32)
    live, at = np.arange(len(at)), np.asarray(at, np.int64)
    for k, level in enumerate(levels):
        chunks, bits = np.frombuffer(level["chunks"], np.uint8), np.frombuffer(level["more"], np.uint8)
        out[live] |= chunks[at].astype(np.uint32) << np.uint32(8 * k)
        go = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        live, at = live[go], at[go]
        if not len(live):
            return out
        # rank: ones before the position = directory entry + ones of the bytes between + ones of the last byte
        step = RANK_STEP // 8
        ranks = np.frombuffer(level["ranks"], "<u4").astype(np.int64)
        padded = np.concatenate([bits, np.zeros(step, np.uint8)])
        line = padded[(at // RANK_STEP * step)[:, None] + np.arange(step)]
        inside = (at % RANK_STEP)[:, None] - np.arange(step) * 8
        mask = np.where(inside >= 8, 255, np.where(inside > 0, (1 << np.clip(inside, 0, 7)) - 1, 0)).astype(np.uint8)
        at = ranks[at // RANK_STEP] + np.bitwise_count(line & mask).sum(axis=1, dtype=np.int64)
    return out


# -------------------------------------------------------------------- writing --

_LOADED: dict[int, tuple] = {}


def _tokenizer(content: bytes):
    """The tokenizer and its codes of texts, once per worker."""
    key = hash(content)
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_buffer(content)
        added = tuple(t.content for t in tok.get_added_tokens_decoder().values())
        lengths = np.zeros(tok.get_vocab_size(), np.int64)  # bytes of each token: its characters stand for one byte each
        for token, i in tok.get_vocab().items():
            lengths[i] = len(token)

        def whole(texts: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<i4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

        _LOADED.clear()
        _LOADED[key] = whole, TextCodes(whole, lengths), added
    return _LOADED[key]


def _encode_texts(texts: list[str], content: bytes) -> list[np.ndarray]:
    """The ids of each text as the library gives them; texts that hold the
    string of an added token are left to it whole, as it codes that string by itself."""
    whole, codes, added = _tokenizer(content)
    out = []
    for i, j in groups(texts, 4_000_000):  # the more at once, the fewer distinct pieces to look up
        simple = [single_spaced(t) and not any(a in t for a in added) for t in texts[i:j]]
        found = iter(codes.code([t for t, s in zip(texts[i:j], simple) if s]))
        out += [next(found) if s else np.frombuffer(whole([t])[0], "<i4") for t, s in zip(texts[i:j], simple)]
    return out


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 1 << 20) -> None:
    """Encode every document with the tokenizer, append ``end_id`` and write all ids in ascending id order.

    Null texts are empty documents (only ``end_id``), null ids come first,
    repeated rows are documents of their own in no particular order among
    equal (id, text). Other columns are ignored. An empty table writes no
    shard. A document is never split: a shard has at most ``shard_tokens``
    tokens or a single document.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer_path, "rb") as f:  # a fixed vocabulary of about a megabyte
        content = spark.sparkContext.broadcast(f.read())

    def run(batches):
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        names, ids, held = [], [], 0

        def shard():
            nonlocal names, ids, held, seq, before
            flat = np.concatenate(ids).astype(np.uint32)
            row = {
                "part": part, "seq": seq, "before": before, "doc_ids": names, "doc_ends": np.cumsum([len(x) for x in ids]).tolist(),
                "n_tokens": len(flat), "levels": pack(flat),
            }
            names, ids, held, seq, before = [], [], 0, seq + 1, before + len(flat)
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in rows_in_batches(batches, 2000):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for name, codes in zip(batch.column(0).to_pylist(), _encode_texts(texts, content.value)):
                if ids and held + len(codes) + 1 > shard_tokens:
                    yield shard()
                names.append(name)
                ids.append(np.append(codes, end_id))
                held += len(codes) + 1
        if ids:
            yield shard()

    level = pa.struct([(n, pa.binary()) for n in ("chunks", "more", "ranks")])
    arrow = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("levels", pa.list_(level))])
    (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange("id", F.xxhash64("text"))
        .sortWithinPartitions("id")
        .mapInArrow(run, SHARD_SCHEMA)
        .write.parquet(path)
    )


# -------------------------------------------------------------------- reading --

def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the number of ids before them: what the
    writer's partition had before them, and the sums of earlier partitions (one
    row for each partition of the writer, so small enough to broadcast; the
    shards themselves are not shuffled)."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    earlier = sums.select("part", (F.sum("_sum").over(Window.orderBy("part")) - F.col("_sum")).alias("_earlier"))
    return shards.join(F.broadcast(earlier), "part").withColumn("start", F.col("_earlier") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ``ids_le``,
    the ids as little-endian unsigned 32-bit integers, one row per document
    written."""
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_le", T.BinaryType())])
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_le", pa.binary())])

    def run(batches):
        for batch in rows_in_batches(batches, 1):
            row = batch.to_pylist()[0]
            raw = unpack(row["levels"]).astype("<u4")
            ends = np.array(row["doc_ends"], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"]), pa.array(ends - starts),
                pa.array([raw[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ], schema=arrow)

    return _placed(spark, path).select("start", "doc_ids", "doc_ends", "levels").mapInArrow(run, schema)


def read_tokens_at(spark: SparkSession, path: str, positions: DataFrame, pos_col: str = "pos", slot: int = 1 << 20) -> DataFrame:
    """pos, token for each distinct position of the whole run of ids; positions
    outside it (or null) have no row. Positions meet shards on the slots of
    ``slot`` ids that a shard covers; only their chunks are read."""
    prepare(spark)
    placed = _placed(spark, path)
    index = placed.select("part", "seq", "start", (F.col("start") + F.col("n_tokens")).alias("end"))
    index = index.select("*", F.explode(F.sequence(F.expr(f"start div {slot}"), F.expr(f"(end - 1) div {slot}"))).alias("slot"))
    wanted = positions.select(F.col(pos_col).cast("long").alias("pos")).distinct().withColumn("slot", F.expr(f"pos div {slot}"))
    hits = wanted.join(index, "slot").where("pos >= start AND pos < end")
    hits = hits.groupBy("part", "seq").agg(F.collect_list("pos").alias("pos"))
    schema = T.StructType([T.StructField("pos", T.LongType()), T.StructField("token", T.LongType())])

    def run(batches):
        for batch in rows_in_batches(batches, 1):
            row = batch.to_pylist()[0]
            pos = np.array(row["pos"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pos), pa.array(access(row["levels"], pos - row["start"]).astype(np.int64))], ["pos", "token"])

    return placed.join(hits, ["part", "seq"]).select("start", "pos", "levels").mapInArrow(run, schema)
