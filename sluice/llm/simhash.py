"""SimHash near-duplicates by pivot distance tables.

A fingerprint has one bit per position that is set in over half of the
64-bit hashes of the document's shingles. Documents link when their
fingerprints differ in at most ``max_bits`` bits.

Candidates come from a table of Hamming distances to reference fingerprints
(pivots). A pair within ``max_bits`` cannot differ by more than that in any
coordinate. Random references alone cannot select: distances of unrelated
64-bit fingerprints concentrate at 32 +- 4, so each passes over half of all
pairs and finding the rest means comparing every pair of rows. The table
therefore has, besides random references, the structured ones: the zero
fingerprint and the 64 unit fingerprints. The difference of a unit
coordinate to the zero coordinate is +-1 and changes for exactly the bits in
which two fingerprints differ, so of ``max_bits + keyed`` groups of these
coordinates at least ``keyed`` agree wholly in any pair to be found. Rows
are dealt on every choice of ``keyed`` groups; only rows with equal
coordinates there meet, in blocks, are discarded by the largest coordinate
difference over all references, and survivors are verified on their bits.

Equal fingerprints are one row with a representative beforehand, so copies
cost nothing. A large meeting is cut into pieces of bounded size, and each
pair of pieces is compared in a task of its own: nothing is capped. A task
returns a spanning forest of its links (at most one link per row), never all
pairs of a dense group. Links, distances and components stay distributed.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import giving_back, materialise, prepare, text_buffer, word_spans
from sluice.llm.components import Forest, components

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --------------------------------------------------------------- fingerprints --

def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(column, shingle: int, seed: int) -> np.ndarray:
    raw, offsets = text_buffer(column)
    raw = _LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    digest = xxhash.xxh64_intdigest
    for d in range(len(out)):
        a, b = int(first[d]), int(first[d + 1])
        if a == b:
            continue
        s, e = starts[a:b], ends[a:b]
        gap = s[1:] - e[:-1]
        base = int(s[0])
        if (gap == 1).all():
            text = raw[s[0]:e[-1]].copy()
            text[e[:-1] - base] = 32
            text, s, e = text.tobytes(), s - base, e - base
        else:
            text = b" ".join(raw[x:y].tobytes() for x, y in zip(s.tolist(), e.tolist()))
            e = np.cumsum(e - s + 1) - 1
            s = np.concatenate([[0], e[:-1] + 1])
        k = min(shingle, b - a)
        cuts = zip(s[:len(s) - k + 1].tolist(), e[k - 1:].tolist())
        hashes = np.fromiter((digest(text[x:y], seed) for x, y in cuts), np.uint64, len(s) - k + 1)
        out[d] = _majority(hashes)
    return out


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with ``fingerprint`` (long, the 64 bits). A-Z are lower-cased;
    a text of fewer words than a shingle is one shingle; null, empty or
    blank texts have fingerprint zero. A column of that name is replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop("fingerprint")
    names = docs.columns

    def run(batches):
        for big in batches:
            for i in range(0, big.num_rows, 500):
                batch = big.slice(i, 500)
                bits = _fingerprints(batch.column(names.index(text_col)), shingle, seed)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits.view(np.int64))], [*names, "fingerprint"])

    return docs.mapInArrow(giving_back(run), T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.LongType())]))


# ------------------------------------------------------------------- the join --

def pivots(random_references: int = 16, seed: int = 7) -> np.ndarray:
    """Reference fingerprints: zero, the 64 unit ones, and some random ones."""
    units = np.uint64(1) << np.arange(64, dtype=np.uint64)
    rng = np.random.default_rng(seed).integers(0, 2**64, random_references, dtype=np.uint64)
    return np.concatenate([[np.uint64(0)], units, rng])


def distance_table(bits: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint (row) to every reference (column)."""
    return np.bitwise_count(bits[:, None] ^ references[None, :]).astype(np.int8)


def _keys(table: np.ndarray, max_bits: int, keyed: int) -> np.ndarray:
    """For every row, one hash per choice of ``keyed`` of ``max_bits + keyed``
    groups of unit coordinates: equal hashes mean equal coordinates there."""
    side = (table[:, 1:65] < table[:, :1]).astype(np.uint64)  # nearer to the unit reference than to zero
    n = max_bits + keyed
    group = np.arange(64) * n // 64
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    parts = [(side[:, group == g] * weights[group == g]).sum(axis=1, dtype=np.uint64) for g in range(n)]
    out = []
    for i, chosen in enumerate(itertools.combinations(range(n), keyed)):
        key = np.full(len(table), i * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for g in chosen:
            key = key ^ parts[g]
        key = key * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
        out.append(key * np.uint64(0x94D049BB133111EB))
    return np.stack(out, axis=1)


def _forest(left: np.ndarray, right: np.ndarray, same: bool, max_bits: int, references: np.ndarray) -> np.ndarray:
    """Links of a spanning forest of the pairs (one of each side) within
    ``max_bits``, compared in blocks; ``same``: both sides are one set."""
    nodes = left if same else np.concatenate([left, right])
    tl, tr = distance_table(left, references[65:]), distance_table(right, references[65:])
    forest = Forest(len(nodes))
    shift = 0 if same else len(left)
    for a in range(0, len(left), 256):
        for b in range(a if same else 0, len(right), 4096):
            x, y = left[a:a + 256], right[b:b + 4096]
            near = np.ones((len(x), len(y)), bool)
            for c in range(tl.shape[1]):  # the largest coordinate difference
                near &= np.abs(tl[a:a + 256, c, None] - tr[None, b:b + 4096, c]) <= max_bits
                if c == 3 and near.sum() * 4 < near.size:
                    break
            i, j = np.nonzero(near)
            keep = np.abs(tl[a + i] - tr[b + j]).max(axis=1, initial=0) <= max_bits if tl.shape[1] else np.ones(len(i), bool)
            i, j = i[keep], j[keep]
            ok = np.bitwise_count(x[i] ^ y[j]) <= max_bits
            forest.link(a + i[ok], b + j[ok] + shift)
    at = np.array(forest.links, np.int64).reshape(-1, 2)
    return nodes[at]


def links_within(prints: DataFrame, max_bits: int = 4, keyed: int = 2, piece: int = 4096) -> DataFrame:
    """Links (u, v) that connect whatever fingerprints of the column
    ``fingerprint`` are within ``max_bits`` by chains, without the redundant
    links inside a task. ``keyed`` trades copies of rows for selectivity: 2 of
    6 groups (15 copies, 21 bits) suits up to some 10**8 different
    fingerprints, 4 of 8 (70 copies, 32 bits) more; the result is the same.
    """
    spark = prints.sparkSession
    prepare(spark)
    references = pivots()
    distinct = prints.select("fingerprint").distinct()

    def keys(batches):
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(bits), 50_000):
                part = bits[i:i + 50_000]
                table = _keys(distance_table(part, references[:65]), max_bits, keyed)
                yield pa.RecordBatch.from_arrays([
                    pa.array(table.ravel().view(np.int64)), pa.array(np.repeat(part, table.shape[1]).view(np.int64))], ["key", "fingerprint"])

    met = materialise(distinct.mapInArrow(giving_back(keys), "key long, fingerprint long"), "pivot-keys")
    sizes = met.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    met = met.join(sizes, "key")
    # pieces of a large meeting: every pair of pieces has a task
    met = met.withColumn("pieces", F.ceil(F.col("size") / piece).cast("int"))
    met = met.withColumn("mine", F.pmod(F.xxhash64("fingerprint"), F.col("pieces")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    met = met.select("key", "fingerprint", F.least("mine", "with").alias("low"), F.greatest("mine", "with").alias("high"), "mine")

    def compare(table):
        bits = table.column("fingerprint").to_numpy().view(np.uint64)
        mine = table.column("mine").to_numpy()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        order = np.argsort(bits)
        bits, mine = bits[order], mine[order]
        same = low == high
        found = _forest(bits[mine == low], bits[mine == high], same, max_bits, references)
        return pa.table({"u": found[:, 0].copy().view(np.int64), "v": found[:, 1].copy().view(np.int64)})

    return met.groupBy("key", "low", "high").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (long) and component_id, one row per row of ``docs``.

    component_id is the least id reachable by links, itself included. Null
    ids are kept and count as larger than any other. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialise(fingerprints(rows, "text", shingle).select("doc_id", "fingerprint"), "fingerprints")
    linked = components(links_within(rows, max_bits))
    # one row per fingerprint: its component's least document
    least = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    named = least.join(linked, least["fingerprint"] == linked["node"], "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    named = materialise(named, "fingerprint-components")
    ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = named.join(ids, "component").select(F.col("fingerprint").alias("_f"), "component_id")
    by_print = materialise(by_print, "component-ids")
    return rows.join(by_print, F.col("fingerprint") == F.col("_f")).select("doc_id", "fingerprint", "component_id")
