"""Product codes of vectors: sixteen parts, each coded by its nearest codebook entry.

Components are integers, so every distance, sum and tie is exact. The nearest
entry of a part is found by slicing and intersecting: per coordinate the
entries are sorted and every prefix of that order is a 64-bit mask. A radius
selects a range of the order, hence a mask (two prefixes, exclusive or); the
masks of all coordinates ANDed are the entries in the box around the part. If
the best of them lies within the radius, no entry outside the box is as near;
otherwise the radius grows to that distance (or doubles) and the part is
asked again.

The codebooks hold at most 16 * 64 entries whatever the data, so they are
what the driver knows; each round is one pass over the vectors that returns
sums per entry.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.sizing import bounded_broadcast
from sluice.llm.common import giving_back, materialise, prepare, rows_in_batches

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_LONGEST = 2**63 - 1
_ROWS = 4096
_DECIMAL = T.DecimalType(38, 0)
_LIMB = 10**15

OUTPUT = [
    T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
    T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType()),
]


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` has one row of integers per entry; parts are ``width`` wide."""

    entries: list[np.ndarray]
    dimension: int

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def sha256(self) -> str:
        """Digest of all components' decimals by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(str(x) for part in self.entries for x in part.ravel().tolist()).encode()).hexdigest()


class PartIndex:
    """The prefix masks of one part's codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.all = np.uint64((1 << len(entries)) - 1)
        self.sorted, self.prefixes = [], []
        for column in entries.T:
            order = sorted(range(len(entries)), key=column.__getitem__)
            masks = [0]
            for i in order:
                masks.append(masks[-1] | 1 << i)
            self.sorted.append(column[order])
            self.prefixes.append(np.array(masks, np.uint64))
        #: The middle distance of the entries from their nearest other one.
        apart = [min((int(((a - b) ** 2).sum()) for j, b in enumerate(entries) if j != i), default=0) for i, a in enumerate(entries)]
        self.radius = max(1, _root(sorted(apart)[len(apart) // 2]))

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries that differ by at most ``radius`` in every coordinate."""
        masks = np.full(len(points), self.all)
        for x, column, prefix in zip(points.T, self.sorted, self.prefixes):
            masks &= prefix[np.searchsorted(column, x + radius, "right")] ^ prefix[np.searchsorted(column, x - radius, "left")]
        return masks

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry (ties to the lower index)."""
        index, distance = np.zeros(len(points), np.int64), np.zeros(len(points), points.dtype)
        todo = np.arange(len(points))
        radius = np.full(len(points), self.radius, points.dtype)
        while len(todo):
            masks = self.box(points[todo], radius[todo])
            bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            apart = ((points[todo[row]] - self.entries[entry]) ** 2).sum(axis=1)
            # distance and index in one number: its least value is the nearest entry of least index
            first = np.flatnonzero(np.diff(row, prepend=-1))
            least = np.minimum.reduceat(apart * len(self.entries) + entry, first) if len(row) else apart
            rows = row[first]
            found = np.zeros(len(todo), bool)
            best, which = least // len(self.entries), (least % len(self.entries)).astype(np.int64)
            sure = (best <= radius[todo[rows]] ** 2) | (masks[rows] == self.all)
            found[rows[sure]] = True
            index[todo[rows[sure]]], distance[todo[rows[sure]]] = which[sure], best[sure]
            radius[todo] *= 2
            unsure = todo[rows[~sure]]
            radius[unsure] = _roots(best[~sure])
            todo = todo[~found]
        return index, distance


def _root(square: int) -> int:
    """The least integer whose square is at least ``square``."""
    r = math.isqrt(square)
    return r + (r * r < square)


def _roots(squares: np.ndarray) -> np.ndarray:
    """An integer for each square whose own square is at least that."""
    if squares.dtype == object:
        return np.array([_root(x) for x in squares], object)
    return np.ceil(np.sqrt(squares.astype(np.float64))).astype(np.int64) + 1


def _fits(largest: int, width: int) -> bool:
    """Whether distances of components up to ``largest`` (and the index beside them) fit 64 bits."""
    return 4 * (largest + 1) ** 2 * width * ENTRIES < _LONGEST // 8


def integers(column: pa.ListArray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(256 x) of the vectors of ``dimension`` finite components, and which rows those are.

    Machine integers while squared distances fit 64 bits, else Python's.
    """
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    flat = pc.list_flatten(column)
    values = np.asarray(flat.cast(pa.float64()).fill_null(float("nan")))
    usable = lengths == dimension
    ends = np.cumsum(np.maximum(lengths, 0))
    rows = np.flatnonzero(usable)
    at = (ends[rows] - dimension)[:, None] + np.arange(dimension)
    vectors = values[at] if dimension else np.zeros((len(rows), 0))
    finite = np.isfinite(vectors).all(axis=1)
    usable[rows[~finite]] = False
    scaled = np.floor(vectors[finite] * SCALE) if np.abs(vectors[finite]).max(initial=0) < 2.0**900 else vectors[finite]
    width = -(-dimension // PARTS)
    if _fits(int(np.abs(scaled).max(initial=0)), max(width, 1)):
        whole = scaled.astype(np.int64)
    else:
        whole = np.array([[_floor(x) for x in v] for v in vectors[finite].tolist()], object).reshape(len(scaled), dimension)
    if width * PARTS != dimension:  # equal parts: zeros fill the last ones
        whole = np.concatenate([whole, np.zeros((len(whole), width * PARTS - dimension), whole.dtype)], axis=1)
    return whole, usable


def _floor(x: float) -> int:
    n, d = x.as_integer_ratio()
    return n * SCALE // d


def _finite(vector):
    """Whether a vector column is there and all its components are numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def start(vectors: DataFrame, id_col: str, vector_col: str) -> Codebooks | None:
    """Codebooks of the first vectors by id (equal ids: by components); None without any."""
    usable = vectors.where(_finite(F.col(vector_col))).select(id_col, F.col(vector_col).cast("array<double>").alias("v"))
    first = usable.orderBy(F.col(id_col).asc_nulls_last(), "v").limit(ENTRIES).collect()
    if not first:
        return None
    dimension = len(first[0]["v"])
    whole, _ = integers(pa.array([r["v"] for r in first if len(r["v"]) == dimension], pa.list_(pa.float64())), dimension)
    return Codebooks(np.split(whole, PARTS, axis=1), dimension)


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both of one kind of integer."""
    if a.dtype == b.dtype and _fits(max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0))), a.shape[1] or 1):
        return a, b
    return a.astype(object), b.astype(object)


def _assigned(books: Codebooks):
    """A function of vectors' integers: (indexes by part, distances by part)."""
    indexes = {}

    def assign(whole: np.ndarray):
        codes, apart = [], []
        for p, points in enumerate(np.split(whole, PARTS, axis=1)):
            points, entries = _common(points, books.entries[p])
            key = p, entries.dtype
            if key not in indexes:
                indexes[key] = PartIndex(entries)
            i, d = indexes[key].nearest(points)
            codes.append(i)
            apart.append(d)
        return np.stack(codes, axis=1), np.stack(apart, axis=1)
    return assign


def _limbs(x: int) -> list[int]:
    """``x`` by powers of ``_LIMB``, lowest first, all of its sign."""
    sign, x, out = (-1 if x < 0 else 1), abs(int(x)), []
    while x or not out:
        x, low = divmod(x, _LIMB)
        out.append(sign * low)
    return out


def improve(vectors: DataFrame, books: Codebooks, vector_col: str) -> Codebooks:
    """One round: every part to its nearest entry, every entry to the floored mean of its parts."""
    width = books.width

    def sums(batches):
        assign = _assigned(books)
        size = PARTS * ENTRIES
        total, count = np.zeros((size, width), object), np.zeros(size, np.int64)
        for b in rows_in_batches(batches, _ROWS):
            whole, _ = integers(b.column(0), books.dimension)
            if not len(whole):
                continue
            codes, _ = assign(whole)
            for p, points in enumerate(np.split(whole, PARTS, axis=1)):
                at = p * ENTRIES + codes[:, p]
                count += np.bincount(at, minlength=size)
                # of one batch: fits the kind of integer of the batch (distances do)
                part = np.zeros((size, width), points.dtype)
                np.add.at(part, at, points)
                total += part
        rows = [(e, p, limb, digits, n if limb == 0 else 0)
                for e, n in zip(np.flatnonzero(count).tolist(), count[count > 0].tolist())
                for p in range(width) for limb, digits in enumerate(_limbs(total[e, p]))]
        columns = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["entry", "position", "limb", "total", "n"])

    parts = vectors.select(vector_col).mapInArrow(giving_back(sums), "entry long, position long, limb long, total long, n long")
    # a few rows for each of 16 * 64 entries and positions of a part, whatever the data
    summed = parts.groupBy("entry", "position", "limb").agg(F.sum(F.col("total").cast(_DECIMAL)).alias("total"), F.sum("n").alias("n"))
    sums_of: dict[tuple[int, int], list[int]] = {}
    for r in summed.collect():
        s = sums_of.setdefault((r["entry"], r["position"]), [0, 0])
        s[0] += int(r["total"]) * _LIMB ** r["limb"]
        s[1] += r["n"]
    entries = [e.copy() for e in books.entries]
    for (at, position), (total, n) in sums_of.items():
        part, entry = divmod(at, ENTRIES)
        mean = total // n
        if entries[part].dtype != object and not _fits(abs(mean), max(width, 1)):
            entries[part] = entries[part].astype(object)
        entries[part][entry, position] = mean
    return Codebooks(entries, books.dimension)


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all vectors; None without any usable vector."""
    prepare(vectors.sparkSession)
    books = start(vectors, id_col, vector_col)
    for _ in range(rounds if books else 0):
        books = improve(vectors, books, vector_col)
    return books


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding") -> DataFrame:
    """``vectors`` that are usable, with code (bytes: an index per part) and error (squared distances summed)."""
    prepare(vectors.sparkSession)
    vectors = vectors.drop("code", "error")
    names = vectors.columns
    place = names.index(vector_col)

    def run(batches):
        assign = _assigned(books)
        for b in rows_in_batches(batches, _ROWS):
            whole, usable = integers(b.column(place), books.dimension)
            if not len(whole):
                continue
            codes, apart = assign(whole)
            error = [min(int(x), _LONGEST) for x in apart.astype(object).sum(axis=1)]
            kept = b.filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()), pa.array(error, pa.int64())],
                [*names, "code", "error"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    return vectors.mapInArrow(giving_back(run), schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS) -> DataFrame:
    """Vectors as codes of ``PARTS`` parts, by codebooks trained on all of them.

    Adds code (two hex digits per part), error, label_error (errors summed
    over equal labels, nulls together) and codebooks_sha256; the vector column
    is left out. Rows whose vector is null or has null or non-finite
    components are left out. A usable vector of another length than that of
    the first id is left out too, as no codebook fits it. Lengths that sixteen
    does not divide are filled with zeros, empty vectors have code 0 and error
    0; fewer than 64 usable rows give fewer entries. Rows may repeat, ids may
    be null (last in order); sums beyond 64 bits are held at the largest long.
    Input columns named like the new ones are replaced. Empty tables give no
    rows.
    """
    clash = [c for c in vectors.columns if c in [f.name for f in OUTPUT]]
    vectors = vectors.drop(*clash)
    books = train(vectors, id_col, vector_col, rounds)
    kept = [f for f in vectors.schema.fields if f.name != vector_col]
    if books is None:
        return vectors.sparkSession.createDataFrame([], T.StructType([*kept, *OUTPUT]))
    coded = encode(vectors, books, vector_col).drop(vector_col).withColumn("code", F.lower(F.hex("code")))
    coded = materialise(coded, "vector-codes")
    by_label = coded.groupBy(F.col(label_col).alias("__label")).agg(
        F.least(F.sum(F.col("error").cast(_DECIMAL)), F.lit(_LONGEST).cast(_DECIMAL)).cast("long").alias("label_error"))
    out = coded.join(bounded_broadcast(by_label), F.col(label_col).eqNullSafe(F.col("__label")), "left")
    return out.select(*[f.name for f in kept], "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
