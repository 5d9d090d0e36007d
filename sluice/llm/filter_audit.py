"""What five text filters do in every order they can be applied in.

Each document has a mask of the filters it fails. A mask settles what happens
to the document in all 600 steps (120 orders of five filters): kept, removed,
redundant and so on. So every mask, with its labels, is one big integer whose
fields hold all those outcomes; the integers of a part are summed and the
fields read off. Fields are as wide as the number of documents of the part
needs, so no sum runs into the next field.

Texts never leave the stage that reads them: masks, ids and a digest of the
text do. Documents are counted by (part, mask, labels) before any sum, so at
most 128 integers are added per part, each times the documents that share it.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import WORD_RE, materialise, prepare

FILTERS = "ABCDE"
ORDERS = ["".join(o) for o in permutations(FILTERS)]
#: Counts of a step, in the order of their fields.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_GOOD, _TOXIC = 1 << 5, 1 << 6

OUTPUT = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in (*COUNTS, "shapley")]])


def failures(text: Column, words: Column) -> Column:
    """The mask of filters A to D that a text fails (bit 0 for A): under 50
    words; under 65 % of the words distinct; over 5 % of the code points A-Z;
    any of ``#$%&*|``."""
    fails = [
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)).cast("long") < 65 * F.size(words).cast("long"),
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 5 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum(F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails))


def _steps(mask: int, good: bool, toxic: bool):
    """The outcomes of a document in every order and step, as (field, holds)."""
    for o, order in enumerate(ORDERS):
        gone = False
        for s, name in enumerate(order):
            fails = bool(mask >> FILTERS.index(name) & 1)
            removed = fails and not gone
            redundant = fails and gone
            gone = gone or fails
            outcome = (not gone, removed, redundant, mask == 1 << FILTERS.index(name), removed and good, removed and toxic)
            for c, holds in enumerate(outcome):
                yield (o * len(FILTERS) + s) * len(COUNTS) + c, holds


@lru_cache(maxsize=None)
def packed(kind: int, width: int) -> int:
    """The integer of a mask with its labels: one field of ``width`` bits per step and count."""
    held = bytearray(len(ORDERS) * len(FILTERS) * len(COUNTS) * width // 8 + 1)
    for field, holds in _steps(kind & 31, bool(kind & _GOOD), bool(kind & _TOXIC)):
        if holds:
            held[field * width >> 3] |= 1 << (field * width & 7)
    return int.from_bytes(held, "little")


def unpack(total: int, width: int) -> list[int]:
    """The fields of a sum of packed integers."""
    raw = total.to_bytes(len(ORDERS) * len(FILTERS) * len(COUNTS) * width // 8 + 1, "little")
    size = width // 8
    return [int.from_bytes(raw[i * size:(i + 1) * size], "little") for i in range(len(ORDERS) * len(FILTERS) * len(COUNTS))]


def _outcomes(kinds: dict[int, int]) -> dict[str, list]:
    """The columns of one part from its documents by kind."""
    width = -(-max(1, sum(kinds.values()).bit_length()) // 8) * 8  # whole bytes that hold the number of documents
    fields = unpack(sum(n * packed(kind, width) for kind, n in kinds.items()), width)
    columns: dict[str, list] = {c: fields[i::len(COUNTS)] for i, c in enumerate(COUNTS)}
    shares = dict.fromkeys(FILTERS, 0)
    steps = [(order, s + 1, name) for order in ORDERS for s, name in enumerate(order)]
    for (_, _, name), removed in zip(steps, columns["removed"]):
        shares[name] += removed
    columns["filter_order"] = [order for order, _, _ in steps]
    columns["step"] = [s for _, s, _ in steps]
    columns["shapley"] = [shares[name] for _, _, name in steps]
    return columns


def _report(batches):
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                        *[(c, pa.int64()) for c in (*COUNTS, "shapley")]])
    for b in batches:
        for part, kinds in zip(b.column("part").to_pylist(), b.column("kinds").to_pylist()):
            columns = _outcomes({k["kind"]: k["n"] for k in kinds})
            columns["part"] = [part] * len(columns["step"])
            yield pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in schema}, schema)


def kinds(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Documents (n) per part and kind: the mask of failed filters, with the labels."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("t"))
    rows = rows.select("id", "part", "t", F.regexp_extract_all("t", F.lit(f"({WORD_RE})"), F.lit(1)).alias("words"))
    rows = rows.select("id", "part", failures(F.col("t"), F.col("words")).alias("mask"), F.unhex(F.sha2("t", 256)).alias("digest"))
    # Repeated rows are one from here on, with their number.
    rows = materialise(rows.groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("n")), "filter-masks")

    given = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, _GOOD).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, _TOXIC).otherwise(0)).alias("toxic"))
    known = rows.where("id IS NOT NULL").join(given, "id", "left").select(
        "id", "part", "digest", "n", (F.col("mask") + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))).alias("kind"))
    known = materialise(known, "filter-kinds")

    # E fails for all documents of a text but those of its smallest id. So all are counted as failing it, and
    # the first ones then moved: no document is joined to the other copies, and a text is one row per part and kind.
    copy = 1 << FILTERS.index("E")
    least = known.groupBy("digest", "part", "kind").agg(F.min(F.struct("id", "n")).alias("least")).select("digest", "part", "kind", "least.*")
    first = least.groupBy("digest").agg(F.min("id").alias("first"))
    first = least.join(first, "digest").where(F.col("id") == F.col("first"))
    counted = [
        known.select("part", (F.col("kind") + copy).alias("kind"), "n"),
        first.select("part", (F.col("kind") + copy).alias("kind"), (-F.col("n")).alias("n")),
        first.select("part", "kind", "n"),
        rows.where("id IS NULL").select("part", F.col("mask").alias("kind"), "n"),  # no id: no labels, and of no text's ids
    ]
    union = counted[0]
    for c in counted[1:]:
        union = union.unionByName(c)
    return union.groupBy("part", "kind").agg(F.sum("n").alias("n")).where("n > 0")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part (value of ``part_col``, null: empty string), order of
    the five filters and step, with the counts of ``COUNTS`` and shapley
    (documents that the step's filter removes, over all orders of the part).

    Filters A to D look at the text (``failures``; null is empty), E fails for
    a text that a smaller id has anywhere in the table. A document with a null
    id fails no E, makes no other a copy and has no labels; rows that repeat an
    id count each, and are no copies of each other. Labels that repeat an id
    hold if any row says so; labels of ids that no document has are not
    counted. An empty table gives no rows; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    by_part = kinds(docs, labels, id_col, text_col, part_col).groupBy("part").agg(
        F.collect_list(F.struct("kind", "n")).alias("kinds"))  # at most 32 masks times 4 labels
    return by_part.mapInArrow(_report, OUTPUT)
