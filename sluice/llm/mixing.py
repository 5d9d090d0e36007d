"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose rate is its target. Its documents queue in a
shuffled order, each with a virtual finish time: the words its source has
queued up to and with it, divided by the source's target. All copies are
range-sorted by that time over all sources, and the mix is cut where the
budget is spent. Targets sum to the budget, so that is virtual time 1: a
copy that finishes by then is taken whole, the one in service then is taken
in part, so each source's words are its target to the word.

Only DataFrame functions. Running sums are made in two steps, sums per bin
of the order and then sums within bins, so a source with a third of all rows
is many small groups, and a third step over sources or bins is a table of a
few columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import WORD_RE, materialise

#: Rows per bin of the shuffled order, and the least number of bins.
BIN_ROWS, BINS = 10_000, 1024


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, source_size, target from (source, source_size), one row per source.

    Sources take ``weights`` in turn by code point, null last. Targets share
    all words by weight; none is above ``most`` times its source's size, the
    excess goes to the others by weight. That is one level for all sources
    below their limit, found by sorting limits per weight: the first source
    whose limit is not below the level of what the ones before leave.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("limit"))
    by_ratio = Window.orderBy((F.col("limit") / F.col("weight")), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    s = s.select(
        "*", (F.sum("limit").over(by_ratio) - F.col("limit")).alias("full"),
        (F.sum("weight").over(every) - F.sum("weight").over(by_ratio) + F.col("weight")).alias("open"),
        F.sum("source_size").over(every).alias("total"))
    d = "decimal(38,0)"
    below = F.col("limit").cast(d) * F.col("open") >= (F.col("total") - F.col("full")).cast(d) * F.col("weight")
    s = s.select("*", below.alias("below"))
    s = s.select("*", F.min(F.when(F.col("below"), F.struct("full", "open"))).over(every).alias("level"))
    shared = (F.col("weight") * (F.col("total") - F.col("level.full"))).cast("double") / F.col("level.open").cast("double")
    capped = F.col("full") < F.col("level.full")
    return s.select("source", "source_size", F.when(capped, F.col("limit").cast("double")).otherwise(shared).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = "", keep_untaken: bool = False) -> DataFrame:
    """The mix: one row per copy taken, the columns of ``docs`` and

    size, source_size (words), target (double, of the source), copy (0 for
    the first), taken (words of this copy), virtual_finish, position (words
    of the mix before it) and row (names the input row). Sort by position for
    the order of the mix. ``keep_untaken`` keeps rows that have no copy, with
    null copy and taken 0.

    A null source is a source; null or empty texts and null ids are documents
    too, of size 0 or in the order of an empty id. Repeated rows are rows of
    their own; equal rows may stand for each other. An empty table gives
    none. Input columns named like the new ones are replaced. The order
    depends on ids, ``seed``, sizes and texts only, so reruns agree.
    """
    new = ("size", "source_size", "target", "copy", "taken", "virtual_finish", "position", "row")
    docs = docs.drop(*[c for c in new if c not in (id_col, text_col, source_col)])
    n = docs.count()
    bins = max(BINS, n // BIN_ROWS)
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    part = F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("double") * bins / 2.0**32).cast("int")
    base = docs.withColumns({"size": size_of(F.col(text_col)), "__key": key}).withColumn("__bin", part)

    # words before each bin of each source, and the source's target
    sums = materialise(base.groupBy(F.col(source_col).alias("source"), "__bin").agg(F.sum("size").alias("words")), "mix-sums")
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes, weights, most).withColumnRenamed("source", "__source")
    order = Window.partitionBy("source").orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = sums.select(F.col("source"), F.col("__bin").alias("__b"), (F.sum("words").over(order) - F.col("words")).alias("__before"))
    before = before.join(goal, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").withColumnRenamed("source", "__s")
    before = materialise(before, "mix-bins")

    rows = base.join(before, F.col(source_col).eqNullSafe(F.col("__s")) & (F.col("__bin") == F.col("__b")))
    queue = Window.partitionBy("__bin", source_col).orderBy("__key", "size", F.xxhash64(F.col(text_col)), F.col(id_col))
    running = queue.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({
        "__start": F.col("__before") + F.sum("size").over(running) - F.col("size"),
        "row": F.struct(F.col("__bin").alias("bin"), F.row_number().over(queue).alias("number"), F.col(source_col).alias("source")),
    })

    def copy(k: int) -> Column:
        start = F.col("__start") + F.lit(k) * F.col("source_size")
        taken = F.least(F.col("size"), F.floor("target") - start)
        return F.when(taken > 0, F.struct(
            F.lit(k).alias("copy"), taken.alias("taken"),
            ((start + F.col("size")).cast("double") / F.col("target")).alias("virtual_finish")))

    copies = F.filter(F.array(*[copy(k) for k in range(most)]), lambda c: c.isNotNull())
    rows = rows.withColumn("__copies", copies)
    rows = rows.withColumn("__copy", F.explode_outer("__copies") if keep_untaken else F.explode("__copies"))
    rows = rows.withColumns({
        "copy": F.col("__copy.copy"), "taken": F.coalesce(F.col("__copy.taken"), F.lit(0)).cast("long"), "virtual_finish": F.col("__copy.virtual_finish")})

    # The global order: as many words finish in any equal stretch of virtual time, so bins of it are even.
    # A copy cut at the end of the budget finishes with it.
    slot = F.coalesce(F.least(F.floor(F.col("virtual_finish") * bins), F.lit(bins)), F.lit(-1)).cast("int")
    rows = rows.withColumn("__slot", slot)
    spent = materialise(rows.groupBy("__slot").agg(F.sum("taken").alias("words")), "mix-slots")
    over = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spent = spent.select(F.col("__slot").alias("__p"), (F.sum("words").over(over) - F.col("words")).alias("__served"))
    order = Window.partitionBy("__slot", F.when(F.col("copy").isNull(), F.col("__bin"))).orderBy("virtual_finish", "__key", "copy", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(spent, F.col("__slot") == F.col("__p"))
    position = F.when(F.col("copy").isNotNull(), F.col("__served") + F.sum("taken").over(order) - F.col("taken"))
    return rows.withColumn("position", position).select(*docs.columns, *new)


def cut_text(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """``mixed`` with the text of a copy taken in part cut to the words taken."""
    words = F.slice(F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD_RE})")), F.lit(1), F.col("taken").cast("int"))
    return mixed.withColumn(text_col, F.when(F.col("taken") < F.col("size"), F.array_join(words, " ")).otherwise(F.col(text_col)))
