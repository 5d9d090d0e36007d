"""CSV text as lines: which lines begin inside a quoted cell, by prefix sums.

Files are read by Spark's splittable text scan, so one file is many tasks. A
line maps the state it begins in (outside or inside a quoted cell) to the
state it ends in; that map needs the line alone. Lines without a quote keep
the state, so only lines with one matter. Per block of a file the maps are
composed for both states the block may begin in, and the few blocks of a file
are composed in order: from then on every line's state is known, and with it
the records, without any task reading a file whole.

Quotes follow Python's ``csv`` module: a quote opens a cell only where the
cell begins, a doubled one inside a quoted cell stands for itself, and
whatever follows the closing quote belongs to the cell up to the next comma.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_INSIDE = r'(?:[^"]++|"")*+'                      # of a quoted cell, up to a single quote or the end of the line
_CELLS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?,)*+'
_OPENS = rf'^{_CELLS}"{_INSIDE}\z'                 # a line that begins outside ends inside
_STAYS = rf'^{_INSIDE}(?:\z|"[^,]*+,{_CELLS}"{_INSIDE}\z)'  # a line that begins inside ends inside
_CELL = rf',("{_INSIDE}"?+[^,]*+|[^,]*+)'         # of a record with a comma before it

# A line of more bytes is not held in memory: its file counts as unreadable.
LONGEST_LINE = 128 << 20

# Lines of a task that are put in order together: 2 to the power of this.
PART_BITS = 13

LINES_SCHEMA = "file string, block long, line string, line_break string, n_bytes long, utf8 boolean"


def _pieces(value: Column) -> Column:
    """A line of text cut at carriage returns, which end lines too: (line, line_break)."""
    cut = F.split(value, "\r", -1)
    whole = F.array(F.struct(value.alias("line"), F.lit("\n").alias("line_break")))
    parts = F.transform(cut, lambda x, i: F.struct(
        x.alias("line"),
        F.when(i == F.size(cut) - 1, "\n").when((i == F.size(cut) - 2) & (F.element_at(cut, -1) == ""), "\r\n").otherwise("\r").alias("line_break")))
    parts = F.when(F.element_at(cut, -1) == "", F.slice(parts, 1, F.size(cut) - 1)).otherwise(parts)
    return F.when(F.instr(value, "\r") == 0, whole).otherwise(parts)


def _numbered(raw: DataFrame) -> DataFrame:
    """Lines with ``id``, which grows along a block (and by one within a task).
    Bytes are judged (n_bytes, utf8) before a text function sees them."""
    cut = raw.select("file", "block", "n_bytes", "utf8", F.posexplode(_pieces(F.col("value"))).alias("_i", "_piece"))
    return cut.select(
        "file", "block", F.col("_piece.line").alias("line"), F.col("_piece.line_break").alias("line_break"),
        F.when(F.col("_i") == 0, F.col("n_bytes")).otherwise(0).alias("n_bytes"), "utf8").withColumn("id", F.monotonically_increasing_id())


def file_lines(spark: SparkSession, paths: Sequence[str], keep_going: bool = False) -> DataFrame:
    """Every line of the files (file, block, line, line_break, n_bytes, utf8, id).

    ``keep_going``: a file that cannot be read, or not to its end, gives the
    lines before the failure instead of failing the job; the bytes of its
    lines then fall short of its length, which the caller checks. So do those
    of a file with a line of more than ``LONGEST_LINE`` bytes, which is left out.
    """
    if not paths:
        return spark.createDataFrame([], LINES_SCHEMA).withColumn("id", F.lit(0).cast("long"))
    skip = str(keep_going).lower()
    raw = (spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", skip).option("ignoreMissingFiles", skip)
           .option("mapreduce.input.linerecordreader.line.maxlength", str(LONGEST_LINE)).text(list(paths)))
    return _numbered(raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        (F.octet_length("value") + 1).cast("long").alias("n_bytes"), F.is_valid_utf8("value").alias("utf8")))


def text_lines(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """The same for texts in a column, each a file of one block named by ``key``."""
    parts = F.split(F.col(text_col), "\n", -1)
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    raw = texts.select(
        F.col(key).alias("file"), F.octet_length(text_col).alias("_size"), F.is_valid_utf8(text_col).alias("utf8"), F.posexplode(parts).alias("_i", "value"))
    return _numbered(raw.select(
        "file", F.lit(0).cast("long").alias("block"), "value", F.when(F.col("_i") == 0, F.col("_size")).otherwise(0).cast("long").alias("n_bytes"), "utf8"))


def _maps(line: Column) -> tuple[Column, Column]:
    """The state (1: inside) that a line ends in if it begins outside, and if it begins inside."""
    quoted = F.instr(line, '"') > 0
    return F.when(quoted & line.rlike(_OPENS), 1).otherwise(0), F.when(~quoted | line.rlike(_STAYS), 1).otherwise(0)


def blocks(lines: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """One row per block of a file (or per part of it, by columns ``within``
    that grow along it): n (lines), n_bytes, utf8, and for both
    states it may begin in: the state it ends in (end0, end1) and how many of
    its lines begin inside a cell (inside0, inside1). Of a file's first block
    also its first line and the number of the line where the first record ends.

    What is gathered per block is one number per line with a quote; a block is
    what one task reads (``spark.sql.files.maxPartitionBytes``).
    """
    begins_out, begins_in = _maps(F.col("line"))
    code = F.when(F.instr("line", '"') > 0, F.col("id") * 4 + begins_out * 2 + begins_in)
    per_block = lines.select("file", "block", "id", "n_bytes", "utf8", "line", code.alias("code"), *within).groupBy("file", "block", *within).agg(
        F.min("id").alias("_first"), F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes"),
        F.every("utf8").alias("utf8"), F.sort_array(F.collect_list("code")).alias("_codes"),
        F.min_by(F.when(F.col("block") == 0, F.col("line")), F.col("id")).alias("first_line"))

    zero, never = F.lit(0).cast("long"), F.lit(None).cast("long")
    start = F.struct(F.lit(-1).cast("long").alias("at"), F.lit(0).alias("end0"), F.lit(1).alias("end1"),
                     zero.alias("inside0"), zero.alias("inside1"), F.lit(False).alias("opened"), never.alias("closed"))

    def step(s: Column, code: Column) -> Column:
        at = F.shiftright(code, 2) - F.col("_first")
        lines_since = at - s["at"]
        begins_out, begins_in = F.shiftright(code, 1).bitwiseAND(F.lit(1).cast("long")).cast("int"), code.bitwiseAND(F.lit(1).cast("long")).cast("int")
        end0 = F.when(s["end0"] == 0, begins_out).otherwise(begins_in)
        return F.struct(
            at.alias("at"), end0.alias("end0"), F.when(s["end1"] == 0, begins_out).otherwise(begins_in).alias("end1"),
            (s["inside0"] + s["end0"] * lines_since).alias("inside0"), (s["inside1"] + s["end1"] * lines_since).alias("inside1"),
            (s["opened"] | ((at == 0) & (end0 == 1))).alias("opened"),
            F.coalesce(s["closed"], F.when(s["opened"] & (end0 == 0), at)).alias("closed"))

    def finish(s: Column) -> Column:
        rest = F.col("n") - 1 - s["at"]
        return F.struct(s["end0"].alias("end0"), s["end1"].alias("end1"), (s["inside0"] + s["end0"] * rest).alias("inside0"),
                        (s["inside1"] + s["end1"] * rest).alias("inside1"),
                        F.when(s["opened"], s["closed"]).otherwise(zero).alias("first_record_ends"))

    folded = per_block.withColumn("_s", F.aggregate("_codes", start, step, finish))
    return folded.select("file", "block", *within, "n", "n_bytes", "utf8", "first_line", "_s.*")


def _state_before(ends_if_out: Column, ends_if_in: Column, start: Column, window) -> tuple[Column, Column, Column]:
    """Columns to add one after the other that give the state before each row
    of a window: flips so far, the last row that settles the state, the state."""
    settles = ends_if_out == ends_if_in
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum(F.when(ends_if_out > ends_if_in, 1).otherwise(0)).over(before), F.lit(0))
    last = F.last(F.when(settles, F.struct(ends_if_out.alias("state"), F.col("_flips").alias("flips"))), ignorenulls=True).over(before)
    state = F.when(F.col("_last").isNotNull(), F.col("_last.state") + F.col("_flips") - F.col("_last.flips")).otherwise(start + F.col("_flips")) % 2
    return flips, last, state


def placed(per_block: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Blocks with the state they begin in (``begins_inside``) and the number
    of records that begin before them (``records_before``), by a window over
    the blocks of a file (its length over that of a block), or their parts
    as ``blocks`` gives them."""
    window = Window.partitionBy("file").orderBy("block", *within)
    flips, last, state = _state_before(F.col("end0"), F.col("end1"), F.lit(0), window)
    out = per_block.withColumn("_flips", flips).withColumn("_last", last).withColumn("begins_inside", state)
    inside = F.when(F.col("begins_inside") == 1, F.col("inside1")).otherwise(F.col("inside0"))
    out = out.withColumn("n_inside", inside)
    records = F.sum(F.col("n") - F.col("n_inside")).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("records_before", F.coalesce(records, F.lit(0))).drop("_flips", "_last")


def files(per_block: DataFrame) -> DataFrame:
    """One row per file: n_lines, n_bytes, utf8, records, multiline (a record
    spans lines), first_line and first_record_ends (null: not in the first block)."""
    return placed(per_block).groupBy("file").agg(
        F.sum("n").alias("n_lines"), F.sum("n_bytes").alias("n_bytes"), F.every("utf8").alias("utf8"),
        F.sum(F.col("n") - F.col("n_inside")).alias("records"), (F.sum("n_inside") > 0).alias("multiline"),
        F.max(F.when(F.col("block") == 0, F.col("first_line"))).alias("first_line"),
        F.max(F.when(F.col("block") == 0, F.col("first_record_ends"))).alias("first_record_ends"))


def first_records(lines: DataFrame, ends: DataFrame) -> DataFrame:
    """The first record of files where it spans lines (file, record).
    ``ends``: file and the number of the line of the first block where it ends."""
    first = lines.where("block = 0").join(F.broadcast(ends), "file")  # one row per file of this rare kind
    n = F.row_number().over(Window.partitionBy("file").orderBy("id")) - 1
    held = first.withColumn("_n", n).where(F.col("_n") <= F.col("first_record_ends"))
    return held.groupBy("file").agg(_joined(F.struct("_n", "line", "line_break")).alias("record"))


def _joined(piece: Column) -> Column:
    """An aggregate: the lines of a record in the order of ``piece``'s first fields, with the breaks between them."""
    pieces = F.array_sort(F.collect_list(piece))
    return F.aggregate(
        pieces, F.struct(F.lit("").alias("text"), F.lit("").alias("after")),
        lambda s, p: F.struct(F.concat(s["text"], s["after"], p["line"]).alias("text"), p["line_break"].alias("after")), lambda s: s["text"])


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The records of files after their first one (file, record, record_no),
    each one text, line breaks in cells included.

    The files are read twice: for the state every part of a block begins in
    (a small table, joined to the lines by file, block and part), then for the
    lines, which are put in order per part: blocks are few and large, and some
    would meet in one task. A record that spans parts or blocks is joined like
    any other, by its number in the file.
    """
    lines = file_lines(spark, paths).withColumn("part", F.shiftright("id", PART_BITS))  # ids are those of one listing's splits
    place = ["file", "block", "part"]
    begins = placed(blocks(lines, ["part"]), ["part"]).select(*place, "begins_inside", "records_before", F.col("n").alias("_n"))
    window = Window.partitionBy(*place).orderBy("id")
    begins_out, begins_in = _maps(F.col("line"))
    held = lines.join(begins, place, "left").withColumn("_out", begins_out).withColumn("_in", begins_in)
    flips, last, state = _state_before(F.col("_out"), F.col("_in"), F.col("begins_inside"), window)
    held = held.withColumn("_flips", flips).withColumn("_last", last).withColumn("_state", state)
    number = F.col("records_before") + F.sum(1 - F.col("_state")).over(window.rowsBetween(Window.unboundedPreceding, 0)) - 1
    # both reads must have cut the files alike (a cluster that grows meanwhile may not)
    alike = F.col("_n") == F.count("*").over(Window.partitionBy(*place))
    number = F.when(alike, number).otherwise(F.raise_error(F.lit("The files were split otherwise when they were read again.")).cast("long"))
    held = held.select("file", "block", "id", "line", "line_break", number.alias("record_no")).where("record_no > 0")
    return held.groupBy("file", "record_no").agg(_joined(F.struct("block", "id", "line", "line_break")).alias("record"))


def cells(record: Column) -> Column:
    """The cells of a record as text, unquoted; a blank record has none."""
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL), F.lit(1))
    quoted = rf'^"({_INSIDE})"?+([^,]*+)\z'

    def plain(cell: Column) -> Column:
        unquoted = F.concat(F.replace(F.regexp_extract(cell, quoted, 1), F.lit('""'), F.lit('"')), F.regexp_extract(cell, quoted, 2))
        return F.when(cell.startswith('"'), unquoted).otherwise(cell)

    return F.when(record == "", F.array().cast("array<string>")).otherwise(F.transform(found, plain))


def n_cells(record: Column) -> Column:
    """How many cells a record has: its commas outside quotes, and one."""
    outside = F.when(F.instr(record, '"') == 0, record).otherwise(F.regexp_replace(record, rf'(^|,)"{_INSIDE}"?+', "$1"))
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
