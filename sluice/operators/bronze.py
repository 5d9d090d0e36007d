"""Bronze load: corrupt-row gate, lineage, idempotent publish, outcomes.

Set-based: all validated uploads of a run are scanned together in one plan,
however many headers they have: cells are read by position and named by a
small table of headers. The per-upload counts come from one aggregation, and
the publish is a dynamic partition overwrite on ``upload_id`` that replaces
exactly the uploads being loaded (a retry never doubles rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import status as S
from sluice.functions.columns import cap_message
from sluice.functions.sizing import bounded_broadcast

# Fixed value: strictly more than this share of unparseable rows rejects.
MAX_CORRUPT_ROW_RATIO = 0.05


def _pct(ratio: Column) -> Column:
    """Ratio as percent text with one decimal, ties to even ("12.5%")."""
    return F.format_string("%.1f%%", F.bround(ratio * 100, 1))


def gate(counts: DataFrame, uploads: DataFrame | None = None,
         limit: float = MAX_CORRUPT_ROW_RATIO) -> DataFrame:
    """Accept or reject each upload from its row counts.

    ``counts``: upload_id, row_count, corrupt_row_count. ``uploads`` (optional)
    lists every upload that was scanned, so one that produced no rows at all
    is rejected instead of silently missing.
    """
    if uploads is not None:
        counts = uploads.select("upload_id").distinct().join(counts, "upload_id", "left")
    total = F.coalesce(F.col("row_count"), F.lit(0)).cast("long")
    corrupt = F.coalesce(F.col("corrupt_row_count"), F.lit(0)).cast("long")
    ratio = corrupt / total
    reject_msg = (
        F.when(total == 0, F.lit("The file produced no rows when read."))
        .when(
            ratio > limit,
            F.concat(
                corrupt.cast("string"), F.lit(" of "), total.cast("string"), F.lit(" rows ("), _pct(ratio),
                F.lit(f") could not be parsed, which exceeds the {limit:.0%} limit. "
                      "Check the file's delimiter and encoding."),
            ),
        )
    )
    return counts.select(
        "upload_id",
        total.alias("row_count"),
        corrupt.alias("corrupt_row_count"),
        reject_msg.isNull().alias("accepted"),
        reject_msg.alias("message"),
    )


def outcome(gated: DataFrame, bronze_table: Column | str, now: Column,
            source_counts: DataFrame | None = None) -> DataFrame:
    """Manifest update of the bronze stage per upload.

    PROCESSED: "Loaded N rows into T." (+ unparsed-row note, + a note when
    the validation row count differs - a warning, never a failure), counts,
    completion time. BRONZE_REJECTED: the gate message and zero counts.
    """
    df = gated
    if source_counts is not None:
        df = df.join(source_counts.select("upload_id", "source_row_count"), "upload_id", "left")
    else:
        df = df.withColumn("source_row_count", F.lit(None).cast("long"))
    table = F.lit(bronze_table) if isinstance(bronze_table, str) else bronze_table
    ok = F.col("accepted")
    n = F.col("row_count")
    c = F.col("corrupt_row_count")
    src = F.col("source_row_count")
    loaded = F.concat_ws(
        " ",
        F.concat(F.lit("Loaded "), n.cast("string"), F.lit(" rows into "), table, F.lit(".")),
        F.when(c > 0, F.concat(c.cast("string"), F.lit(" rows could not be parsed."))),
        F.when(src.isNotNull() & (src != n), F.concat(
            F.lit("Note: validation counted "), src.cast("string"),
            F.lit(" rows but bronze wrote "), n.cast("string"), F.lit("."))),
    )
    return df.select(
        "upload_id",
        F.when(ok, F.lit(S.PROCESSED)).otherwise(F.lit(S.BRONZE_REJECTED)).alias("status"),
        cap_message(F.when(ok, loaded).otherwise(F.col("message"))).alias("validation_message"),
        F.when(ok, n).otherwise(F.lit(0)).cast("long").alias("bronze_row_count"),
        F.when(ok, c).otherwise(F.lit(0)).cast("long").alias("bronze_corrupt_row_count"),
        F.when(ok, now).alias("bronze_processed_at"),
        "source_row_count",
    )


def attach_lineage(scanned: DataFrame, files: DataFrame, ingested_at: Column,
                   path_col: str = "_file_path") -> DataFrame:
    """Add upload_id, source_file_name and ingested_at to scanned rows.

    ``files`` maps the reader's ``_metadata.file_path`` (percent-encoded, taken
    from the same reader on both sides) to the upload. It holds one row per
    file of the run (bounded by the number of uploads, never by their size),
    so it is broadcast after a size check. Lineage wins over columns of the
    file with the same names (in any case). Further columns of ``files`` are
    carried along.
    """
    lineage = ("file_path", "upload_id", "source_file_name")
    more = [c for c in files.columns if c not in lineage]
    held = files.select(*[F.col(c).alias(f"__lineage_{c}") for c in lineage], *more)
    joined = scanned.join(bounded_broadcast(held), F.col(path_col) == F.col("__lineage_file_path"), "inner")
    taken = {path_col.lower(), "upload_id", "source_file_name", "ingested_at"}
    return joined.select(
        *[c for c in scanned.columns if c.lower() not in taken],
        *more,
        F.col("__lineage_upload_id").alias("upload_id"),
        F.col("__lineage_source_file_name").alias("source_file_name"),
        ingested_at.alias("ingested_at"),
    )


def publish(df: DataFrame, path: str, partition_col: str = "upload_id") -> None:
    """Idempotent append: dynamic partition overwrite of exactly the uploads
    present in ``df`` (a re-run replaces, never duplicates).

    ``rebalance`` on the partition column lets AQE write few files per
    upload (small uploads are packed, a hot upload is split across tasks)
    instead of one file per task and upload."""
    (
        df.hint("rebalance", partition_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def union_shapes(frames: Sequence[DataFrame]) -> DataFrame:
    """Union differently shaped (all-string) bronze batches by name; a column
    one batch lacks is NULL there - the effect of a schema-merging append."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def scan_uploads(spark: SparkSession, files: DataFrame, ingested_at: Column) -> DataFrame:
    """Bronze rows of many uploads in one plan, whatever their headers.

    Records are read as text, cut into cells by position, and named by the
    header of their file: the headers are a small table, joined by broadcast,
    that says where each column stands in the file. A record whose number of
    cells is not that of its header keeps its text in ``_corrupt_record``.

    ``files``: upload_id, stored_file_path (to read), file_path (reader's
    encoded form, to join), source_file_name, header, optional multiline -
    a materialised (written) frame. Paths and headers reach the driver:
    metadata bounded by the number of uploads, never their rows.
    """
    from sluice.sources import csv_files as CSV
    from sluice.sources import lines as LN

    if "multiline" not in files.columns:
        files = files.withColumn("multiline", F.lit(True))
    listed = files.select("stored_file_path", "header", F.coalesce("multiline", F.lit(True)).alias("multiline")).collect()
    if not listed:
        return spark.createDataFrame([], "upload_id string, source_file_name string, ingested_at timestamp")
    names = list(dict.fromkeys(n for r in listed for n in r["header"]))
    width = max(len(r["header"]) for r in listed)
    spanning = {m: [r["stored_file_path"] for r in listed if r["multiline"] == m] for m in (True, False)}
    scanned = CSV.read_records(spark, spanning[False], spanning[True])
    headers = files.select(
        "file_path", "upload_id", "source_file_name", F.size("header").alias("__width"),
        F.array(*[F.array_position("header", n).cast("int") for n in names]).alias("__places"))
    found = attach_lineage(scanned, headers, ingested_at)
    found = found.withColumn("__cells", CSV.parse_cells(F.col("_text"), width))
    taken = {"upload_id", "source_file_name", "ingested_at", CSV.CORRUPT_COLUMN}
    return found.select(
        *[F.get("__cells", F.get("__places", F.lit(i)) - 1).alias(n) for i, n in enumerate(names) if n.lower() not in taken],
        F.when(LN.n_cells(F.col("_text")) != F.col("__width"), F.col("_text")).alias(CSV.CORRUPT_COLUMN),
        "upload_id", "source_file_name", "ingested_at")


def load_uploads(spark: SparkSession, files: DataFrame, target: str, staging: str,
                 ingested_at: Column, limit: float = MAX_CORRUPT_ROW_RATIO) -> DataFrame:
    """Scan -> stage -> gate -> publish for a batch of uploads of one dataset.

    The CSV is parsed exactly once, into a staging table partitioned by
    upload (shared storage). Counts come from the staged Parquet (two
    columns) and are written once beside it; the gate decides per upload, and
    only accepted uploads are published to ``target`` by dynamic partition
    overwrite, so re-running a load replaces its partitions instead of
    appending twice. The staging table is dropped after the publish. Returns
    the gate result (upload_id, row_count, corrupt_row_count, accepted, message).
    """
    staged = stage_uploads(spark, files, staging, ingested_at)
    counts = staged.groupBy("upload_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("_corrupt_record").alias("corrupt_row_count"))
    result = f"{staging}__gate"
    gated = gate(counts, files.select("upload_id"), limit)
    gated.write.mode("overwrite").parquet(result)
    gated = spark.read.schema(gated.schema).parquet(result)
    accepted = gated.where("accepted").select("upload_id")
    rows = staged.join(bounded_broadcast(accepted), "upload_id", "left_semi")
    publish(rows.select(*[c for c in staged.columns if c != "upload_id"], "upload_id"), target)
    drop_folder(spark, staging)
    return gated


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a table's folder that this run wrote."""
    from sluice.sources.landing import _fs_path

    fs, folder = _fs_path(spark, path)
    fs.delete(folder, True)


def stage_uploads(spark: SparkSession, files: DataFrame, staging: str, ingested_at: Column) -> DataFrame:
    """Parse the uploads once into a staging table (partitioned by upload,
    in shared storage) and return it read back: all counts and the publish
    read the staged Parquet, never the files again."""
    staged = scan_uploads(spark, files, ingested_at)
    staged.hint("rebalance", "upload_id").write.mode("overwrite").partitionBy("upload_id").parquet(staging)
    return spark.read.schema(staged.schema).parquet(staging)
