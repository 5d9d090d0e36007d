"""Data-quality reports over the manifest, silver and link tables.

Each report is a plain DataFrame plan (filters, one aggregation at most), so
they push filters into the scans and aggregate partially before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.contracts import Contract
from sluice.functions import status as S


def status_health(manifest: DataFrame) -> DataFrame:
    """Uploads and latest update per status, most frequent first."""
    return manifest.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.max("updated_at").alias("latest")
    ).orderBy(F.desc("n"), "status")


def unfinished_uploads(manifest: DataFrame) -> DataFrame:
    """Everything not PROCESSED or DUPLICATE, newest first."""
    return manifest.where(~F.col("status").isin(S.PROCESSED, S.DUPLICATE)).select(
        "upload_id", "original_file_name", "status", "validation_message", "uploaded_by", "updated_at"
    ).orderBy(F.desc("updated_at"), "upload_id")


def row_reconciliation(manifest: DataFrame) -> DataFrame:
    """PROCESSED uploads whose validation row count differs from bronze's."""
    return manifest.where(
        (F.col("status") == S.PROCESSED) & (F.col("source_row_count") != F.col("bronze_row_count"))
    ).select("upload_id", "original_file_name", "source_row_count", "bronze_row_count", "bronze_corrupt_row_count")


def cast_failures(silver: DataFrame, contract: Contract, key_columns: Sequence[str] | None = None) -> DataFrame:
    """Long form of every cell that did not convert: key, column, original text.

    One pass over silver: each row emits a small array of (column, raw, valid)
    structs, exploded and filtered - no union of per-column scans.
    """
    keys = list(key_columns or contract.key_columns)
    typed = [spec.name for spec in contract.columns if not spec.is_string]
    if not typed:
        return silver.where(F.lit(False)).select(*keys, F.lit(None).cast("string").alias("column_name"),
                                                 F.lit(None).cast("string").alias("raw_value"))
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"{name}_raw").alias("raw_value"),
            F.col(f"{name}_is_valid").alias("ok"),
        )
        for name in typed
    ])
    return (
        silver.select(*keys, F.inline(cells))
        .where(~F.col("ok"))
        .drop("ok")
    )


def ambiguous_dates(silver: DataFrame, date_column: str) -> DataFrame:
    """Count of dates whose day-of-month could also be a month."""
    return silver.agg(F.count_if(F.dayofmonth(date_column) <= 12).alias("possibly_inverted"))


def unexpected_columns_report(manifest: DataFrame) -> DataFrame:
    """Uploads per (dataset, unexpected column list), for non-empty lists."""
    return (
        manifest.where(F.size("unexpected_columns") > 0)
        .groupBy("dataset_name", "unexpected_columns")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def unexpected_columns_exploded(manifest: DataFrame) -> DataFrame:
    """Same signal per single column name."""
    return (
        manifest.where(F.size("unexpected_columns") > 0)
        .select("dataset_name", F.explode("unexpected_columns").alias("column_name"))
        .groupBy("dataset_name", "column_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def run_summary(run_events: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Counters per run from the events that run appended: files seen,
    registered, validated, rejected (either stage), loaded, errors."""
    st = F.col("status")
    return run_events.groupBy(run_col).agg(
        F.count_distinct("upload_id").alias("files_seen"),
        F.count_if(st == S.RECEIVED).alias("registered"),
        F.count_if(st == S.VALIDATED).alias("validated"),
        F.count_if(st.isin(S.REJECTED, S.BRONZE_REJECTED)).alias("rejected"),
        F.count_if(st == S.PROCESSED).alias("loaded"),
        F.count_if(st.isin(S.FAILED, S.BRONZE_FAILED)).alias("errors"),
    )


def needs_rebuild(processed: DataFrame, seen_by_build: DataFrame) -> DataFrame:
    """Per dataset: PROCESSED uploads the last silver build has not seen.

    Set difference on upload ids rather than comparing clocks, so rows
    committed while a build ran are never skipped. One left join against the
    distinct seen ids and one aggregation.
    """
    seen = seen_by_build.select("upload_id").distinct().withColumn("_seen", F.lit(True))
    marked = processed.join(seen, "upload_id", "left")
    return marked.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("processed_uploads"),
        F.count_if(F.col("_seen").isNull()).alias("new_uploads"),
        (F.count_if(F.col("_seen").isNull()) > 0).alias("needs_rebuild"),
        F.max("updated_at").alias("latest_processed_at"),
    )
