"""Header validation against column contracts, for all uploads at once.

Input is one row per upload with its (already normalised) header array; the
contract rules arrive as a per-dataset frame bounded by configuration size
and are broadcast. Every rule is an array expression evaluated inside the
row, so validation is a map-only stage: no shuffle, no driver loop.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.contracts import Contract, contracts_frame
from sluice.functions import status as S
from sluice.functions.columns import cap_message, normalise_name

PASS_TEXT = "File passed structural contract validation."


def normalise_header(header: Column) -> Column:
    """Normalise every name of a header array."""
    return F.transform(header, normalise_name)


def duplicate_names(header: Column) -> Column:
    """Names occurring more than once, sorted, each once."""
    repeated = F.filter(header, lambda x: F.size(F.filter(header, lambda y: y == x)) > 1)
    return F.array_sort(F.array_distinct(repeated))


def _joined(label: str, arr: Column) -> Column:
    return F.when(F.size(arr) > 0, F.concat(F.lit(label), F.array_join(arr, ", ")))


def check_message(is_valid: Column, missing: Column, duplicate: Column,
                  unexpected: Column, reject_unexpected: Column) -> Column:
    """Human message: pass text (+ allowed extras), or the problems in the
    order missing, duplicate, unexpected (only when rejected), '; '-joined."""
    passed = F.concat_ws(
        "; ", F.lit(PASS_TEXT), _joined("Extra columns present but allowed: ", unexpected)
    )
    failed = F.concat_ws(
        "; ",
        _joined("Missing required columns: ", missing),
        _joined("Duplicate columns: ", duplicate),
        F.when(reject_unexpected, _joined("Unexpected columns: ", unexpected)),
    )
    return F.when(is_valid, passed).otherwise(failed)


def check_columns(uploads: DataFrame, rules: DataFrame, header_col: str = "header") -> DataFrame:
    """Compare each upload's header with its dataset's contract.

    ``uploads``: (..., dataset_name, header array<string>); ``rules``: the
    ``contracts_frame``. Adds missing/unexpected/duplicate arrays (sorted),
    ``is_valid`` and ``validation_message``. Uploads of an unknown dataset
    get ``known_dataset = false`` and NULL verdicts.
    """
    h = F.col(header_col)
    joined = uploads.join(F.broadcast(rules.withColumn("_known", F.lit(True))), "dataset_name", "left")
    missing = F.array_sort(F.array_except(F.col("required_columns"), h))
    unexpected = F.array_sort(F.array_except(h, F.col("allowed_columns")))
    duplicate = duplicate_names(h)
    staged = joined.select(
        *[F.col(c) for c in uploads.columns],
        F.coalesce(F.col("_known"), F.lit(False)).alias("known_dataset"),
        F.col("reject_unexpected"),
        missing.alias("missing_columns"),
        unexpected.alias("unexpected_columns"),
        duplicate.alias("duplicate_columns"),
    )
    valid = ~(
        (F.size("missing_columns") > 0)
        | (F.size("duplicate_columns") > 0)
        | ((F.size("unexpected_columns") > 0) & F.col("reject_unexpected"))
    )
    return staged.select(
        "*",
        F.when(F.col("known_dataset"), valid).alias("is_valid"),
        F.when(
            F.col("known_dataset"),
            check_message(valid, F.col("missing_columns"), F.col("duplicate_columns"),
                          F.col("unexpected_columns"), F.col("reject_unexpected")),
        ).alias("validation_message"),
    )


def validation_outcome(checked: DataFrame, violation_col: str = "violation",
                       row_count_col: str = "row_count") -> DataFrame:
    """Manifest update of the validation stage per upload.

    A structure violation (unreadable / empty / wrong delimiter / changed file)
    rejects with its own message, zero rows and empty arrays; otherwise the
    column check decides VALIDATED or REJECTED.
    """
    empty = F.array().cast("array<string>")
    violated = F.col(violation_col).isNotNull()
    return checked.select(
        *[c for c in checked.columns if c not in (
            "missing_columns", "unexpected_columns", "duplicate_columns", "is_valid",
            "validation_message", row_count_col, violation_col)],
        F.when(violated, F.lit(S.REJECTED))
        .when(F.col("is_valid"), F.lit(S.VALIDATED))
        .otherwise(F.lit(S.REJECTED)).alias("status"),
        cap_message(F.coalesce(F.col(violation_col), F.col("validation_message"))).alias("validation_message"),
        F.when(violated, F.lit(0)).otherwise(F.col(row_count_col)).cast("long").alias("source_row_count"),
        F.when(violated, empty).otherwise(F.col("missing_columns")).alias("missing_columns"),
        F.when(violated, empty).otherwise(F.col("unexpected_columns")).alias("unexpected_columns"),
        F.when(violated, empty).otherwise(F.col("duplicate_columns")).alias("duplicate_columns"),
    )


def validate_uploads(spark: SparkSession, uploads: DataFrame, contracts: Mapping[str, Contract],
                     header_col: str = "header") -> DataFrame:
    """Convenience: contract frame + check in one call."""
    return check_columns(uploads, contracts_frame(spark, contracts), header_col)


def drift_guard(bronze_columns: DataFrame, rules: DataFrame) -> DataFrame:
    """Per dataset: required contract columns absent from bronze.

    ``bronze_columns``: (dataset_name, column_name) rows, e.g. the exploded
    headers of every loaded upload. They are made distinct first, so what is
    gathered per dataset is its column names (bounded by the width of the
    files, not their number); what is required and not among them is an anti
    join.
    """
    names = bronze_columns.select("dataset_name", "column_name").distinct()
    required = rules.select("dataset_name", F.explode("required_columns").alias("column_name"))
    absent = required.join(names, ["dataset_name", "column_name"], "left_anti")
    none = F.array().cast("array<string>")

    def listed(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("dataset_name").agg(F.array_sort(F.collect_list("column_name")).alias(name))

    # One row per configured dataset on all sides: broadcast is config-bounded.
    known = listed(names.join(F.broadcast(rules.select("dataset_name")), "dataset_name", "left_semi"), "available_columns")
    out = rules.select("dataset_name").join(F.broadcast(listed(absent, "required_missing")), "dataset_name", "left").join(
        F.broadcast(known), "dataset_name", "left")
    out = out.select("dataset_name", F.coalesce("required_missing", none).alias("required_missing"),
                     F.coalesce("available_columns", none).alias("available_columns"))
    return out.withColumn("drift_message", F.when(F.size("required_missing") > 0, F.concat(
        F.lit("The contract for '"), F.col("dataset_name"),
        F.lit("' requires columns that do not exist in bronze: "), F.array_join("required_missing", ", "),
        F.lit(". Bronze currently has: "), F.array_join("available_columns", ", "))))


def drift_message(bronze: DataFrame, dataset: str, contract: Contract) -> str | None:
    """The drift guard's message for one bronze table, or None."""
    spark = bronze.sparkSession
    columns = spark.createDataFrame([(dataset, c) for c in bronze.columns], "dataset_name string, column_name string")
    return drift_guard(columns, contracts_frame(spark, {dataset: contract})).first()["drift_message"]
