"""The upload manifest as an append-only event log.

Plain Parquet has no row UPDATE, and a per-row update loop does not scale
anyway. Every stage therefore appends sparse *events* (only the columns it
sets, plus ``seq`` and ``event_at``) and the current manifest is a fold:
per upload, each column takes its value from the latest event that set it.
The fold is one aggregation on ``upload_id`` (sort-based, as texts and arrays
are folded) with a partial, map-side step, so an upload with a huge number of events is combined before
the shuffle.

All decisions (register, claim, release) are set-based plans over the whole
work queue that emit new events; nothing loops over uploads on the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import status as S
from sluice.functions.columns import cap_message, strip_whitespace

# The manifest's columns and types. The last one is our own: the
# time of the file when it was hashed, so that later runs know it unread.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("upload_id", T.StringType(), False),
    T.StructField("dataset_name", T.StringType(), True),
    T.StructField("original_file_name", T.StringType(), True),
    T.StructField("stored_file_path", T.StringType(), True),
    T.StructField("file_size_bytes", T.LongType(), True),
    T.StructField("file_hash", T.StringType(), True),
    T.StructField("uploaded_by", T.StringType(), True),
    T.StructField("uploaded_at", T.TimestampType(), True),
    T.StructField("source_system", T.StringType(), True),
    T.StructField("reporting_period", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("validation_message", T.StringType(), True),
    T.StructField("missing_columns", T.ArrayType(T.StringType()), True),
    T.StructField("unexpected_columns", T.ArrayType(T.StringType()), True),
    T.StructField("duplicate_columns", T.ArrayType(T.StringType()), True),
    T.StructField("duplicate_of_upload_id", T.StringType(), True),
    T.StructField("pipeline_run_id", T.StringType(), True),
    T.StructField("bronze_processed_at", T.TimestampType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("source_row_count", T.LongType(), True),
    T.StructField("bronze_row_count", T.LongType(), True),
    T.StructField("bronze_corrupt_row_count", T.LongType(), True),
    T.StructField("file_modified_at", T.TimestampType(), True),
])

# Columns the fold derives itself rather than taking "last non-null".
_DERIVED = {"upload_id", "created_at", "updated_at"}
VALUE_COLUMNS = [f.name for f in MANIFEST_SCHEMA.fields if f.name not in _DERIVED]


def event_schema(ts_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Manifest event: the manifest's columns (all optional) + seq + event_at."""
    fields = [
        T.StructField(f.name, ts_type if isinstance(f.dataType, T.TimestampType) else f.dataType, True)
        for f in MANIFEST_SCHEMA.fields
        if f.name != "updated_at"
    ]
    return T.StructType(
        [T.StructField("seq", T.LongType(), False), T.StructField("event_at", ts_type, False)] + fields
    )


def as_events(df: DataFrame, seq: Column, event_at: Column, ts_type: T.DataType = T.TimestampType()) -> DataFrame:
    """Project any frame carrying some manifest columns to the full event
    shape, filling the rest with typed NULLs (one projection)."""
    present = set(df.columns)
    cols = [seq.cast("long").alias("seq"), event_at.cast(ts_type).alias("event_at")]
    for f in event_schema(ts_type).fields[2:]:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _last_set(c: str) -> Column:
    """Value of ``c`` from the newest event that set it (NULL = not set)."""
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq")))


def fold(events: DataFrame) -> DataFrame:
    """Current manifest state: one row per upload.

    An empty array counts as *set* (validated, nothing found) and overwrites
    an earlier NULL, which keeps the NULL-vs-[] distinction of the manifest.
    """
    value_cols = [c for c in VALUE_COLUMNS if c in events.columns]
    aggs = [_last_set(c).alias(c) for c in value_cols]
    aggs += [
        F.coalesce(F.min("created_at"), F.min("event_at")).alias("created_at"),
        F.max("event_at").alias("updated_at"),
        F.count(F.lit(1)).alias("n_events"),
    ]
    return events.groupBy("upload_id").agg(*aggs)


def state_of(events: DataFrame) -> DataFrame:
    """What some events say, in a form that can be merged with what others
    say: per upload and column the newest set value with its seq, and the
    bounds of the event times."""
    newest = [F.max(F.when(F.col(c).isNotNull(), F.struct("seq", F.col(c).alias("value")))).alias(c)
              for c in VALUE_COLUMNS if c in events.columns]
    return events.groupBy("upload_id").agg(
        *newest, F.min("created_at").alias("created_at"), F.min("event_at").alias("first_at"), F.max("event_at").alias("updated_at"),
        F.count(F.lit(1)).alias("n_events"))


def merge_states(states: DataFrame) -> DataFrame:
    """One state from several of disjoint events (any order): every part is a maximum, minimum or sum."""
    newest = [F.max(c).alias(c) for c in VALUE_COLUMNS if c in states.columns]
    return states.groupBy("upload_id").agg(
        *newest, F.min("created_at").alias("created_at"), F.min("first_at").alias("first_at"), F.max("updated_at").alias("updated_at"),
        F.sum("n_events").alias("n_events"))


def manifest_of(state: DataFrame) -> DataFrame:
    """The manifest that a state stands for: equals ``fold`` of its events."""
    return state.select(
        "upload_id", *[F.col(c)["value"].alias(c) for c in VALUE_COLUMNS if c in state.columns],
        F.coalesce("created_at", "first_at").alias("created_at"), "updated_at", "n_events")


def lookup(manifest: DataFrame, requests: DataFrame, id_col: str = "upload_id") -> DataFrame:
    """Resolve requested upload ids; unknown ids are flagged with the error
    text instead of failing (the caller decides before any change)."""
    state = manifest.select("upload_id", "status", F.lit(True).alias("_hit"))
    joined = requests.select(F.col(id_col).alias("upload_id")).distinct().join(state, "upload_id", "left")
    known = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.select(
        "upload_id",
        known.alias("known"),
        "status",
        F.when(~known, F.concat(F.lit("Upload ID was not found: "), F.col("upload_id"))).alias("message"),
    )


def work_queue(manifest: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """Uploads waiting in any of ``statuses``, oldest first (a distributed
    range sort; nothing is collected)."""
    return manifest.where(F.col("status").isin(*statuses)).orderBy("created_at", "upload_id")


def work_queues(manifest: DataFrame, stages: Mapping[str, Sequence[str]]) -> DataFrame:
    """The uploads that wait for each of several stages (``stage`` -> the
    statuses it takes), each stage's oldest first: one scan, one sort."""
    rules = F.array(*[F.struct(F.lit(i).alias("_place"), F.lit(name).alias("stage"), F.col("status").isin(*statuses).alias("_waits"))
                      for i, (name, statuses) in enumerate(stages.items())])
    waiting = manifest.select("*", F.inline(rules)).where("_waits")
    return waiting.orderBy("_place", "created_at", "upload_id").drop("_place", "_waits")


def _ts(now) -> Column:
    if isinstance(now, Column):
        return now
    if isinstance(now, _dt.datetime):
        return F.lit(now)
    return F.lit(now).cast("timestamp")


def stale(updated_at: Column, now, minutes: int = S.STALE_CLAIM_MINUTES) -> Column:
    return updated_at < (_ts(now) - F.make_dt_interval(mins=F.lit(minutes)))


def claim(
    manifest: DataFrame,
    from_statuses: Sequence[str],
    to_status: str,
    stage_label: str,
    now,
    minutes: int = S.STALE_CLAIM_MINUTES,
) -> DataFrame:
    """Claim decision for every upload of ``manifest`` in one plan.

    Eligible when the status is claimable, or the upload already sits in the
    working status and that claim is stale. Refusals carry the message
    naming the current status; claimed rows carry the new status.
    """
    st = F.col("status")
    eligible = st.isin(*from_statuses) | ((st == to_status) & stale(F.col("updated_at"), now, minutes))
    eligible = F.coalesce(eligible, F.lit(False))
    refusal = F.concat(
        F.lit("Upload "), F.col("upload_id"), F.lit(" has status '"), F.coalesce(st, F.lit("None")),
        F.lit(f"' and cannot be {stage_label}. Eligible statuses: {', '.join(from_statuses)}."),
    )
    return manifest.select(
        "upload_id",
        st.alias("current_status"),
        eligible.alias("claimed"),
        F.when(eligible, F.lit(to_status)).otherwise(st).alias("new_status"),
        F.when(~eligible, refusal).alias("message"),
    )


def release_stale(manifest: DataFrame, now, minutes: int = S.STALE_CLAIM_MINUTES) -> DataFrame:
    """Working-status uploads older than the stale limit, with the status they
    are released to and the fixed message."""
    mapping = F.create_map(*[x for kv in S.STALE_RELEASE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return manifest.where(
        F.col("status").isin(*S.STALE_RELEASE.keys()) & stale(F.col("updated_at"), now, minutes)
    ).select(
        "upload_id",
        F.col("status").alias("old_status"),
        F.try_element_at(mapping, F.col("status")).alias("new_status"),
        F.lit(S.STALE_MESSAGE).alias("validation_message"),
    )


def first_per_content(files: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                      id_col: str = "upload_id") -> DataFrame:
    """Earliest upload per content group (e.g. dataset + hash).

    An aggregation (``min`` of an ordering struct), not a window: partial
    aggregation collapses a group holding a third of all files map-side.
    """
    first = F.min(F.struct(*[F.col(c) for c in order_cols], F.col(id_col).alias("_id")))
    return files.groupBy(*group_cols).agg(first["_id"].alias("first_upload_id"))


def register_decisions(
    inventory: DataFrame,
    manifest: DataFrame,
    known_datasets: Iterable[str],
    order_cols: Sequence[str] = ("stored_file_path",),
) -> DataFrame:
    """Registration decision for every landing file at once.

    ``inventory``: dataset_name, stored_file_path, file_hash, upload_id
    (deterministic candidate id) and the ordering columns.
    ``manifest``: current state (upload_id, dataset_name, stored_file_path,
    file_hash, created_at).
    ``read_error`` (optional) says why a file could not be hashed.
    Actions, first match wins: UNKNOWN_DATASET; UNREADABLE; KNOWN (same path
    and contents, returns the existing id); CHANGED (same path, new contents:
    an error for a human); DUPLICATE (contents already registered in the
    dataset, or an earlier file of this batch); NEW.
    """
    datasets = list(known_datasets)
    inv = inventory.withColumn("dataset_name", F.lower(strip_whitespace("dataset_name")))
    by_path = manifest.groupBy("stored_file_path").agg(
        F.min(F.struct("created_at", "upload_id", "file_hash")).alias("_p")
    )
    registered = manifest.select(
        "dataset_name", "file_hash", F.struct("created_at", "upload_id").alias("_o")
    ).groupBy("dataset_name", "file_hash").agg(F.min("_o")["upload_id"].alias("registered_upload_id"))
    known_path = inv.join(by_path, "stored_file_path", "left").join(
        registered, ["dataset_name", "file_hash"], "left"
    )
    meta_err = F.col("metadata_error") if "metadata_error" in inventory.columns else F.lit(None).cast("string")
    read_err = F.col("read_error") if "read_error" in inventory.columns else F.lit(None).cast("string")
    # Earliest registrable file of this batch per (dataset, hash), for
    # same-batch copies (a file that will not be registered cannot be the
    # original of another).
    registrable = F.col("_p").isNull() & F.col("dataset_name").isin(*datasets) & meta_err.isNull() & read_err.isNull()
    batch_first = first_per_content(
        known_path.where(registrable), ["dataset_name", "file_hash"], list(order_cols)
    )
    joined = known_path.join(batch_first, ["dataset_name", "file_hash"], "left")
    action = (
        F.when(~F.col("dataset_name").isin(*datasets), F.lit("UNKNOWN_DATASET"))
        .when(meta_err.isNotNull(), F.lit("INVALID_METADATA"))
        .when(read_err.isNotNull(), F.lit("UNREADABLE"))
        .when(F.col("_p").isNotNull() & (F.col("_p.file_hash") == F.col("file_hash")), F.lit("KNOWN"))
        .when(F.col("_p").isNotNull(), F.lit("CHANGED"))
        .when(F.col("registered_upload_id").isNotNull(), F.lit("DUPLICATE"))
        .when(F.col("first_upload_id") != F.col("upload_id"), F.lit("DUPLICATE"))
        .otherwise(F.lit("NEW"))
    )
    keep = [c for c in inventory.columns if c not in ("dataset_name", "metadata_error", "read_error")]
    return joined.select(
        "dataset_name",
        *keep,
        action.alias("action"),
        F.when(action == "KNOWN", F.col("_p.upload_id"))
        .when(action.isin("NEW", "DUPLICATE"), F.col("upload_id"))
        .alias("result_upload_id"),
        F.when(action == "DUPLICATE", F.coalesce(F.col("registered_upload_id"), F.col("first_upload_id")))
        .alias("duplicate_of_upload_id"),
        F.when(action == "UNKNOWN_DATASET",
               F.concat(F.lit("Unknown dataset '"), F.col("dataset_name"),
                        F.lit("'. Expected one of: " + "[" + ", ".join(f"'{d}'" for d in datasets) + "]")))
        .when(action == "INVALID_METADATA", meta_err)
        .when(action == "UNREADABLE", read_err)
        .when(action == "CHANGED",
              F.concat(F.lit("This path is already registered but the contents have changed: "),
                       F.col("stored_file_path"),
                       F.lit(". The file was overwritten after registration. Investigate before registering again.")))
        .alias("message"),
    )


def registration_events(decisions: DataFrame, now, uploaded_by: Column | None = None) -> DataFrame:
    """Manifest rows (as events) for NEW and DUPLICATE decisions."""
    ts = _ts(now)
    new = decisions.where(F.col("action").isin("NEW", "DUPLICATE"))
    return new.select(
        F.col("result_upload_id").alias("upload_id"),
        "dataset_name",
        F.element_at(F.split(F.col("stored_file_path"), "/"), -1).alias("original_file_name"),
        "stored_file_path",
        "file_size_bytes",
        "file_hash",
        (uploaded_by if uploaded_by is not None else F.current_user()).alias("uploaded_by"),
        ts.alias("uploaded_at"),
        *[F.col(c) for c in ("source_system", "reporting_period") if c in decisions.columns],
        *[F.col("modification_time").alias("file_modified_at") for c in ("modification_time",) if c in decisions.columns],
        F.when(F.col("action") == "DUPLICATE", F.lit(S.DUPLICATE)).otherwise(F.lit(S.RECEIVED)).alias("status"),
        "duplicate_of_upload_id",
        ts.alias("created_at"),
    )


def to_column(value) -> Column:
    """A Python value as a typed manifest column: lists become
    ``array<string>``, text is capped, anything else a literal."""
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(str(v)) for v in value]).cast("array<string>")
    if isinstance(value, str):
        return cap_message(F.lit(value))
    return F.lit(value)


def manual_update(spark: SparkSession, upload_ids: Iterable[str], values: dict) -> DataFrame:
    """Sparse events for a hand-made change (e.g. send uploads back to
    RECEIVED): only the given columns are set; append them with a new seq."""
    ids = spark.createDataFrame([(u,) for u in upload_ids], "upload_id string")
    return ids.select("upload_id", *[to_column(v).alias(k) for k, v in values.items()])


def empty_events(spark: SparkSession, ts_type: T.DataType = T.TimestampType()) -> DataFrame:
    return spark.createDataFrame([], event_schema(ts_type))
