"""Registered queries: each SURVEY query key as a Spark plan over the driver's
tables. Result columns use the exact names of the matching oracle SQL;
decimals leave as double, dates and timestamps as text, arrays as
comma-joined text, so both engines hash the same values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import links as L
from sluice.operators import quality as Q
from sluice.operators import silver as SV
from sluice.plans import fixtures as FX

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _silver_out(df: DataFrame, lineage: bool = True) -> DataFrame:
    cols = [
        "order_code",
        F.col("order_date").cast("string").alias("order_date"),
        "order_date_raw",
        "order_date_is_valid",
        F.col("amount").cast("double").alias("amount"),
        "amount_raw",
        "amount_is_valid",
        "customer_id",
        "customer_id_raw",
        "customer_id_is_valid",
        "priority",
    ]
    if lineage:
        cols += ["upload_id", F.col("ingested_at").cast("string").alias("ingested_at")]
    return df.select(*cols)


def _silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SV.build_silver(FX.bronze_orders(spark, sf_dir), FX.ORDERS_CONTRACT)


# --------------------------------------------------------------- silver ----

@register("silver_typed")
def silver_typed(spark, sf_dir):
    bronze = FX.bronze_orders(spark, sf_dir)
    keyed = SV.keyed_rows(bronze, FX.ORDERS_CONTRACT)
    return _silver_out(SV.typed_projection(keyed, FX.ORDERS_CONTRACT))


@register("silver_build")
def silver_build(spark, sf_dir):
    return _silver_out(_silver_orders(spark, sf_dir))


@register("silver_incremental")
def silver_incremental(spark, sf_dir):
    """The silver table built from some uploads, then with the others added."""
    bronze = FX.bronze_orders(spark, sf_dir)
    later = F.pmod(F.crc32(F.encode("upload_id", "UTF-8")), F.lit(3)) == 0
    old = SV.build_silver(bronze.where(~later), FX.ORDERS_CONTRACT)
    added = SV.build_silver(bronze.where(later), FX.ORDERS_CONTRACT)
    return _silver_out(SV.merge_silver(old, added, FX.ORDERS_CONTRACT))


@register("silver_drop_reasons")
def silver_drop_reasons(spark, sf_dir):
    return SV.drop_reasons(FX.bronze_orders(spark, sf_dir), FX.ORDERS_CONTRACT)


@register("silver_summary")
def silver_summary(spark, sf_dir):
    return SV.silver_summary(FX.bronze_orders(spark, sf_dir), FX.ORDERS_CONTRACT)


@register("silver_optional_nulls")
def silver_optional_nulls(spark, sf_dir):
    bronze = FX.bronze_orders(spark, sf_dir).drop("customer_id")
    return _silver_out(SV.build_silver(bronze, FX.ORDERS_CONTRACT))


@register("dedup_latest")
def dedup_latest(spark, sf_dir):
    events = FX.table(spark, sf_dir, "events")
    latest = SV.dedup_latest(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select(
        "user_id", "event_id", F.col("ts").cast("string").alias("ts"), "event_type", "value"
    )


@register("dedup_latest_composite")
def dedup_latest_composite(spark, sf_dir):
    li = FX.table(spark, sf_dir, "lineitem")
    order = [
        F.col(c).desc()
        for c in ("l_shipdate", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    ]
    latest = SV.dedup_latest(li, ["l_orderkey", "l_partkey"], order)
    return latest.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.col("l_shipdate").cast("string").alias("l_shipdate"),
    )


@register("cast_failures")
def cast_failures(spark, sf_dir):
    return Q.cast_failures(_silver_orders(spark, sf_dir), FX.ORDERS_CONTRACT)


@register("ambiguous_dates")
def ambiguous_dates(spark, sf_dir):
    return Q.ambiguous_dates(_silver_orders(spark, sf_dir), "order_date")


# ---------------------------------------------------------------- links ----

def _links(spark, sf_dir) -> DataFrame:
    mapping, orders, parts = FX.link_inputs(spark, sf_dir)
    return L.resolve_links(
        mapping,
        [
            L.Reference("order", orders, "order_key", "o_orderkey"),
            L.Reference("part", parts, "part_key", "p_partkey"),
        ],
    )


@register("link_resolve")
def link_resolve(spark, sf_dir):
    return _links(spark, sf_dir)


@register("link_status_counts")
def link_status_counts(spark, sf_dir):
    return L.link_status_counts(_links(spark, sf_dir))


@register("orphan_links")
def orphan_links(spark, sf_dir):
    return L.orphan_links(_links(spark, sf_dir), ["order_key", "part_key"])


@register("mapping_coverage")
def mapping_coverage(spark, sf_dir):
    _, _, parts = FX.link_inputs(spark, sf_dir)
    return L.mapping_coverage(parts, "p_partkey", _links(spark, sf_dir), "part_key")


@register("mapping_coverage_raw")
def mapping_coverage_raw(spark, sf_dir):
    _, _, parts = FX.link_inputs(spark, sf_dir)
    return L.mapping_coverage_raw(parts, "p_partkey", _links(spark, sf_dir), "part_key")


# ------------------------------------------------------- header checks ----

from sluice.contracts import contracts_frame  # noqa: E402
from sluice.functions import messages as M  # noqa: E402
from sluice.functions.columns import normalise_name  # noqa: E402
from sluice.operators import validate as V  # noqa: E402


def _joined(c: str):
    return F.array_join(F.col(c), ",").alias(c)


@register("normalise_header")
def normalise_header(spark, sf_dir):
    part = FX.table(spark, sf_dir, "part").select(
        F.lit("part").alias("src"), F.col("p_partkey").alias("id"), F.col("p_name").alias("raw_name"))
    orders = FX.table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("src"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("raw_name"))
    cust = FX.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("src"), F.col("c_custkey").alias("id"), F.col("c_name").alias("raw_name"))
    pages = FX.table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("src"), F.col("page_id").alias("id"), F.col("url").alias("raw_name"))
    names = part.unionByName(orders).unionByName(cust).unionByName(pages)
    return names.select("src", "id", "raw_name", normalise_name("raw_name").alias("column_name"))


def _checked_headers(spark, sf_dir):
    uploads = FX.header_uploads(spark, sf_dir)
    rules = contracts_frame(spark, FX.validation_contracts())
    checked = V.check_columns(uploads, rules)
    return checked.withColumn(
        "violation", F.when(F.array_contains("header", ""), F.lit(M.BLANK_COLUMN_NAME))
    )


@register("validate_contract")
def validate_contract(spark, sf_dir):
    out = V.validation_outcome(_checked_headers(spark, sf_dir))
    return out.select(
        "upload_id", "dataset_name", _joined("header"), "status", "validation_message",
        "source_row_count", _joined("missing_columns"), _joined("unexpected_columns"),
        _joined("duplicate_columns"),
    )


@register("unexpected_columns_report")
def unexpected_columns_report(spark, sf_dir):
    manifest = V.validation_outcome(_checked_headers(spark, sf_dir))
    return Q.unexpected_columns_report(manifest).select(
        "dataset_name", _joined("unexpected_columns"), "n")


@register("contract_drift_guard")
def contract_drift_guard(spark, sf_dir):
    manifest = V.validation_outcome(_checked_headers(spark, sf_dir))
    loaded = manifest.where(F.col("status") == "VALIDATED").select(
        "dataset_name", F.explode("header").alias("column_name"))
    rules = contracts_frame(spark, FX.drift_contracts())
    out = V.drift_guard(loaded, rules)
    return out.select("dataset_name", _joined("required_missing"), _joined("available_columns"), "drift_message")


# ------------------------------------------------------------- manifest ----

from sluice.functions import status as S  # noqa: E402
from sluice.operators import manifest as MF  # noqa: E402


def _ts_text(c: str):
    return F.col(c).cast("string").alias(c)


@register("manifest_fold")
def manifest_fold(spark, sf_dir):
    m = FX.manifest_state(spark, sf_dir)
    return m.select(
        "upload_id", "status", "dataset_name", "original_file_name", "uploaded_by", "validation_message",
        "source_row_count", "bronze_row_count", "bronze_corrupt_row_count",
        _joined("missing_columns"), _joined("unexpected_columns"),
        _ts_text("created_at"), _ts_text("updated_at"), "n_events",
    )


@register("manifest_state")
def manifest_state(spark, sf_dir):
    """The manifest from a stream over the event log that takes up two
    appends one after the other, each read once."""
    from pyspark.sql import types as T

    from sluice.plans.session import scratch_path
    from sluice.streaming import manifest_state as MS

    ntz = T.TimestampNTZType()
    events = MF.as_events(FX.manifest_events(spark, sf_dir), F.col("seq"), F.col("event_at"), ntz).withColumn(
        "event_day", F.to_date("event_at"))
    log, root = scratch_path(spark, "events"), scratch_path(spark, "state")
    early = F.pmod(F.col("seq"), F.lit(3)) != 0  # the second append also has older events
    for part in (early, ~early):
        events.where(part).write.mode("append").partitionBy("event_day").parquet(log)
        MS.advance(spark, log, root, ntz)
    m = MS.current(spark, log, root, ntz)
    return m.select(
        "upload_id", "status", "dataset_name", "original_file_name", "uploaded_by", "validation_message",
        "source_row_count", "bronze_row_count", "bronze_corrupt_row_count",
        _joined("missing_columns"), _joined("unexpected_columns"),
        _ts_text("created_at"), _ts_text("updated_at"), "n_events",
    )


@register("manifest_lookup")
def manifest_lookup(spark, sf_dir):
    requests = FX.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("upload_id"))
    return MF.lookup(FX.manifest_state(spark, sf_dir), requests)


@register("work_queue")
def work_queue(spark, sf_dir):
    m = FX.manifest_state(spark, sf_dir)
    stages = {"validate": S.CLAIMABLE_FOR_VALIDATION, "bronze": S.CLAIMABLE_FOR_BRONZE}
    return MF.work_queues(m, stages).select("stage", "upload_id", "status", _ts_text("created_at"))


@register("claim_transition")
def claim_transition(spark, sf_dir):
    m = FX.manifest_state(spark, sf_dir)
    now = FX.manifest_now()
    v = MF.claim(m, S.CLAIMABLE_FOR_VALIDATION, S.VALIDATING, "validated", now)
    b = MF.claim(m, S.CLAIMABLE_FOR_BRONZE, S.PROCESSING, "loaded to bronze", now)
    return v.select(F.lit("validate").alias("stage"), "*").unionByName(
        b.select(F.lit("bronze").alias("stage"), "*"))


@register("release_stale")
def release_stale(spark, sf_dir):
    return MF.release_stale(FX.manifest_state(spark, sf_dir), FX.manifest_now())


@register("status_health")
def status_health(spark, sf_dir):
    return Q.status_health(FX.manifest_state(spark, sf_dir)).select("status", "n", _ts_text("latest"))


@register("unfinished_uploads")
def unfinished_uploads(spark, sf_dir):
    out = Q.unfinished_uploads(FX.manifest_state(spark, sf_dir))
    return out.select(
        "upload_id", "original_file_name", "status", "validation_message", "uploaded_by", _ts_text("updated_at"))


@register("row_reconciliation")
def row_reconciliation(spark, sf_dir):
    return Q.row_reconciliation(FX.manifest_state(spark, sf_dir))


@register("run_summary")
def run_summary(spark, sf_dir):
    ev = FX.manifest_events(spark, sf_dir).select(
        F.to_date("event_at").cast("string").alias("run_id"), "upload_id", "status")
    return Q.run_summary(ev)


@register("incremental_check")
def incremental_check(spark, sf_dir):
    m = FX.manifest_state(spark, sf_dir)
    processed = m.where(F.col("status") == S.PROCESSED).select("dataset_name", "upload_id", "updated_at")
    seen = FX.manifest_events(spark, sf_dir).where(
        (F.col("status") == S.PROCESSED) & (F.col("event_at") < F.lit(FX.LAST_BUILD_AT).cast("timestamp_ntz"))
    ).select("upload_id")
    out = Q.needs_rebuild(processed, seen)
    return out.select(
        "dataset_name", "processed_uploads", "new_uploads", "needs_rebuild",
        (F.col("latest_processed_at") > F.lit(FX.LAST_BUILD_AT).cast("timestamp_ntz")).alias("newer_by_clock"),
    )


# -------------------------------------------------------- registration ----

from sluice.functions.columns import cap_message, cut_message  # noqa: E402


def _decisions(spark, sf_dir):
    files = FX.document_files(spark, sf_dir)
    inv = files.select("dataset_name", "stored_file_path", "file_hash", "file_size_bytes", "upload_id",
                       "source_system", "reporting_period", "metadata_error")
    return MF.register_decisions(inv, FX.registered_manifest(files), FX.DOC_DATASETS)


@register("content_hash")
def content_hash(spark, sf_dir):
    return FX.document_files(spark, sf_dir).select("doc_id", "file_hash", "file_size_bytes")


@register("duplicate_detect")
def duplicate_detect(spark, sf_dir):
    files = FX.document_files(spark, sf_dir)
    first = MF.first_per_content(files, ["dataset_name", "file_hash"], ["stored_file_path"])
    j = files.join(first, ["dataset_name", "file_hash"], "left")
    dup = F.col("first_upload_id") != F.col("upload_id")
    return j.select(
        "doc_id", "dataset_name", "file_hash",
        F.when(dup, F.lit(S.DUPLICATE)).otherwise(F.lit(S.RECEIVED)).alias("status"),
        F.when(dup, F.col("first_upload_id")).alias("duplicate_of_upload_id"),
    )


@register("register_action")
def register_action(spark, sf_dir):
    return _decisions(spark, sf_dir).select(
        "dataset_name", "stored_file_path", "file_hash", "action", "result_upload_id",
        "duplicate_of_upload_id", "message")


@register("manifest_register")
def manifest_register(spark, sf_dir):
    ev = MF.registration_events(_decisions(spark, sf_dir), F.lit(FX.MANIFEST_NOW).cast("timestamp_ntz"))
    return ev.select(
        "upload_id", "dataset_name", "original_file_name", "stored_file_path", "file_size_bytes", "file_hash",
        "source_system", "reporting_period", "status", "duplicate_of_upload_id")


@register("metadata_clean")
def metadata_clean(spark, sf_dir):
    return FX.document_files(spark, sf_dir).select(
        "doc_id", "source_system", "reporting_period", "metadata_error")


@register("message_cap")
def message_cap(spark, sf_dir):
    d = FX.table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.length("text").cast("long").alias("original_length"),
        cap_message("text").alias("validation_message"),
        cut_message("text").alias("build_error"),
    )


# ------------------------------------------------------------ csv / bronze ----

from sluice.operators import bronze as BR  # noqa: E402
from sluice.sources import csv_files as CSV  # noqa: E402


def _parsed_lines(spark, sf_dir):
    return CSV.parse_lines(FX.order_lines(spark, sf_dir), "line", FX.LINE_HEADER)


def _gated(spark, sf_dir):
    lines = FX.order_lines(spark, sf_dir)
    counts = CSV.count_rows(_parsed_lines(spark, sf_dir), ["upload_id"])
    return BR.gate(counts, lines)


@register("csv_permissive_scan")
def csv_permissive_scan(spark, sf_dir):
    return _parsed_lines(spark, sf_dir).select("upload_id", "line_no", *FX.LINE_HEADER, "_corrupt_record")


@register("corrupt_ratio_gate")
def corrupt_ratio_gate(spark, sf_dir):
    return _gated(spark, sf_dir)


@register("bronze_outcome")
def bronze_outcome(spark, sf_dir):
    src = FX.order_lines(spark, sf_dir).groupBy("upload_id").agg(F.count(F.lit(1)).alias("source_row_count"))
    out = BR.outcome(_gated(spark, sf_dir), "bronze.orders", F.lit(FX.MANIFEST_NOW).cast("timestamp_ntz"), src)
    return out.select(
        "upload_id", "status", "validation_message", "bronze_row_count", "bronze_corrupt_row_count",
        "source_row_count", F.col("bronze_processed_at").isNotNull().alias("processed"))


@register("csv_structure_probe")
def csv_structure_probe(spark, sf_dir):
    probed = CSV.text_structure(FX.csv_texts(spark, sf_dir), "doc_id", "content")
    return probed.select("doc_id", _joined("header"), "row_count", "violation")


# ----------------------------------------------------- files on disk ----

from sluice.sources import landing as LD  # noqa: E402


def _landing_files(spark, sf_dir):
    """Inventory + structure probe of the landing files, written once to a
    scratch table: the scan that follows reads this metadata several times
    (shapes, paths, lineage) and must not re-run the probe each time."""
    from sluice.plans.session import scratch_path

    inv = LD.inventory(spark, FX.order_landing(spark, sf_dir), min_age_seconds=0)
    paths = [r[0] for r in inv.where("file_size_bytes > 0").select("stored_file_path").collect()]
    out = scratch_path(spark, "probe")
    CSV.file_structure(spark, inv, paths).select(
        F.regexp_extract("original_file_name", r"^(.*)\.csv$", 1).alias("upload_id"),
        "stored_file_path", "file_path", F.col("original_file_name").alias("source_file_name"), "header",
        "row_count", "multiline", "violation",
    ).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def _landing_bronze(spark, sf_dir):
    from sluice.plans.session import scratch_path

    files = _landing_files(spark, sf_dir)
    return BR.stage_uploads(spark, files, scratch_path(spark, "staging"),
                            F.lit(FX.MANIFEST_NOW).cast("timestamp_ntz"))


@register("landing_inventory")
def landing_inventory(spark, sf_dir):
    inv = LD.hash_files(spark, LD.inventory(spark, FX.order_landing(spark, sf_dir), min_age_seconds=0))
    return inv.select("dataset_name", "original_file_name", "file_size_bytes", "file_hash")


@register("change_detection")
def change_detection(spark, sf_dir):
    dirs = FX.order_landing(spark, sf_dir)
    files = LD.hash_files(spark, LD.inventory(spark, dirs, min_age_seconds=0))
    up = F.regexp_extract("original_file_name", r"^(.*)\.csv$", 1)
    # What registration recorded: L5 with older contents, L6 at a path that is gone.
    registered = files.select(
        up.alias("upload_id"),
        F.when(up == "L6", F.regexp_replace("stored_file_path", r"\.csv$", "_old.csv"))
        .otherwise(F.col("stored_file_path")).alias("stored_file_path"),
        F.when(up == "L5", F.sha2(F.lit("older contents"), 256)).otherwise(F.col("file_hash")).alias("file_hash"),
    )
    checked = LD.change_check(registered, files, " has changed since it was registered.")
    return checked.select("upload_id", "file_state")


@register("bronze_lineage")
def bronze_lineage(spark, sf_dir):
    b = _landing_bronze(spark, sf_dir)
    return b.groupBy("upload_id", "source_file_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_corrupt_record").alias("n_corrupt"),
        F.count("order_code").alias("n_keyed"))


@register("bronze_schema_merge")
def bronze_schema_merge(spark, sf_dir):
    b = _landing_bronze(spark, sf_dir)
    return b.groupBy("upload_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("channel").alias("n_channel"),
        F.count("priority").alias("n_priority"))


@register("bronze_idempotent_load")
def bronze_idempotent_load(spark, sf_dir):
    from sluice.plans.session import scratch_path

    files = _landing_files(spark, sf_dir)
    target = scratch_path(spark, "bronze")
    for attempt in range(2):  # the second load replaces the first, it never appends
        BR.load_uploads(spark, files, target, scratch_path(spark, f"staging{attempt}"),
                        F.lit(FX.MANIFEST_NOW).cast("timestamp_ntz")).collect()
    loaded = spark.read.option("mergeSchema", "true").parquet(target)
    return loaded.groupBy("upload_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("unexpected_columns_by_name")
def unexpected_columns_by_name(spark, sf_dir):
    manifest = V.validation_outcome(_checked_headers(spark, sf_dir))
    return Q.unexpected_columns_exploded(manifest)


@register("contract_schema")
def contract_schema(spark, sf_dir):
    """Silver table definition of every dataset that has uploads, with the
    number of uploads that will feed it."""
    from sluice.contracts import silver_columns_frame

    uploads = FX.header_uploads(spark, sf_dir).groupBy("dataset_name").agg(F.count(F.lit(1)).alias("n_uploads"))
    cols = silver_columns_frame(spark, FX.validation_contracts())
    # both sides are one row per configured dataset (x columns): config-bounded
    return cols.join(F.broadcast(uploads), "dataset_name", "inner").select(
        "dataset_name", "ordinal", "column_name", "data_type", "n_uploads")


@register("upload_run_status")
def upload_run_status(spark, sf_dir):
    """The whole upload path on the landing files: one scheduled run
    (register, validate, bronze) and a silver build into a fresh store; per
    upload the manifest outcome and the rows it contributed to silver."""
    import datetime as dt

    from sluice.plans import batch
    from sluice.plans.session import scratch_path

    dirs = FX.order_landing(spark, sf_dir)
    store = batch.Store(scratch_path(spark, "store"))
    contracts = {"orders": FX.LANDING_CONTRACT}
    now = dt.datetime(2030, 1, 1)
    batch.run_uploads(spark, store, contracts, dirs, now, min_age_seconds=0)
    batch.run_silver(spark, store, contracts, now)
    manifest = batch.current_manifest(spark, store)
    silver = spark.read.parquet(store.silver("orders"))
    per_upload = silver.groupBy("upload_id").agg(F.count(F.lit(1)).alias("silver_rows"))
    return manifest.join(per_upload, "upload_id", "left").select(
        F.regexp_extract("original_file_name", r"^(.*)\.csv$", 1).alias("upload_id"),
        "status", "source_row_count", "bronze_row_count", "bronze_corrupt_row_count",
        F.coalesce(F.col("silver_rows"), F.lit(0)).alias("silver_rows"),
    )


@register("upload_run_failures")
def upload_run_failures(spark, sf_dir):
    """An upload run over two datasets in which one registered file has become
    unreadable: that upload fails, all others go their way."""
    import datetime as dt

    from sluice.plans import batch
    from sluice.plans.session import scratch_path

    dirs = FX.split_landing(spark, sf_dir)
    store = batch.Store(scratch_path(spark, "store"))
    contracts = {name: FX.LANDING_CONTRACT for name in dirs}
    first = dt.datetime(2030, 1, 1)
    now_c, run_seq, run_dir = batch._run(store, first)
    batch.register_stage(spark, store, contracts, LD.inventory(spark, dirs, now_c, 0), now_c, run_dir, run_seq * 100)
    FX.make_unreadable(spark, f"{dirs['orders']}/L2.csv")
    batch.run_uploads(spark, store, contracts, dirs, first + dt.timedelta(minutes=15), min_age_seconds=0)
    return batch.current_manifest(spark, store).select(
        F.regexp_extract("original_file_name", r"^(.*)\.csv$", 1).alias("upload_id"), "dataset_name", "status",
        "source_row_count", "bronze_row_count", "bronze_corrupt_row_count")


@register("landing_structure")
def landing_structure(spark, sf_dir):
    """What the structure check says of the landing files."""
    return _landing_files(spark, sf_dir).select("upload_id", _joined("header"), "row_count", "multiline", "violation")


@register("bronze_spanning_records")
def bronze_spanning_records(spark, sf_dir):
    """Documents as cells of CSV files, line breaks and quotes included: files
    whose records span lines, read in splits. Per upload (of one file, or of
    several where it is large) the rows and a digest of the cells."""
    from sluice.plans.session import scratch_path

    files = FX.document_csv(spark, sf_dir)
    inv = LD.inventory(spark, files, min_age_seconds=0)
    paths = [r[0] for r in inv.where("file_size_bytes > 0").select("stored_file_path").collect()]
    out = scratch_path(spark, "probe")
    CSV.file_structure(spark, inv, paths).select(
        F.regexp_extract("original_file_name", r"^(.*)\.csv$", 1).alias("upload_id"), "stored_file_path", "file_path",
        F.col("original_file_name").alias("source_file_name"), "header", "row_count", "multiline").write.parquet(out)
    rows = BR.stage_uploads(spark, spark.read.parquet(out), scratch_path(spark, "staging"),
                            F.lit(FX.MANIFEST_NOW).cast("timestamp_ntz"))
    return rows.groupBy(FX.document_upload(F.col("upload_id")).alias("upload_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_corrupt_record").alias("n_corrupt"),
        F.sum(F.length("body")).alias("n_chars"),
        F.sum(F.conv(F.substring(F.md5(F.encode("body", "UTF-8")), 1, 8), 16, 10).cast("long")).alias("sum_digest"))
