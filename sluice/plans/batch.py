"""Batch runs: upload stages (register -> validate -> bronze), silver, links.

Each stage is one set-based plan over every file / upload / dataset of the
run, followed by one append of manifest events. The driver only handles
bounded metadata: the list of distinct header shapes, the paths of queued
uploads, per-status counters. Intermediate results that feed more than one
action are written under the store (shared storage) and read back, which
also cuts lineage; nothing uses machine-local temp space.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.contracts import Contract, contracts_frame
from sluice.functions import status as S
from sluice.functions.columns import cap_message
from sluice.functions.sizing import bounded_broadcast
from sluice.operators import bronze as BR
from sluice.operators import links as L
from sluice.operators import manifest as MF
from sluice.operators import silver as SV
from sluice.operators import validate as V
from sluice.sources import csv_files as CSV
from sluice.sources import landing as LD


logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Store:
    """Where every table of the engine lives (Parquet folders).

    ``database``: silver and link tables are also named in this database of
    Spark's catalog: every build writes a table of its own, and a view is then
    replaced to name it, so readers of the view see the old table until the
    new one is whole. ``strict``: the manifest must have been set up
    (``create_manifest``); without, the first run does it.
    ``incremental_manifest``: the manifest is kept by a stream over its events
    (``sluice.streaming.manifest_state``) instead of folding all of them.
    """

    root: str
    database: str | None = None
    strict: bool = False
    incremental_manifest: bool = False

    @property
    def manifest_events(self) -> str:
        return f"{self.root}/manifest_events"

    @property
    def manifest_state(self) -> str:
        return f"{self.root}/manifest_state"

    def bronze(self, dataset: str) -> str:
        return f"{self.root}/bronze/{dataset}"

    def silver(self, dataset: str) -> str:
        return f"{self.root}/silver/{dataset}"

    def silver_seen(self, dataset: str) -> str:
        return f"{self.root}/silver_seen/{dataset}"

    def link(self, name: str) -> str:
        return f"{self.root}/links/{name}"

    def run_dir(self, run_seq: int) -> str:
        return f"{self.root}/_runs/{run_seq}"

    def view(self, path: str) -> str | None:
        """The name of a table's view in the catalog."""
        if not self.database:
            return None
        return f"{self.database}.{path.removeprefix(self.root + '/').replace('/', '_')}"


def persist(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result to shared storage and continue from the
    written copy (cuts lineage; later actions never recompute the plan).
    The schema is passed to the read, so no inference job runs."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, there = LD._fs_path(spark, source)
    if not fs.rename(there, LD._fs_path(spark, target)[1]):
        raise OSError(f"Could not rename {source} to {target}")


def _recover(spark: SparkSession, path: str) -> None:
    """Put the replaced table back where a replacement was broken off between its two renames."""
    if not _exists(spark, path) and _exists(spark, f"{path}__previous"):
        _rename(spark, f"{path}__previous", path)


def replace_table(spark: SparkSession, df: DataFrame, path: str, view: str | None = None) -> DataFrame:
    """Replace the table at ``path``, or what ``view`` names. The new one is
    written whole beside the old one first, so a build that fails leaves that
    as it was; the one replaced is kept until the next replacement.

    Folders change places by two renames, and ``read_table`` puts the old one
    back if only the first was made. A view is replaced in one step, without
    any rename."""
    if view:
        name = f"{view}__{_append_seq()}"
        older = sorted(t.name for t in spark.catalog.listTables(view.split(".")[0]) if t.name.startswith(f"{view.split('.')[1].lower()}__"))
        df.write.option("path", f"{path}__{name.rsplit('__', 1)[1]}").saveAsTable(name)
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {name}")
        for old in older[:-1]:
            spark.sql(f"DROP TABLE IF EXISTS {view.split('.')[0]}.{old}")
            BR.drop_folder(spark, f"{path}__{old.rsplit('__', 1)[1]}")
        return spark.table(view)
    new, old = f"{path}__next", f"{path}__previous"
    _recover(spark, path)
    df.write.mode("overwrite").parquet(new)
    if _exists(spark, path):
        BR.drop_folder(spark, old)
        _rename(spark, path, old)
    _rename(spark, new, path)
    return spark.read.schema(df.schema).parquet(path)


def table_exists(spark: SparkSession, store: Store, path: str) -> bool:
    view = store.view(path)
    if view:
        return spark.catalog.tableExists(view)
    _recover(spark, path)
    return _exists(spark, path)


def read_table(spark: SparkSession, store: Store, path: str) -> DataFrame:
    """A silver or link table of the store."""
    view = store.view(path)
    if view:
        return spark.table(view)
    _recover(spark, path)
    return spark.read.parquet(path)


def create_manifest(spark: SparkSession, store: Store) -> bool:
    """Set-up step: an empty event log (an existing one is left alone)."""
    if _exists(spark, store.manifest_events):
        return False
    MF.empty_events(spark).withColumn("event_day", F.to_date("event_at")).write.partitionBy("event_day").parquet(store.manifest_events)
    return True


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = LD._fs_path(spark, path)
    return fs.exists(hpath)


def read_events(spark: SparkSession, store: Store) -> DataFrame:
    """The whole manifest event log. Before it is set up it is empty, or an error in a strict store."""
    # Explicit schema: no inference job, and a log holding only empty appends
    # (no data files yet) still reads as an empty table.
    schema = T.StructType(MF.event_schema().fields + [T.StructField("event_day", T.DateType())])
    if not _exists(spark, store.manifest_events):
        if store.strict:
            raise FileNotFoundError(f"The manifest does not exist: {store.manifest_events}. Set it up with create_manifest.")
        return MF.empty_events(spark)
    return spark.read.schema(schema).parquet(store.manifest_events).drop("event_day")


def current_manifest(spark: SparkSession, store: Store) -> DataFrame:
    """The current state of every upload."""
    events = read_events(spark, store)
    if store.incremental_manifest and _exists(spark, store.manifest_events):
        from sluice.streaming import manifest_state

        return manifest_state.current(spark, store.manifest_events, store.manifest_state)
    return MF.fold(events)


_last_seq = 0


def _append_seq() -> int:
    """The place of an append in the log: the clock when it is appended (in
    10 ns), and later than any earlier append of this driver. A run that began
    first but appends last is last."""
    global _last_seq
    _last_seq = max(_last_seq + 1, time.time_ns() // 10)
    return _last_seq


def append_events(df: DataFrame, store: Store, run_seq: int, now: Column) -> None:
    """Append sparse manifest events, placed after all earlier appends;
    ``pipeline_run_id`` records the run (the clock part of ``run_seq``) unless
    the events set it themselves."""
    if "pipeline_run_id" not in df.columns:
        df = df.withColumn("pipeline_run_id", F.lit(str(run_seq // 100)))
    # rebalance: AQE sizes the output (one small file for a typical run,
    # several for a big one) instead of one file per upstream task.
    ev = MF.as_events(df, F.lit(_append_seq()), now)
    (ev.withColumn("event_day", F.to_date("event_at")).hint("rebalance")
     .write.mode("append").partitionBy("event_day").parquet(store.manifest_events))


def event_seq(now: _dt.datetime, step: int = 0) -> int:
    """Names a run (or a single-upload call) and its step: the clock in
    microseconds, then the step."""
    return int(now.timestamp() * 1_000_000) * 100 + step


def _run(store: Store, now: _dt.datetime) -> tuple[Column, int, str]:
    run_seq = event_seq(now) // 100
    return F.lit(now), run_seq, store.run_dir(run_seq)


def upload_id_for(path: Column, file_hash: Column) -> Column:
    """Deterministic upload id: a retried registration yields the same id."""
    return F.substring(F.sha2(F.concat_ws(":", path, file_hash), 256), 1, 32)


def _paths(spark: SparkSession, df: DataFrame, col: str = "stored_file_path") -> list[str]:
    """Paths of queued uploads that still exist (bounded by the queue: file
    names, never contents); a vanished file is reported by the change check.
    Existence comes from one listing per parent folder, not one call per file."""
    wanted = [r[0] for r in df.select(col).distinct().collect()]
    by_parent: dict[str, list[str]] = {}
    for p in wanted:
        by_parent.setdefault(p.rsplit("/", 1)[0], []).append(p)
    out = []
    for parent, paths in by_parent.items():
        fs, hparent = LD._fs_path(spark, parent)
        if not fs.exists(hparent):
            continue
        present = {fs.makeQualified(st.getPath()).toString() for st in fs.listStatus(hparent) if st.isFile()}
        out += [p for p in paths if LD.qualify(spark, p) in present]
    return out


def _checked_files(spark: SparkSession, queue: DataFrame, changed_text: str, path: str, rehash: bool = False) -> DataFrame:
    """The queued uploads with the state of their files now (written to
    ``path``): file_path, file_state, file_violation (gone, changed) and
    read_error. Files that stand as they were registered are not read."""
    listed = LD.list_files(spark, _paths(spark, queue), glob=None).select(
        F.col("path").alias("stored_file_path"), "file_path", F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("modification_time"))
    files = LD.with_hashes(spark, listed, queue, rehash)
    return persist(spark, LD.change_check(queue, files, changed_text), path)


STRUCTURE_SCHEMA = "upload_id string, header array<string>, row_count long, violation string, multiline boolean, unreadable string"


def _structure(spark: SparkSession, checked: DataFrame) -> DataFrame:
    """header, row_count, violation, multiline and unreadable of the unchanged files of ``checked``, by upload."""
    sound = checked.where("file_state = 'UNCHANGED'").select("upload_id", "stored_file_path", "file_path", "file_size_bytes")
    listed = sound.select("stored_file_path", "file_size_bytes").distinct().collect()  # names of the queue's files
    if not listed:
        return spark.createDataFrame([], STRUCTURE_SCHEMA)
    paths = [r[0] for r in listed if r[1]]
    files = sound.select("stored_file_path", "file_path", "file_size_bytes").distinct()
    found = CSV.file_structure(spark, files, paths).select(
        "stored_file_path", "header", "row_count", "violation", "multiline", "unreadable")
    return sound.select("upload_id", "stored_file_path").join(found, "stored_file_path").drop("stored_file_path")


def _failed(uploads: DataFrame, status: str, error: Exception | Column) -> DataFrame:
    """Outcome rows of uploads whose stage raised ``error``, or whose own
    error is a column."""
    if isinstance(error, Exception):
        logger.error("Uploads end as %s: %s", status, error)
        error = F.lit(str(error))
    return uploads.select("upload_id", F.lit(status).alias("status"), cap_message(error).alias("validation_message"))


def _claim(spark, store, contracts, froms, to, label, now, seq, run_dir, only=None) -> tuple[DataFrame | None, DataFrame]:
    """Claim every eligible upload (or only the ids in ``only``) for a stage.
    Returns (claimed manifest rows or None without any, refusals with their messages)."""
    # The fold feeds the claim, the queue and the file check: fold once.
    m = persist(spark, current_manifest(spark, store), f"{run_dir}/manifest_{to.lower()}")
    candidates = m.where(F.col("dataset_name").isin(*contracts.keys()))
    if only is not None:
        candidates = candidates.where(F.col("upload_id").isin(*only))
    decided = MF.claim(candidates, froms, to, label, now)
    refused = decided.where(~F.col("claimed"))
    claimed = decided.where("claimed").select("upload_id")
    if claimed.isEmpty():
        return None, refused
    run_claims = persist(spark, m.join(claimed, "upload_id", "left_semi"), f"{run_dir}/claim_{to.lower()}")
    append_events(run_claims.select("upload_id", F.lit(to).alias("status")), store, seq, now)
    return run_claims, refused


def _no_outcomes(spark: SparkSession) -> DataFrame:
    """The outcomes of a stage that had nothing to do."""
    return spark.createDataFrame([], "upload_id string, status string, validation_message string")


def register_stage(spark: SparkSession, store: Store, contracts: Mapping[str, Contract], inv: DataFrame,
                   now_c: Column, run_dir: str, seq: int, rehash: bool = False) -> DataFrame:
    """Registration decisions for every inventoried file; NEW and DUPLICATE
    files become manifest rows (events). Returns the decisions.

    Files whose path, size and modification time a registered upload has are
    known unread; ``rehash`` reads them all the same."""
    listed = persist(spark, inv, f"{run_dir}/listing")
    m = persist(spark, current_manifest(spark, store).select(
        "upload_id", "dataset_name", "stored_file_path", "file_hash", "file_size_bytes", "file_modified_at", "created_at"),
        f"{run_dir}/registered")
    inv = LD.with_hashes(spark, listed, m, rehash)
    inv = inv.withColumn("upload_id", upload_id_for(F.col("stored_file_path"), F.col("file_hash")))
    # The decision plan reads the inventory on several branches; writing it
    # once (one row per file) keeps the landing bytes read and hashed once.
    inv = persist(spark, inv, f"{run_dir}/inventory")
    meta = [c for c in ("source_system", "reporting_period", "metadata_error") if c in inv.columns]
    decisions = MF.register_decisions(
        inv.select("dataset_name", "stored_file_path", "file_hash", "file_size_bytes", "upload_id",
                   "modification_time", "read_error", *meta),
        m, contracts.keys(),
    )
    decisions = persist(spark, decisions, f"{run_dir}/register")
    if not decisions.where(F.col("action").isin("NEW", "DUPLICATE")).isEmpty():
        append_events(MF.registration_events(decisions, now_c), store, seq, now_c)
    return decisions


def validate_stage(spark: SparkSession, store: Store, contracts: Mapping[str, Contract], now_c: Column,
                   run_dir: str, seq: int, only: list[str] | None = None,
                   rehash: bool = False) -> tuple[DataFrame, DataFrame]:
    """Claim, re-check, probe and judge every claimable upload (or ``only``).
    Returns (validation outcomes, claim refusals)."""
    queue, refused = _claim(spark, store, contracts, S.CLAIMABLE_FOR_VALIDATION, S.VALIDATING, "validated",
                            now_c, seq, run_dir, only)
    if queue is None:
        return _no_outcomes(spark), refused
    try:
        checked = _checked_files(
            spark, queue.select("upload_id", "dataset_name", "stored_file_path", "file_hash", "file_size_bytes", "file_modified_at", "created_at"),
            " has changed since it was registered. Register the new version as a new upload.", f"{run_dir}/validate_files", rehash)
        probed = checked.join(_structure(spark, checked), "upload_id", "left")
        probed = persist(spark, probed.select(
            "upload_id", "dataset_name",
            F.coalesce(F.col("header"), F.array().cast("array<string>")).alias("header"),
            "row_count", "multiline",
            F.coalesce(F.col("file_violation"), F.col("violation")).alias("violation"),
            F.coalesce(F.col("read_error"), F.col("unreadable")).alias("unreadable"),
        ), f"{run_dir}/probe")
        judged = V.validation_outcome(V.check_columns(probed.where("unreadable IS NULL").drop("unreadable"), contracts_frame(spark, contracts)))
        # a file that cannot be read fails by itself: it is claimed again in a later run
        unread = _failed(probed.where("unreadable IS NOT NULL"), S.FAILED, F.col("unreadable"))
        validated = persist(spark, judged.unionByName(unread, allowMissingColumns=True), f"{run_dir}/validate")
    except Exception as error:  # the claimed uploads fail with its message; the run goes on
        validated = persist(spark, _failed(queue, S.FAILED, error), f"{run_dir}/validate")
    append_events(validated.drop("dataset_name", "header", "multiline", "known_dataset", "reject_unexpected"),
                  store, seq + 1, now_c)
    return validated, refused


def bronze_stage(spark: SparkSession, store: Store, contracts: Mapping[str, Contract], now_c: Column,
                 run_dir: str, seq: int, only: list[str] | None = None, rehash: bool = False,
                 validated: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Claim, re-check, scan, gate and publish every loadable upload (or
    ``only``). Returns (bronze outcomes, claim refusals). Headers of uploads
    that this run validated come from ``validated``."""
    queue, refused = _claim(spark, store, contracts, S.CLAIMABLE_FOR_BRONZE, S.PROCESSING, "loaded to bronze",
                            now_c, seq, run_dir, only)
    if queue is None:
        return _no_outcomes(spark), refused
    try:
        checked = _checked_files(
            spark, queue.select("upload_id", "dataset_name", "stored_file_path", "file_hash", "file_size_bytes", "file_modified_at", "created_at",
                                "original_file_name", "source_row_count"),
            " has changed since it was validated. Register the new version as a new upload.", f"{run_dir}/bronze_files", rehash)
        seen = spark.createDataFrame([], "upload_id string, header array<string>, multiline boolean")
        if validated is not None and "header" in validated.columns:
            seen = validated.where(F.col("status") == S.VALIDATED).select("upload_id", "header", "multiline")
        fresh = _structure(spark, checked.join(seen, "upload_id", "left_anti"))
        structure = fresh.unionByName(seen, allowMissingColumns=True)
        probed = checked.join(structure.drop("row_count"), "upload_id", "left").withColumn(
            "violation", F.coalesce(F.col("file_violation"), F.col("violation"))).withColumn(
            "unreadable", F.coalesce(F.col("read_error"), F.col("unreadable")))
        probed = persist(spark, probed, f"{run_dir}/bronze_queue")
    except Exception as error:
        results = persist(spark, _failed(queue, S.BRONZE_FAILED, error), f"{run_dir}/bronze")
        append_events(results, store, seq + 1, now_c)
        return results, refused
    # A file-level problem (gone, changed, not CSV) rejects with its own message; a file that cannot be read fails.
    failures = [_failed(probed.where("unreadable IS NOT NULL"), S.BRONZE_FAILED, F.col("unreadable"))]
    bad = probed.where("unreadable IS NULL AND violation IS NOT NULL")
    ok = probed.where("unreadable IS NULL AND violation IS NULL")
    outcomes = [bad.select("upload_id", F.lit(0).alias("row_count"), F.lit(0).alias("corrupt_row_count"),
                           F.lit(False).alias("accepted"), F.col("violation").alias("message"),
                           "source_row_count", F.lit("").alias("_table"))]
    loads = 0

    def load(dataset: str, uploads: list[str]) -> None:
        """Load the uploads together. If that fails, by halves: the uploads at
        fault fail with their error, the others are loaded."""
        nonlocal loads
        loads += 1
        files = ok.where(F.col("upload_id").isin(uploads))
        try:
            gated = BR.load_uploads(
                spark,
                files.select("upload_id", "stored_file_path", "file_path",
                             F.col("original_file_name").alias("source_file_name"), "header", "multiline"),
                store.bronze(dataset), f"{run_dir}/staging/{dataset}-{loads}", now_c,
            )
        except Exception as error:
            if len(uploads) == 1:
                failures.append(_failed(files, S.BRONZE_FAILED, error))
                return
            logger.exception("Loading %d uploads of %s failed; they are loaded by halves", len(uploads), dataset)
            half = len(uploads) // 2
            load(dataset, uploads[:half])
            load(dataset, uploads[half:])
            return
        outcomes.append(gated.join(files.select("upload_id", "source_row_count"), "upload_id", "left")
                        .select("*", F.lit(store.bronze(dataset)).alias("_table")))

    by_dataset: dict[str, list[str]] = {}
    for r in ok.select("dataset_name", "upload_id").orderBy("dataset_name", "upload_id").collect():  # ids of the queue
        by_dataset.setdefault(r["dataset_name"], []).append(r["upload_id"])
    for dataset, uploads in by_dataset.items():
        load(dataset, uploads)
    all_gated = BR.union_shapes(outcomes)
    results = BR.outcome(all_gated.drop("source_row_count"), F.col("_table"), now_c,
                         all_gated.select("upload_id", "source_row_count"))
    results = persist(spark, BR.union_shapes([results, *failures]), f"{run_dir}/bronze")
    append_events(results.drop("source_row_count"), store, seq + 1, now_c)
    return results, refused


def run_uploads(
    spark: SparkSession,
    store: Store,
    contracts: Mapping[str, Contract],
    dataset_dirs: Mapping[str, str],
    now: _dt.datetime,
    min_age_seconds: int = LD.MIN_FILE_AGE_SECONDS,
    inventory: DataFrame | None = None,
    rehash: bool = False,
) -> dict:
    """One upload run: release stale claims, register, validate, load bronze.

    ``inventory`` (optional) replaces the landing scan, e.g. with the files a
    streaming micro-batch discovered. ``rehash``: read and hash every file at
    every stage, even if its size and time are as registered."""
    now_c, run_seq, run_dir = _run(store, now)

    # 0. Stale claims back to their failed status.
    released = MF.release_stale(current_manifest(spark, store), now_c)
    released = persist(spark, released, f"{run_dir}/released")
    n_released = released.count()
    if n_released:
        append_events(released.select("upload_id", F.col("new_status").alias("status"), "validation_message"),
                      store, run_seq * 100, now_c)

    # 1-3. Register every landing file, validate and load everything claimable.
    inv = inventory if inventory is not None else LD.inventory(spark, dataset_dirs, now_c, min_age_seconds)
    decisions = register_stage(spark, store, contracts, inv, now_c, run_dir, run_seq * 100 + 1, rehash)
    validated, _ = validate_stage(spark, store, contracts, now_c, run_dir, run_seq * 100 + 2, rehash=rehash)
    results, _ = bronze_stage(spark, store, contracts, now_c, run_dir, run_seq * 100 + 4, rehash=rehash, validated=validated)

    # Uploads waiting for validation whose dataset has no contract (any more)
    # stay as they are; they are reported, and counted as errors, every run.
    # (no stage of this run moves them: the manifest that validation read has them)
    waiting = spark.read.schema(MF.MANIFEST_SCHEMA).parquet(f"{run_dir}/manifest_{S.VALIDATING.lower()}")
    unknown = waiting.where(
        F.col("status").isin(*S.CLAIMABLE_FOR_VALIDATION) & ~F.col("dataset_name").isin(*contracts.keys())
    ).count()
    if unknown:
        logger.warning("%d uploads wait for validation but their dataset has no contract", unknown)

    # Summary from what this run wrote (small aggregates).
    acts = {r["action"]: r["count"] for r in decisions.groupBy("action").count().collect()}
    v = {r["status"]: r["count"] for r in validated.groupBy("status").count().collect()}
    b = {r["status"]: r["count"] for r in results.groupBy("status").count().collect()}
    summary = {
        "files_seen": sum(acts.values()),
        "registered": acts.get("NEW", 0) + acts.get("DUPLICATE", 0),
        "duplicates": acts.get("DUPLICATE", 0),
        "validated": v.get(S.VALIDATED, 0),
        "rejected": v.get(S.REJECTED, 0) + b.get(S.BRONZE_REJECTED, 0),
        "loaded": b.get(S.PROCESSED, 0),
        "released": n_released,
        "unknown_dataset": unknown,
        "errors": acts.get("CHANGED", 0) + acts.get("UNKNOWN_DATASET", 0) + acts.get("INVALID_METADATA", 0)
        + acts.get("UNREADABLE", 0) + unknown + v.get(S.FAILED, 0) + b.get(S.BRONZE_FAILED, 0),
    }
    logger.info("Upload run %s complete: %s", run_seq, summary)
    return summary


# ---------------------------------------------------------- one upload ----
# The same stages restricted to one file / upload id, for callers that work
# upload by upload. Refusals raise, as a single-item API should.


def get_status(spark: SparkSession, store: Store, upload_id: str) -> str | None:
    rows = MF.lookup(current_manifest(spark, store),
                     spark.createDataFrame([(upload_id,)], "upload_id string")).collect()
    return rows[0]["status"] if rows else None


def _known_or_raise(spark: SparkSession, store: Store, upload_id: str) -> None:
    r = MF.lookup(current_manifest(spark, store), spark.createDataFrame([(upload_id,)], "upload_id string")).first()
    if not r["known"]:
        raise ValueError(r["message"])


def register_uploaded_file(
    spark: SparkSession, store: Store, contracts: Mapping[str, Contract], dataset_dirs: Mapping[str, str],
    file_path: str, dataset_name: str, now: _dt.datetime,
    source_system: str | None = None, reporting_period: str | None = None,
    known_source_systems: tuple[str, ...] = (),
) -> str:
    """Register one landing file; returns its upload id (the existing one
    for an identical re-registration). Raises for an unknown dataset, a file
    outside its dataset folder, invalid metadata or changed contents."""
    from sluice.functions.columns import clean_upper, metadata_error

    dataset = dataset_name.strip().lower()
    if dataset not in dataset_dirs or dataset not in contracts:
        raise ValueError(f"Unknown dataset '{dataset}'. Expected one of: {list(dataset_dirs)}")
    folder = LD.qualify(spark, dataset_dirs[dataset])
    path = LD.qualify(spark, file_path)
    if not path.startswith(folder + "/"):
        raise ValueError(f"The file for dataset '{dataset}' must be inside '{dataset_dirs[dataset]}'. Got: {path}")
    fs, hpath = LD._fs_path(spark, path)
    if not fs.exists(hpath):
        raise FileNotFoundError(f"File does not exist: {path}")
    if not fs.getFileStatus(hpath).isFile():
        raise ValueError(f"The supplied path is not a file: {path}")
    now_c, run_seq, run_dir = _run(store, now)
    listed = LD.list_files(spark, [path], glob=None)
    inv = LD.inventory_from(listed, {dataset: path.rsplit("/", 1)[0]}, now_c, min_age_seconds=0)
    inv = inv.select(
        "*",
        clean_upper(F.lit(source_system).cast("string")).alias("source_system"),
        clean_upper(F.lit(reporting_period).cast("string")).alias("reporting_period"),
    )
    inv = inv.withColumn("metadata_error", metadata_error(F.col("reporting_period"), F.col("source_system"),
                                                          tuple(known_source_systems)))
    d = register_stage(spark, store, {dataset: contracts[dataset]}, inv, now_c, run_dir, run_seq * 100 + 1).first()
    if d["action"] in ("KNOWN", "NEW", "DUPLICATE"):
        return d["result_upload_id"]
    raise ValueError(d["message"])


def _single_stage(stage, spark, store, contracts, upload_id, now) -> dict:
    _known_or_raise(spark, store, upload_id)
    now_c, run_seq, run_dir = _run(store, now)
    step = 4 if stage is bronze_stage else 2  # as in a run: later stages have later steps
    out, refused = stage(spark, store, contracts, now_c, run_dir, run_seq * 100 + step, only=[upload_id])
    r = refused.first()
    if r is not None:
        raise ValueError(r["message"])
    row = out.where(F.col("upload_id") == upload_id).first()
    if row is None:  # known and not refused: no contract covers it
        raise ValueError(f"The dataset of upload {upload_id} has no contract. Expected one of: {list(contracts)}")
    return row.asDict()


def validate_registered_upload(spark: SparkSession, store: Store, contracts: Mapping[str, Contract],
                               upload_id: str, now: _dt.datetime) -> dict:
    """Validate one upload; raises if it is unknown or not claimable."""
    return _single_stage(validate_stage, spark, store, contracts, upload_id, now)


def load_upload_to_bronze(spark: SparkSession, store: Store, contracts: Mapping[str, Contract],
                          upload_id: str, now: _dt.datetime) -> dict:
    """Load one validated upload; raises if it is unknown or not claimable."""
    return _single_stage(bronze_stage, spark, store, contracts, upload_id, now)


def processed_uploads(spark: SparkSession, store: Store) -> DataFrame:
    return current_manifest(spark, store).where(F.col("status") == S.PROCESSED).select("upload_id", "dataset_name")


def read_bronze(spark: SparkSession, store: Store, dataset: str, uploads: list[str] | None = None) -> DataFrame:
    """Bronze rows of PROCESSED uploads only (rows of an unrecorded or
    rejected attempt are never visible); the id list is bounded by uploads.
    ``uploads``: of these uploads, whose folders alone are listed and read."""
    path = store.bronze(dataset)
    if uploads is not None:
        folders = [f"{path}/upload_id={u}" for u in uploads]
        return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*folders)
    bronze = spark.read.option("mergeSchema", "true").parquet(path)
    done = processed_uploads(spark, store).where(F.col("dataset_name") == dataset).select("upload_id")
    return bronze.join(bounded_broadcast(done), "upload_id", "left_semi")


def _silver_changes(spark: SparkSession, store: Store, dataset: str, contract: Contract,
                    processed: DataFrame) -> tuple[list[str], bool]:
    """The PROCESSED uploads that the last build has not seen, and whether the
    table must be built from all of them: there is none yet, its contract was
    another one, or an upload that it holds is not PROCESSED any more."""
    if not (_exists(spark, store.silver_seen(dataset)) and table_exists(spark, store, store.silver(dataset))):
        return [], True
    current = processed.where(F.col("dataset_name") == dataset).select("upload_id", F.lit(str(contract)).alias("contract"))
    seen = spark.read.schema("upload_id string, contract string").parquet(store.silver_seen(dataset)).withColumn("_seen", F.lit(True))
    both = current.withColumn("_current", F.lit(True)).join(seen, ["upload_id", "contract"], "full_outer")
    changed = both.where("_seen IS NULL OR _current IS NULL").select("upload_id", "_seen").collect()  # of the change only
    return [r["upload_id"] for r in changed if not r["_seen"]], any(r["_seen"] for r in changed)


def _silver_counts(metrics: dict, before: int, after: int) -> dict:
    return {
        "bronze_rows": metrics["bronze_rows"],
        "dropped_corrupt_or_keyless": metrics["bronze_rows"] - metrics["keyed_rows"],
        "deduplicated_away": before + metrics["keyed_rows"] - after,
        "silver_rows": after,
    }


def _build_silver(spark: SparkSession, store: Store, dataset: str, contract: Contract, now: _dt.datetime,
                  new: list[str], full: bool) -> dict:
    """Build one dataset's silver table from all its uploads, or add the new
    ones to it; either way the table is replaced whole."""
    before = 0
    obs = Observation(f"silver_{dataset}_{_append_seq()}")
    if full:
        silver = SV.build_silver(read_bronze(spark, store, dataset), contract, F.lit(now), observation=obs, dataset=dataset)
    else:
        old = read_table(spark, store, store.silver(dataset))
        before = old.count()
        added = SV.build_silver(read_bronze(spark, store, dataset, new), contract, F.lit(now), observation=obs, dataset=dataset)
        silver = SV.merge_silver(old, added, contract, F.lit(now))
    rows = replace_table(spark, silver, store.silver(dataset), store.view(store.silver(dataset))).count()
    return {"dataset": dataset, "incremental": not full, **_silver_counts(obs.get, before, rows)}


def run_silver(
    spark: SparkSession,
    store: Store,
    contracts: Mapping[str, Contract],
    now: _dt.datetime,
    force: bool = False,
) -> list[dict]:
    """Bring each dataset's silver table up to date; skip unchanged ones; a
    failing dataset is recorded and the rest continue.

    What changed is told by upload ids: uploads that the manifest calls
    PROCESSED against those of the last build. New uploads are added to the
    table (only their rows are read); ``force``, a lost upload or another
    contract builds it from all uploads. Counters are of the rows read."""
    out = []
    processed = persist(spark, processed_uploads(spark, store), f"{store.run_dir(event_seq(now) // 100)}/processed")
    for dataset, contract in contracts.items():
        try:
            if not _exists(spark, store.bronze(dataset)):
                raise ValueError(f"Bronze table for '{dataset}' does not exist: {store.bronze(dataset)}")
            new, full = _silver_changes(spark, store, dataset, contract, processed)
            if not (force or full or new):
                out.append({"dataset": dataset, "skipped": True})
                continue
            counts = _build_silver(spark, store, dataset, contract, now, new, force or full)
            seen = processed.where(F.col("dataset_name") == dataset).select("upload_id", F.lit(str(contract)).alias("contract"))
            seen.coalesce(1).write.mode("overwrite").parquet(store.silver_seen(dataset))
            out.append(counts)
        except Exception as error:  # isolate datasets from each other
            logger.exception("Silver build failed for %s", dataset)
            out.append({"dataset": dataset, "error": str(error)[:500]})
    return out


def run_links(spark: SparkSession, store: Store, now: _dt.datetime) -> list[dict]:
    """Build the application-project link table from silver."""
    try:
        mapping, apps, projects = (
            read_table(spark, store, store.silver(d)) for d in ("application_project_map", "applications", "projects"))
        link = L.application_project_link(mapping, apps, projects, F.lit(now))
        counts = L.reference_summary(replace_table(
            spark, link, store.link("application_project"), store.view(store.link("application_project"))))
        return [{"name": "application_project", "status": "built", **counts}]
    except Exception as error:
        return [{"name": "application_project", "status": "error", "error": str(error)[:500]}]


def run(spark: SparkSession, store: Store, contracts: Mapping[str, Contract],
        dataset_dirs: Mapping[str, str], now: _dt.datetime, force: bool = False) -> dict:
    """Scheduled entry: all stages, then raise if anything failed."""
    try:
        uploads = run_uploads(spark, store, contracts, dataset_dirs, now)
    except Exception as error:  # silver and links still run on what is there
        logger.exception("Upload run failed")
        uploads = {"errors": 1, "error": str(error)[:500]}
    summary = {
        "uploads": uploads,
        "silver": run_silver(spark, store, contracts, now, force),
        "links": run_links(spark, store, now),
    }
    failed = [s for s in summary["silver"] if "error" in s] + [s for s in summary["links"] if "error" in s]
    if summary["uploads"]["errors"] or failed:
        raise RuntimeError(f"Pipeline run finished with errors: {summary}")
    return summary


def create_silver_tables(spark: SparkSession, store: Store, contracts: Mapping[str, Contract]) -> list[str]:
    """Set-up step: an empty silver table per dataset, typed by its contract
    (existing tables are left alone)."""
    made = []
    for dataset, contract in contracts.items():
        path = store.silver(dataset)
        if not table_exists(spark, store, path):
            replace_table(spark, spark.createDataFrame([], contract.silver_schema()), path, store.view(path))
            made.append(dataset)
    return made
