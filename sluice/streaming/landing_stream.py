"""Incremental discovery of landing files with Structured Streaming.

A file stream over the dataset folders (``binaryFile`` rows without their content) run with
``trigger(availableNow=True)``: each micro-batch holds the files that
appeared since the last checkpoint, and ``foreachBatch`` runs the ordinary
upload stages with that batch as the inventory. The stream only decides
*which files are new by path*; content-hash duplicates, changed files and
the status lifecycle still come from the manifest join, exactly as in a
batch run. The checkpoint lives in the shared store, so a lost driver
resumes where it stopped.

Spark's file source plans no split for a zero-byte file, so empty uploads
that are not registered yet are taken from a listing at each call.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.contracts import Contract
from sluice.plans import batch
from sluice.sources import landing as LD

# The binaryFile source's fixed columns (a stream needs them up front).
BINARY_FILE_SCHEMA = (
    "path string, modificationTime timestamp, length bigint, content binary"
)


def landing_stream(spark: SparkSession, dataset_dirs: Mapping[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """Streaming DataFrame of new landing CSVs (all dataset folders)."""
    dirs = LD.existing_dirs(spark, dataset_dirs)
    streams = [
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", LD.CSV_GLOB)
        .option("recursiveFileLookup", "false")
        .option("maxFileAge", "36500d")  # a file copied with an old time is new all the same
        .load(d)
        .select("path", F.col("_metadata.file_path").alias("file_path"), "length", "modificationTime")
        for d in dirs.values()
    ]
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out, dirs


def run_available(
    spark: SparkSession,
    store: batch.Store,
    contracts: Mapping[str, Contract],
    dataset_dirs: Mapping[str, str],
    clock: Callable[[], _dt.datetime] | None = None,
    checkpoint: str | None = None,
    min_age_seconds: int = LD.MIN_FILE_AGE_SECONDS,
) -> list[dict]:
    """Process every file available now, micro-batch by micro-batch, then stop.
    Returns the run summaries of the batches.

    A stream sees a path once, but a file touched less than ``min_age_seconds``
    ago may still be uploading: its path is noted in the store, and each call
    first reads the noted files that are old enough by then and not registered."""
    if not LD.existing_dirs(spark, dataset_dirs):
        return []  # nothing to watch yet
    stream, dirs = landing_stream(spark, dataset_dirs)
    summaries: list[dict] = []
    now_fn = clock or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))

    noted = f"{store.root}/_stream_waiting"
    gate = F.make_dt_interval(secs=F.lit(min_age_seconds))

    waiting = LD.empty_files(spark, list(dirs.values())).select("path")
    if batch._exists(spark, noted):
        waiting = waiting.unionByName(spark.read.schema("path string").parquet(noted)).distinct()
    known = batch.current_manifest(spark, store).select(F.col("stored_file_path").alias("path"))
    paths = batch._paths(spark, waiting.join(known, "path", "left_anti"), "path")  # file names still waiting, never contents
    if paths:
        now = now_fn()
        inv = LD.inventory_from(LD.list_files(spark, paths, glob=None), dirs, F.lit(now), min_age_seconds)
        summaries.append(batch.run_uploads(spark, store, contracts, dataset_dirs, now, inventory=inv))

    def handle(batch_df: DataFrame, epoch_id: int) -> None:
        now = now_fn()
        young = batch_df.where(F.col("modificationTime") > F.lit(now) - gate).select("path")
        young.write.mode("append").parquet(noted)
        inv = LD.inventory_from(batch_df, dirs, F.lit(now), min_age_seconds)
        summaries.append(batch.run_uploads(spark, store, contracts, dataset_dirs, now, inventory=inv))

    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint or f"{store.root}/_checkpoints/landing")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return summaries
