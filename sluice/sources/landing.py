"""Landing inventory: every CSV in the per-dataset landing folders, with size
and modification time, and the content hash of the files that need one.

A listing reads no bytes. Files are hashed in executor tasks: those up to
``WHOLE_FILE_BYTES`` by Spark's ``binaryFile`` scan, larger ones in chunks
carried through one SHA-256, so no size is too large and no task holds more
than one small file. A file that cannot be read gets an error, not its run.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterable, Iterator, Mapping
from urllib.parse import unquote, urlsplit

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.hashing import hash_in_chunks

logger = logging.getLogger(__name__)

# Fixed value: files touched more recently than this may still be uploading.
MIN_FILE_AGE_SECONDS = 60
CSV_GLOB = "*.[cC][sS][vV]"

# Files above this many bytes are hashed in chunks.
WHOLE_FILE_BYTES = 64 << 20
# Fixed value: what one cell of a table can hold.
_LARGEST_CELL = 2**31 - 1

LISTING_SCHEMA = "path string, file_path string, length long, modificationTime timestamp"
INVENTORY_SCHEMA = T.StructType([
    T.StructField("dataset_name", T.StringType()),
    T.StructField("stored_file_path", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("original_file_name", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
])


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of a folder (``file:/...``, ``s3a://...``)."""
    fs, hpath = _fs_path(spark, path)
    return fs.makeQualified(hpath).toString().rstrip("/")


def existing_dirs(spark: SparkSession, dataset_dirs: Mapping[str, str]) -> dict[str, str]:
    """Configured folders that exist (a missing one is skipped, not fatal)."""
    out = {}
    for name, d in dataset_dirs.items():
        fs, hpath = _fs_path(spark, d)
        if fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory():
            out[name] = qualify(spark, d)
        else:
            logger.warning("Landing directory missing: %s", d)
    return out


def empty_files(spark: SparkSession, locations: list[str], glob: str | None = CSV_GLOB) -> DataFrame:
    """Zero-byte files under ``locations`` (folders or files).

    Spark's file scans plan no split for an empty file, so ``binaryFile`` never
    returns one; an empty upload must still be registered and then rejected.
    Found by a metadata listing (driver side, like every file listing), and
    only the empty ones become rows.
    """
    import fnmatch

    rows = []
    for loc in locations:
        fs, hpath = _fs_path(spark, loc)
        if not fs.exists(hpath):
            continue
        for st in fs.listStatus(hpath):
            name = st.getPath().getName()
            if not st.isFile() or st.getLen() != 0 or name.startswith(("_", ".")):
                continue
            if glob and not fnmatch.fnmatchcase(name, glob):
                continue
            qualified = fs.makeQualified(st.getPath())
            rows.append((qualified.toString(), qualified.toUri().toString(), st.getModificationTime()))
    df = spark.createDataFrame(rows, "path string, file_path string, mtime_ms long")
    return df.select(
        "path", "file_path",
        F.lit(0).cast("long").alias("length"),
        F.timestamp_millis("mtime_ms").alias("modificationTime"),
    )


def list_files(spark: SparkSession, locations: list[str], glob: str | None = CSV_GLOB) -> DataFrame:
    """Rows (path, file_path, length, modificationTime) of every matching
    file, empty files included. No file is opened: the scan's content column
    is left out."""
    if not locations:
        return spark.createDataFrame([], LISTING_SCHEMA)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "false").option("ignoreMissingFiles", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(locations).select(
        "path", F.col("_metadata.file_path").alias("file_path"), "length", "modificationTime")
    return listed.where("length > 0").unionByName(empty_files(spark, locations, glob))


def inventory(
    spark: SparkSession,
    dataset_dirs: Mapping[str, str],
    now: Column | None = None,
    min_age_seconds: int = MIN_FILE_AGE_SECONDS,
) -> DataFrame:
    """One row per landing CSV: dataset, path, size and modification time.

    Non-recursive (files directly in each dataset folder), case-insensitive
    ``.csv`` suffix, files younger than ``min_age_seconds`` skipped. The
    dataset comes from the folder the file sits in, compared folder by folder
    (``projects_old`` is not inside ``projects``). ``file_path`` is the
    reader's percent-encoded form, the join key for lineage.
    """
    dirs = existing_dirs(spark, dataset_dirs)
    if not dirs:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    return inventory_from(list_files(spark, list(dirs.values())), dirs, now, min_age_seconds)


def inventory_from(listed: DataFrame, dirs: Mapping[str, str], now: Column | None = None,
                   min_age_seconds: int = MIN_FILE_AGE_SECONDS) -> DataFrame:
    """Inventory columns from listed files (batch or stream batch);
    ``dirs`` maps dataset -> qualified folder."""
    parent = F.regexp_extract(F.col("path"), r"^(.*)/[^/]+$", 1)
    folder_map = F.create_map(*[x for name, d in dirs.items() for x in (F.lit(d), F.lit(name))])
    out = listed.select(
        F.try_element_at(folder_map, parent).alias("dataset_name"),
        F.col("path").alias("stored_file_path"),
        F.col("file_path"),
        F.element_at(F.split(F.col("path"), "/"), -1).alias("original_file_name"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("modification_time"),
    ).where(F.col("dataset_name").isNotNull())
    if min_age_seconds and min_age_seconds > 0:
        ts = now if now is not None else F.current_timestamp()
        out = out.where(F.col("modification_time") <= ts - F.make_dt_interval(secs=F.lit(min_age_seconds)))
    return out


def hash_files(spark: SparkSession, files: DataFrame, whole: int = WHOLE_FILE_BYTES) -> DataFrame:
    """``files`` (stored_file_path, file_path, file_size_bytes, ...) with
    file_hash and read_error, exactly one of them set. Files that have a
    file_hash already keep it, unread.

    The paths of the files to hash reach the driver (names, never contents).
    Files in a store that only Spark reads are hashed whole up to what a cell
    can hold; larger ones there need pyarrow to know the store.
    """
    if "file_hash" not in files.columns:
        files = files.withColumn("file_hash", F.lit(None).cast("string"))
    names = files.where("file_hash IS NULL").select("stored_file_path", "file_path", "file_size_bytes").collect()
    none = F.lit(None).cast("string")
    if not names:
        return files.withColumn("read_error", none)
    limit = {r["stored_file_path"]: whole if urlsplit(r["file_path"]).scheme in ("", "file") else _LARGEST_CELL for r in names}
    small = [r["stored_file_path"] for r in names if 0 < r["file_size_bytes"] <= limit[r["stored_file_path"]]]
    large = [(r["stored_file_path"], r["file_path"]) for r in names if r["file_size_bytes"] > limit[r["stored_file_path"]]]
    found = []
    if small:
        # a file that fails gives no row
        found.append(spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
                     .load(small).select("path", F.sha2("content", 256).alias("_hash"), none.alias("read_error")))
    if large:
        from sluice.plans.ship import ship_package

        ship_package(spark)
        listed = spark.createDataFrame(large, "path string, file_path string").repartition(len(large))
        found.append(listed.mapInArrow(hash_in_chunks, "path string, _hash string, read_error string"))
    if not found:
        found.append(spark.createDataFrame([], "path string, _hash string, read_error string"))
    hashed = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    out = files.join(hashed.withColumnRenamed("path", "stored_file_path"), "stored_file_path", "left")
    empty = F.when(F.col("file_size_bytes") == 0, F.sha2(F.lit(b""), 256))
    failed = F.concat(F.lit("The file could not be read: "), F.coalesce("read_error", F.lit("its bytes were not returned")), F.lit("."))
    return out.withColumn("file_hash", F.coalesce("file_hash", "_hash", empty)).drop("_hash").withColumn(
        "read_error", F.when(F.col("file_hash").isNull(), failed))


def with_hashes(spark: SparkSession, files: DataFrame, manifest: DataFrame, rehash: bool = False) -> DataFrame:
    """``files`` with file_hash and read_error. A file whose path, size and
    modification time a registered upload recorded keeps that upload's hash
    unread, unless ``rehash``."""
    if rehash:
        return hash_files(spark, files)
    known = manifest.where(F.col("file_modified_at").isNotNull()).select(
        "stored_file_path", "file_size_bytes", F.col("file_modified_at").alias("modification_time"),
        F.struct("created_at", "upload_id", "file_hash").alias("_upload"))
    keys = ["stored_file_path", "file_size_bytes", "modification_time"]
    first = known.groupBy(*keys).agg(F.min("_upload")["file_hash"].alias("file_hash"))
    return hash_files(spark, files.join(first, keys, "left"))


# What the change check hands on about a file.
_CARRIED = ("file_path", "header", "row_count", "violation", "multiline", "read_error")


def change_check(manifest: DataFrame, files: DataFrame, changed_text: str) -> DataFrame:
    """Registered file vs. what is on disk now, for the uploads in ``manifest``.

    Left join on the stored path: a path no longer present means the file is
    gone; a different hash means it changed since registration, none that it
    could not be read. Returns the manifest rows with ``file_violation`` (NULL
    when the file is unchanged or unreadable) and ``file_state``.
    """
    disk = files.select(
        F.col("stored_file_path").alias("_p"), F.col("file_hash").alias("_disk_hash"),
        *[c for c in files.columns if c in _CARRIED],
    )
    joined = manifest.join(disk, manifest["stored_file_path"] == disk["_p"], "left")
    path = F.col("stored_file_path")
    violation = (
        F.when(F.col("_p").isNull(),
               F.concat(F.lit("The registered file no longer exists at "), path, F.lit(".")))
        .when(F.col("_disk_hash") != F.col("file_hash"),
              F.concat(F.lit("The file at "), path, F.lit(changed_text)))
    )
    state = (
        F.when(F.col("_p").isNull(), F.lit("MISSING"))
        .when(F.col("_disk_hash").isNull(), F.lit("UNREADABLE"))
        .when(F.col("_disk_hash") != F.col("file_hash"), F.lit("CHANGED"))
        .otherwise(F.lit("UNCHANGED"))
    )
    return joined.select(*manifest.columns, *[c for c in _CARRIED if c in files.columns],
                         violation.alias("file_violation"), state.alias("file_state"))
