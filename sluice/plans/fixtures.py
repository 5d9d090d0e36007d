"""Uploaded-style inputs derived from the driver's tables.

The engine's operators work on uploads (text cells, lineage, status events,
header arrays). These builders turn the TPC-H-like tables into such inputs
with deterministic dirt, as Spark plans over the whole tables, so every
registered query's work grows with the data. ``sluice.plans.oracle`` holds
the same recipes as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.contracts import ColumnSpec, Contract


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is inferred once per path and passed on
    later reads, which skips the footer-reading job of schema inference (a
    fresh relation is still created per call; nothing is cached but the
    schema)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


# Contract of the "orders" dataset that bronze_orders feeds.
ORDERS_CONTRACT = Contract(
    key_columns=("order_code",),
    columns=(
        ColumnSpec("order_code", "string", True),
        ColumnSpec("order_date", "date", True),
        ColumnSpec("amount", "decimal(18,2)", True),
        ColumnSpec("customer_id", "integer"),
        ColumnSpec("priority", "string"),
    ),
)

U1_INGESTED = "2026-01-01 00:00:00"
U23_INGESTED = "2026-01-03 00:00:00"


def _mod(c: Column, m: int) -> Column:
    return (c % m) == 0


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of three uploads built from ``orders`` (one scan).

    u1 holds every order, u2 the orders with k % 3 = 0 (amount + 1), u3 those
    with k % 7 = 0 (amount + 2). u2 and u3 share ``ingested_at`` so the
    upload_id tie-break decides. Dirt per key k, first match wins:
    order_code blank (97), NULL (89), space-padded (5);
    order_date 'N/A' (13), unpadded d/M/yyyy (11), NULL (7), space-padded (29);
    amount 'N/A' (17), blank (19), NULL (23);
    customer_id fractional (43), prefixed (47);
    rows of u1 with k % 50 = 0 are corrupt.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    k = F.col("o_orderkey")
    uploads = F.array_compact(F.array(F.lit("u1"), F.when(_mod(k, 3), F.lit("u2")), F.when(_mod(k, 7), F.lit("u3"))))
    x = o.select("*", F.explode(uploads).alias("upload_id"))
    u = F.col("upload_id")
    add = F.when(u == "u2", F.lit(1)).when(u == "u3", F.lit(2)).otherwise(F.lit(0))
    ks = k.cast("string")
    d = F.col("o_orderdate")
    padded = F.date_format(d, "dd/MM/yyyy")
    return x.select(
        F.when(_mod(k, 97), F.lit("  "))
        .when(_mod(k, 89), F.lit(None).cast("string"))
        .when(_mod(k, 5), F.concat(F.lit(" O"), ks, F.lit(" ")))
        .otherwise(F.concat(F.lit("O"), ks))
        .alias("order_code"),
        F.when(_mod(k, 13), F.lit("N/A"))
        .when(_mod(k, 11), F.date_format(d, "d/M/yyyy"))
        .when(_mod(k, 7), F.lit(None).cast("string"))
        .when(_mod(k, 29), F.concat(F.lit(" "), padded, F.lit(" ")))
        .otherwise(padded)
        .alias("order_date"),
        F.when(_mod(k, 17), F.lit("N/A"))
        .when(_mod(k, 19), F.lit("  "))
        .when(_mod(k, 23), F.lit(None).cast("string"))
        .otherwise((F.col("o_totalprice").cast("decimal(18,2)") + add).cast("string"))
        .alias("amount"),
        F.when(_mod(k, 43), F.concat(F.col("o_custkey").cast("string"), F.lit(".5")))
        .when(_mod(k, 47), F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.col("o_orderpriority").alias("priority"),
        F.when((u == "u1") & _mod(k, 50), F.concat(F.lit("O"), ks, F.lit(",broken,row")))
        .alias("_corrupt_record"),
        u,
        F.concat(F.lit("orders_"), u, F.lit(".csv")).alias("source_file_name"),
        F.when(u == "u1", F.lit(U1_INGESTED)).otherwise(F.lit(U23_INGESTED)).cast("timestamp_ntz").alias("ingested_at"),
    )


def link_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mapping = distinct (order, part) pairs of lineitem; entities = orders
    without k % 10 = 0 and parts without k % 7 = 0, so orphans exist."""
    mapping = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("part_key"))
        .distinct()
    )
    orders = table(spark, sf_dir, "orders").where((F.col("o_orderkey") % 10) != 0).select("o_orderkey")
    parts = table(spark, sf_dir, "part").where((F.col("p_partkey") % 7) != 0).select("p_partkey")
    return mapping, orders, parts


# ------------------------------------------------------------ headers ----

# Contracts the unit tests of the reference use: a strict one that rejects
# unexpected columns and a lenient one that allows them.
_TEST_COLUMNS = (
    ColumnSpec("project_id", "string", True),
    ColumnSpec("project_name", "string", True),
    ColumnSpec("project_status", "string", True),
    ColumnSpec("start_date", "date"),
    ColumnSpec("end_date", "date"),
)
TEST_CONTRACTS = {
    "strict": Contract(("project_id",), _TEST_COLUMNS, reject_unexpected=True),
    "lenient": Contract(("project_id",), _TEST_COLUMNS, reject_unexpected=False),
}


def validation_contracts() -> dict[str, Contract]:
    from sluice.contracts import PRODUCTION_CONTRACTS

    return {**PRODUCTION_CONTRACTS, **TEST_CONTRACTS}


def drift_contracts() -> dict[str, Contract]:
    """Contracts after an edit: 'contracts' and 'strict' gained a required
    ``reviewed_by`` column that no uploaded file carries yet."""
    out = dict(validation_contracts())
    for name in ("contracts", "strict"):
        c = out[name]
        out[name] = Contract(c.key_columns, c.columns + (ColumnSpec("reviewed_by", "string", True),),
                             c.reject_unexpected)
    return out


HEADER_DATASETS = ("projects", "contracts", "applications", "application_project_map", "strict", "lenient")


def header_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload per customer, with a header derived from its dataset's
    contract and mutated by c_custkey: drop the 2nd name (k % 5), repeat the
    1st (k % 7), add ``extra_<k % 4>`` (k % 3), add a blank name (k % 13);
    then style it like a spreadsheet export: upper case with spaces (k even)
    or dots with padding (k % 9). ``header`` is the normalised form."""
    from sluice.functions.columns import normalise_name

    contracts = validation_contracts()
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    idx = (k % len(HEADER_DATASETS)).cast("int") + 1
    names = F.array(*[F.lit(n) for n in HEADER_DATASETS])
    bases = F.array(*[F.array(*[F.lit(s.name) for s in contracts[n].columns]) for n in HEADER_DATASETS])
    # One projection per step, so each step references a column instead of
    # repeating the previous step's expression tree.
    h = F.col("h")
    steps = [
        F.when(_mod(k, 5), F.concat(F.slice(h, 1, 1), F.slice(h, F.lit(3), F.size(h)))).otherwise(h),
        F.when(_mod(k, 7), F.concat(h, F.slice(h, 1, 1))).otherwise(h),
        F.when(_mod(k, 3), F.concat(h, F.array(F.concat(F.lit("extra_"), (k % 4).cast("string"))))).otherwise(h),
        F.when(_mod(k, 13), F.concat(h, F.array(F.lit("  ")))).otherwise(h),
    ]
    df = c.select("c_custkey", "c_nationkey", F.element_at(bases, idx).alias("h"), F.element_at(names, idx)
                  .alias("dataset_name"))
    for step in steps:
        df = df.select("c_custkey", "c_nationkey", "dataset_name", step.alias("h"))
    raw = (
        F.when(_mod(k, 2), F.transform(h, lambda x: F.upper(F.replace(x, F.lit("_"), F.lit(" ")))))
        .when(_mod(k, 9), F.transform(h, lambda x: F.concat(F.lit(" "), F.replace(x, F.lit("_"), F.lit(".")), F.lit(" "))))
        .otherwise(h)
    )
    df = df.select("c_custkey", "c_nationkey", "dataset_name", raw.alias("raw_header"))
    return df.select(
        k.alias("upload_id"),
        "dataset_name",
        "raw_header",
        F.transform("raw_header", normalise_name).alias("header"),
        (F.col("c_nationkey") + 1).cast("long").alias("row_count"),
    )


# ----------------------------------------------------------- manifest ----

# "now" of the manifest queries: just after the last event of the month.
MANIFEST_NOW = "2024-01-31 00:00:00"
# When the last silver build ran (it saw uploads PROCESSED before then).
LAST_BUILD_AT = "2024-01-20 00:00:00"


def manifest_now() -> Column:
    return F.lit(MANIFEST_NOW).cast("timestamp_ntz")
PRODUCTION_DATASETS = ("projects", "contracts", "applications", "application_project_map")


def manifest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as manifest status events: user = upload, event_id =
    sequence, ts = event time; event_type (and value) pick the status and the
    sparse columns that event sets."""
    from sluice.functions import status as S
    from sluice.operators.manifest import as_events

    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    v = F.col("value")
    eid = F.col("event_id")
    uid = F.col("user_id")
    status = (
        F.when(t == "signup", F.lit(S.RECEIVED))
        .when(t == "view", F.lit(S.VALIDATING))
        .when(t == "click", F.when(v < 100, F.lit(S.VALIDATED)).otherwise(F.lit(S.PROCESSING)))
        .when(t == "purchase", F.when(v < 100, F.lit(S.PROCESSED)).otherwise(F.lit(S.BRONZE_FAILED)))
        .when(t == "error", F.when(v < 50, F.lit(S.FAILED)).when(v < 100, F.lit(S.REJECTED))
              .when(v < 150, F.lit(S.BRONZE_REJECTED)).otherwise(F.lit(S.DUPLICATE)))
    )
    rows = F.floor(v).cast("long")
    empty = F.array().cast("array<string>")
    ds = F.element_at(F.array(*[F.lit(d) for d in PRODUCTION_DATASETS]), (uid % 4).cast("int") + 1)
    shaped = e.select(
        eid.alias("event_id"),
        F.col("ts"),
        F.concat(F.lit("U"), uid.cast("string")).alias("upload_id"),
        status.alias("status"),
        F.when(t == "signup", ds).alias("dataset_name"),
        F.when(t == "signup", F.concat(F.lit("file_"), uid.cast("string"), F.lit(".csv"))).alias("original_file_name"),
        F.when(t == "signup", F.concat(F.lit("user"), (uid % 7).cast("string"))).alias("uploaded_by"),
        F.when(t == "signup", F.col("ts")).alias("created_at"),
        F.when(t == "error", F.concat(F.lit("Failed: "), F.col("props")))
        .when(t == "purchase", F.concat(F.lit("Loaded "), rows.cast("string"), F.lit(" rows.")))
        .alias("validation_message"),
        F.when(t == "click", rows).alias("source_row_count"),
        F.when(t == "purchase", rows - eid % 2).alias("bronze_row_count"),
        F.when(t == "purchase", eid % 3).alias("bronze_corrupt_row_count"),
        F.when(t == "view", empty)
        .when(t == "click", F.array(F.concat(F.lit("col_"), (eid % 3).cast("string"))))
        .alias("missing_columns"),
        F.when((t == "click") & ((eid % 4) == 0), F.array(F.concat(F.lit("extra_"), (eid % 2).cast("string"))))
        .when(t == "click", empty)
        .alias("unexpected_columns"),
    )
    return as_events(shaped, F.col("event_id"), F.col("ts"), ts_type=T.TimestampNTZType())


def manifest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.operators.manifest import fold

    return fold(manifest_events(spark, sf_dir))


# ------------------------------------------------------ landing files ----

# Datasets with a contract in the document-upload scenario (lang = dataset).
DOC_DATASETS = ("en", "de", "fr")
# Allow-list of source systems in the document-upload scenario.
DOC_SOURCES = tuple(f"SRC{i}" for i in range(15))
REGISTERED_BASE = "2024-01-01 00:00:00"


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` read as landing files: one file per document, dataset =
    language (sometimes typed 'EN '), path under the dataset folder, content
    hash and byte size of the whole text, raw registration metadata."""
    from sluice.functions.columns import clean_upper, metadata_error, strip_whitespace

    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    year = (F.lit(2000) + F.col("n_chars") % 30).cast("string")
    q = (k % 6).cast("string")
    m = F.lpad((k % 14).cast("string"), 2, "0")
    period_raw = (
        F.when(_mod(k, 4), F.concat(F.lit(" "), year, F.lit("-q"), q))
        .when((k % 4) == 1, F.concat(year, F.lit("-"), m))
        .when((k % 4) == 2, F.concat(year, F.lit("Q"), q))
    )
    source_raw = F.when(_mod(k, 2), F.concat(F.lit(" "), F.col("source"), F.lit(" "))).otherwise(F.col("source"))
    dataset_raw = F.when(_mod(k, 11), F.concat(F.upper("lang"), F.lit(" "))).otherwise(F.col("lang"))
    path = F.concat(F.lit("/landing/"), F.col("lang"), F.lit("/doc_"), F.lpad(k.cast("string"), 6, "0"), F.lit(".csv"))
    files = d.select(
        k.alias("doc_id"),
        F.lower(strip_whitespace(dataset_raw)).alias("dataset_name"),
        path.alias("stored_file_path"),
        F.sha2(F.col("text"), 256).alias("file_hash"),
        F.octet_length("text").cast("long").alias("file_size_bytes"),
        F.col("text"),
        source_raw.alias("source_system_raw"),
        period_raw.alias("reporting_period_raw"),
    )
    files = files.select(
        "*",
        clean_upper("source_system_raw").alias("source_system"),
        clean_upper("reporting_period_raw").alias("reporting_period"),
    )
    return files.select(
        "*",
        F.substring(F.sha2(F.concat_ws(":", "stored_file_path", "file_hash"), 256), 1, 32).alias("upload_id"),
        metadata_error(F.col("reporting_period"), F.col("source_system"), DOC_SOURCES).alias("metadata_error"),
    )


def registered_manifest(files: DataFrame) -> DataFrame:
    """What an earlier run registered: documents with doc_id % 3 = 0 as they
    are now; doc_id % 5 = 0 (others) with older contents under the same path."""
    k = F.col("doc_id")
    prev = files.where(_mod(k, 3) | _mod(k, 5))
    return prev.select(
        F.concat(F.lit("R"), k.cast("string")).alias("upload_id"),
        "dataset_name",
        "stored_file_path",
        F.when(_mod(k, 3), F.col("file_hash"))
        .otherwise(F.sha2(F.concat(F.col("text"), F.lit("#v0")), 256)).alias("file_hash"),
        (F.lit(REGISTERED_BASE).cast("timestamp_ntz") + F.make_dt_interval(secs=k.cast("decimal(18,6)")))
        .alias("created_at"),
    )


# ----------------------------------------------------------- csv lines ----

LINE_HEADER = ("order_code", "order_status", "amount", "priority")


# Uploads per block of this many customer keys: a fixed rule, so the number of
# upload files - and the tasks that write and read them - grows with the data.
UPLOADS_PER_BLOCK = 8
CUSTOMERS_PER_BLOCK = 100_000


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as CSV records of uploads: eight (L0..L7 by k % 8) for each
    100,000 customer keys, the next eight numbered on. Blank line when
    k % 71 = 0; an extra field when k % 8 = 4 (those whole uploads are bad),
    k % 53 = 0, or k % 64 = 2 (~14 % of L2); a missing field when k % 61 = 0."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    fields = [
        F.concat(F.lit("O"), k.cast("string")),
        F.col("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.col("o_orderpriority"),
    ]
    line = (
        F.when(_mod(k, 71), F.lit(""))
        .when(((k % UPLOADS_PER_BLOCK) == 4) | _mod(k, 53) | ((k % 64) == 2), F.concat_ws(",", *fields, F.lit("extra")))
        .when(_mod(k, 61), F.concat_ws(",", *fields[:3]))
        .otherwise(F.concat_ws(",", *fields))
    )
    number = F.floor(F.col("o_custkey") / CUSTOMERS_PER_BLOCK) * UPLOADS_PER_BLOCK + k % UPLOADS_PER_BLOCK
    return o.select(
        F.concat(F.lit("L"), number.cast("string")).alias("upload_id"),
        k.alias("line_no"),
        line.alias("line"),
    )


# ----------------------------------------------------- landing on disk ----

WIDE_UPLOADS = ("L1", "L3")
_LANDING_CACHE: dict[tuple[int, str, str], str] = {}


def order_landing(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The ``order_lines`` uploads as real CSV files, one per upload; returns
    the dataset -> folder map. L1 and L3 carry a fifth column ``channel``
    (their header differs), so a load sees two header shapes."""
    lines = order_lines(spark, sf_dir)
    wide = F.col("upload_id").isin(*WIDE_UPLOADS)
    body = lines.select(
        "upload_id", "line_no",
        F.when(wide & (F.length("line") > 0), F.concat(F.col("line"), F.lit(",web"))).otherwise(F.col("line"))
        .alias("line"),
    )
    base = ",".join(LINE_HEADER)
    headers = lines.select("upload_id").distinct().select(
        "upload_id", F.lit(-1).cast("long").alias("line_no"),
        F.when(wide, F.lit(base + ",channel")).otherwise(F.lit(base)).alias("line"),
    )
    return {"orders": _landing_folder(spark, sf_dir, "orders", body.unionByName(headers))}


# Bytes of texts in one CSV file of documents: an upload of more is as many
# files, so the tasks that write them grow in number, not in size.
DOCUMENT_FILE_BYTES = 160 << 20


def document_csv(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """``documents`` as CSV files of four uploads (doc_id modulo 4): id, language
    and the text with a quoted remark on a line of its own, as one quoted cell.
    An upload of more than ``DOCUMENT_FILE_BYTES`` is several files of about
    that size (``D0.csv``, ``D0.1.csv``, ...; ``document_upload`` names their upload)."""
    d = table(spark, sf_dir, "documents")
    upload = F.concat(F.lit("D"), (F.col("doc_id") % 4).cast("string"))
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)  # and the rest of a line
    n_files = d.groupBy(upload.alias("_upload")).agg(F.ceil(size / DOCUMENT_FILE_BYTES).alias("_files"))  # a row per upload
    number = F.pmod(F.xxhash64("doc_id", "text"), F.coalesce("_files", F.lit(1)))
    d = d.withColumn("_upload", upload).join(F.broadcast(n_files), "_upload", "left")
    d = d.withColumn("upload_id", F.when(number > 0, F.concat("_upload", F.lit("."), number.cast("string"))).otherwise(F.col("_upload")))
    said = F.concat(F.coalesce("text", F.lit("")), F.lit('\nin "'), F.coalesce("lang", F.lit("")), F.lit('"'))
    body = d.select("upload_id", F.col("doc_id").alias("line_no"), F.concat(
        F.col("doc_id").cast("string"), F.lit(","), F.col("lang"), F.lit(',"'), F.replace(said, F.lit('"'), F.lit('""')), F.lit('"')).alias("line"))
    headers = d.select("upload_id").distinct().select(
        "upload_id", F.lit(-1).cast("long").alias("line_no"), F.lit("doc_id,lang,body").alias("line"))
    return {"texts": _landing_folder(spark, sf_dir, "texts", body.unionByName(headers))}


def document_upload(file_id: Column) -> Column:
    """The upload that a file of ``document_csv`` belongs to."""
    return F.regexp_extract(file_id, r"^([^.]*)", 1)


def _landing_folder(spark: SparkSession, sf_dir: str, dataset: str, lines: DataFrame) -> str:
    """Write ``lines`` (upload_id, line_no, line) as one file per upload under
    a fresh folder of the shared checkpoint root, once per session and table
    folder. Spark writes the files (each upload's lines in order, uploads
    spread over the shuffle partitions); the driver only renames one part
    file per upload to ``<upload>.csv``. By range, uploads never share a task
    while there are partitions left."""
    from sluice.plans.session import scratch_path
    from sluice.sources.landing import _fs_path

    key = (id(spark), sf_dir, dataset)
    if key in _LANDING_CACHE:
        fs, hp = _fs_path(spark, _LANDING_CACHE[key])
        if fs.exists(hp):
            return _LANDING_CACHE[key]
    root = scratch_path(spark, "landing")
    tmp, final = f"{root}/_write", f"{root}/{dataset}"
    (
        lines
        .repartitionByRange("upload_id")
        .sortWithinPartitions("upload_id", "line_no")
        .select("upload_id", "line")
        .write.mode("overwrite").partitionBy("upload_id").text(tmp)
    )
    fs, tmp_path = _fs_path(spark, tmp)
    _, final_path = _fs_path(spark, final)
    fs.mkdirs(final_path)
    jvm = spark.sparkContext._jvm
    for st in fs.listStatus(tmp_path):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith("upload_id=")):
            continue
        upload = name.split("=", 1)[1]
        parts = [p for p in fs.listStatus(st.getPath()) if p.getPath().getName().startswith("part-")]
        if len(parts) != 1 or not fs.rename(parts[0].getPath(), jvm.org.apache.hadoop.fs.Path(final_path, f"{upload}.csv")):
            raise OSError(f"Upload {upload} was not written as one file: {len(parts)} parts")
    _LANDING_CACHE[key] = final
    return final


def csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as the contents of CSV files (doc_id, content), one kind
    of file for each remainder of doc_id by 8: the text as it is, a sound file
    with the text as a quoted cell, and one for each rejection."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 8
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    return d.select("doc_id", (
        F.when(k == 1, F.concat(F.lit('Doc ID,"the ""Text"""\r\n'), F.col("doc_id").cast("string"), F.lit(","), quoted, F.lit("\r\n")))
        .when(k == 2, "").when(k == 3, "id,lang\n").when(k == 4, F.concat(F.lit("\n"), F.col("text")))
        .when(k == 5, F.concat(F.lit("id;lang\n1;"), F.col("lang"), F.lit("\n")))
        .when(k == 6, F.concat(F.lit("id,,lang\n1,2,"), quoted))
        .when(k == 7, F.concat(F.col("text"), F.unhex(F.lit("0AE9")).cast("string")))
        .otherwise(F.col("text"))).alias("content"))


def split_landing(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Copies of the landing files in two dataset folders: L0 to L3 are
    ``orders``, the others ``returns``."""
    from sluice.plans.session import scratch_path
    from sluice.sources.landing import _fs_path

    source = order_landing(spark, sf_dir)["orders"]
    root = scratch_path(spark, "landing")
    dirs = {"orders": f"{root}/orders", "returns": f"{root}/returns"}
    fs, folder = _fs_path(spark, source)
    jvm = spark.sparkContext._jvm
    for d in dirs.values():
        fs.mkdirs(_fs_path(spark, d)[1])
    for st in fs.listStatus(folder):
        name = st.getPath().getName()
        target = dirs["orders" if name[:2] in ("L0", "L1", "L2", "L3") else "returns"]
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, st.getPath(), fs, _fs_path(spark, f"{target}/{name}")[1], False,
                                               spark.sparkContext._jsc.hadoopConfiguration())
    return dirs


def make_unreadable(spark: SparkSession, path: str) -> None:
    """Spoil a file's checksums, as a bad disk would: size and time stay,
    reading it raises (file systems with checksum files, such as local ones)."""
    from sluice.sources.landing import _fs_path

    fs, target = _fs_path(spark, path)
    chunks = -(-fs.getFileStatus(target).getLen() // 512)
    out = fs.getRawFileSystem().create(fs.getChecksumFile(target), True)
    out.write(b"crc\x00" + (512).to_bytes(4, "big") + b"\x00" * 4 * chunks)
    out.close()


# Contract of the "orders" landing dataset written by ``order_landing``.
LANDING_CONTRACT = Contract(
    key_columns=("order_code",),
    columns=(
        ColumnSpec("order_code", "string", True),
        ColumnSpec("order_status", "string", True),
        ColumnSpec("amount", "decimal(18,2)", True),
        ColumnSpec("priority", "string", True),
        ColumnSpec("channel", "string"),
    ),
)
