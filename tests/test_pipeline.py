"""End-to-end upload runs over real files (arrange -> act -> assert)."""

import datetime as dt
import os

import pytest

from sluice.contracts import ColumnSpec, Contract
from sluice.functions import status as S
from sluice.plans import batch

COLS = (
    ColumnSpec("project_id", "string", True),
    ColumnSpec("project_name", "string", True),
    ColumnSpec("project_status", "string", True),
    ColumnSpec("start_date", "date"),
    ColumnSpec("end_date", "date"),
)
CONTRACTS = {
    "strict": Contract(("project_id",), COLS, reject_unexpected=True),
    "lenient": Contract(("project_id",), COLS, reject_unexpected=False),
}
HEADER = "project_id,project_name,project_status\n"


def _write(path, text=None, data=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if data is not None else text.encode("utf-8"))


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    le, st = root / "lenient", root / "strict"
    _write(str(le / "clean.csv"), HEADER + "P1,Alpha,Active\nP2,Beta,Closed\nP3,Gamma,Active\n")
    _write(str(le / "copy of clean.csv"), HEADER + "P1,Alpha,Active\nP2,Beta,Closed\nP3,Gamma,Active\n")
    _write(str(le / "excel export.CSV"), "Project ID,Project Name,Project Status\nP4,Delta,Active\nP5,Eps,Closed\n")
    _write(str(le / "extra.csv"), HEADER.strip() + ",project_region\nP6,Zeta,Active,North\nP7,Eta,Active,South\n")
    good = "".join(f"G{i},Name {i},Active\n" for i in range(98))
    _write(str(le / "mostly_good.csv"), HEADER + good + "B1,x,y,z\nB2,x,y,z\n")
    bad = "".join(f"H{i},Name {i},Active\n" for i in range(10)) + "".join(f"C{i},x,y,z\n" for i in range(10))
    _write(str(le / "mostly_bad.csv"), HEADER + bad)
    _write(str(le / "multiline.csv"), HEADER + 'M1,"two\nlines",Active\nM2,Plain,Active\n')
    _write(str(le / "empty.csv"), "")
    _write(str(le / "notes.txt"), "not a csv")
    _write(str(st / "extra.csv"), HEADER.strip() + ",project_region\nS1,Zeta,Active,North\n")
    _write(str(st / "cp1252.csv"), data="project_id,project_name,project_status\nP1,Caf\xe9,Active\n".encode("cp1252"))
    return {"lenient": str(le), "strict": str(st), "missing": str(root / "nope")}


def _status(spark, store):
    m = batch.current_manifest(spark, store).select("original_file_name", "status", "validation_message",
                                                     "bronze_row_count", "bronze_corrupt_row_count",
                                                     "source_row_count")
    return {r["original_file_name"]: r for r in m.collect()}


NOW = dt.datetime(2030, 1, 1, 12, 0, 0)


def test_upload_run_end_to_end(spark, landing, tmp_path):
    store = batch.Store(str(tmp_path / "store"))
    dirs = {k: v for k, v in landing.items()}
    summary = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW)
    st = _status(spark, store)

    assert st["clean.csv"]["status"] == S.PROCESSED
    assert st["clean.csv"]["bronze_row_count"] == 3 and st["clean.csv"]["bronze_corrupt_row_count"] == 0
    assert st["copy of clean.csv"]["status"] == S.DUPLICATE
    assert st["excel export.CSV"]["status"] == S.PROCESSED
    assert st["extra.csv"]["status"] in (S.PROCESSED, S.REJECTED)  # two files share the name
    assert st["mostly_good.csv"]["status"] == S.PROCESSED
    assert st["mostly_good.csv"]["bronze_corrupt_row_count"] == 2
    assert st["mostly_bad.csv"]["status"] == S.BRONZE_REJECTED
    assert "exceeds the 5% limit" in st["mostly_bad.csv"]["validation_message"]
    assert st["multiline.csv"]["status"] == S.PROCESSED
    assert st["multiline.csv"]["bronze_row_count"] == 2 and st["multiline.csv"]["source_row_count"] == 2
    assert st["empty.csv"]["status"] == S.REJECTED
    assert "completely empty" in st["empty.csv"]["validation_message"]
    assert st["cp1252.csv"]["status"] == S.REJECTED and "UTF-8" in st["cp1252.csv"]["validation_message"]
    assert "notes.txt" not in st

    bronze = spark.read.option("mergeSchema", "true").parquet(store.bronze("lenient"))
    cols = set(bronze.columns)
    assert {"project_id", "project_name", "project_status", "project_region", "_corrupt_record",
            "upload_id", "source_file_name", "ingested_at"} <= cols
    # rejected upload wrote nothing; the published rows are exactly the PROCESSED counts
    assert bronze.count() == 3 + 2 + 2 + 100 + 2
    texts = [r[0] for r in bronze.where("project_id = 'M1'").select("project_name").collect()]
    assert texts == ["two\nlines"]
    assert summary["loaded"] == 5 and summary["duplicates"] == 1

    strict = batch.current_manifest(spark, store).where("dataset_name = 'strict'").collect()
    by_status = {r["original_file_name"]: r for r in strict}
    assert by_status["extra.csv"]["status"] == S.REJECTED
    assert "Unexpected columns: project_region" in by_status["extra.csv"]["validation_message"]

    # Re-run: nothing new, nothing reloaded, bronze unchanged (idempotent).
    again = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW + dt.timedelta(minutes=15))
    assert again["registered"] == 0 and again["loaded"] == 0 and again["validated"] == 0
    assert spark.read.option("mergeSchema", "true").parquet(store.bronze("lenient")).count() == 109

    # A registered file overwritten in place is refused as CHANGED.
    _write(os.path.join(landing["lenient"], "clean.csv"), HEADER + "P1,Alpha,Active\n")
    third = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW + dt.timedelta(minutes=30))
    assert third["errors"] == 1


def test_silver_and_links_from_files(spark, tmp_path):
    from sluice.contracts import PRODUCTION_CONTRACTS

    root = tmp_path / "landing"
    _write(str(root / "applications" / "apps.csv"),
           "application_code,application_name,lifecycle_status\nA1,One,Live\nA2,Two,Live\n A1 ,One again,Retired\n")
    _write(str(root / "projects" / "p.csv"),
           "project_code,project_name,status,planned_start_date,planned_end_date,actual_start_date,actual_end_date\n"
           "P1,Proj,Open,03/04/2026,N/A,,31/02/2026\n"
           ",Keyless,Open,01/01/2026,01/01/2026,01/01/2026,01/01/2026\n")
    _write(str(root / "application_project_map" / "m.csv"),
           "application_code,project_code,asserted_by,asserted_at,notes\n"
           "A1,P1,me,01/02/2026,ok\nA2,P9,me,1/2/2026,\nA9,P1,me,,\nA9,P9,,,\n")
    dirs = {d: str(root / d) for d in PRODUCTION_CONTRACTS}
    store = batch.Store(str(tmp_path / "store"))
    batch.run_uploads(spark, store, PRODUCTION_CONTRACTS, dirs, NOW)
    sil = {s["dataset"]: s for s in batch.run_silver(spark, store, PRODUCTION_CONTRACTS, NOW)}
    assert sil["applications"]["silver_rows"] == 2 and sil["applications"]["deduplicated_away"] == 1
    assert sil["projects"]["dropped_corrupt_or_keyless"] == 1
    assert "error" in sil["contracts"]  # no bronze yet: isolated, the others still built
    p = spark.read.parquet(store.silver("projects")).collect()[0]
    assert str(p["planned_start_date"]) == "2026-04-03" and p["planned_end_date_is_valid"] is False
    assert p["actual_start_date"] is None and p["actual_start_date_is_valid"] is True
    assert p["actual_end_date_is_valid"] is False
    links = batch.run_links(spark, store, NOW)[0]
    assert links["VALID"] == 1 and links["ORPHAN_PROJECT"] == 1
    assert links["ORPHAN_APPLICATION"] == 1 and links["ORPHAN_BOTH"] == 1
    # unchanged bronze: the next silver run skips
    again = {s["dataset"]: s for s in batch.run_silver(spark, store, PRODUCTION_CONTRACTS, NOW)}
    assert again["applications"].get("skipped") is True


def test_crashed_load_is_released_and_reloaded_without_duplicates(spark, tmp_path):
    from pyspark.sql import functions as F

    from sluice.operators import manifest as MF

    c = {"lenient": CONTRACTS["lenient"]}
    land = tmp_path / "landing"
    _write(str(land / "p.csv"), HEADER + "P1,A,Active\nP2,B,Active\nP3,C,Active\n")
    store = batch.Store(str(tmp_path / "store"))
    batch.run_uploads(spark, store, c, {"lenient": str(land)}, NOW)
    uid = batch.current_manifest(spark, store).first().upload_id

    # A later run died mid-load: the upload sits in PROCESSING and bronze
    # holds a partial, unrecorded write for it.
    crash = NOW + dt.timedelta(hours=1)
    batch.append_events(MF.manual_update(spark, [uid], {"status": S.PROCESSING}), store,
                        batch.event_seq(crash, 50), F.lit(crash))
    junk = spark.createDataFrame([("JUNK", None, None, None, "x", NOW, uid)],
                                 "project_id string, project_name string, project_status string, "
                                 "_corrupt_record string, source_file_name string, ingested_at timestamp, "
                                 "upload_id string")
    junk.write.mode("append").partitionBy("upload_id").parquet(store.bronze("lenient"))

    # Ten minutes later the claim is still fresh: nothing may touch it.
    early = batch.run_uploads(spark, store, c, {"lenient": str(land)}, crash + dt.timedelta(minutes=10))
    assert early["released"] == 0 and early["loaded"] == 0
    assert batch.current_manifest(spark, store).first().status == S.PROCESSING

    # Past the stale limit it is released to BRONZE_FAILED and reloaded.
    late = batch.run_uploads(spark, store, c, {"lenient": str(land)}, crash + dt.timedelta(minutes=45))
    assert late["released"] == 1 and late["loaded"] == 1
    assert batch.current_manifest(spark, store).first().status == S.PROCESSED
    ids = sorted(r.project_id for r in spark.read.option("mergeSchema", "true").parquet(store.bronze("lenient"))
                 .where(F.col("upload_id") == uid).collect())
    assert ids == ["P1", "P2", "P3"]  # the partial write was replaced, not appended to


def test_single_upload_api(spark, tmp_path):
    c = {"lenient": CONTRACTS["lenient"]}
    land = tmp_path / "landing" / "lenient"
    _write(str(land / "one.csv"), HEADER + "P1,A,Active\n")
    _write(str(tmp_path / "landing" / "elsewhere.csv"), HEADER + "P1,A,Active\n")
    store = batch.Store(str(tmp_path / "store"))
    dirs = {"lenient": str(land)}
    t = NOW
    uid = batch.register_uploaded_file(spark, store, c, dirs, str(land / "one.csv"), " Lenient ", t,
                                       source_system=" crm ", reporting_period="2026-q3")
    assert batch.register_uploaded_file(spark, store, c, dirs, str(land / "one.csv"), "lenient",
                                        t + dt.timedelta(seconds=1)) == uid  # identical re-registration
    with pytest.raises(ValueError, match="must be inside"):
        batch.register_uploaded_file(spark, store, c, dirs, str(tmp_path / "landing" / "elsewhere.csv"),
                                     "lenient", t)
    with pytest.raises(ValueError, match="reporting_period"):
        _write(str(land / "two.csv"), HEADER + "P2,B,Active\n")
        batch.register_uploaded_file(spark, store, c, dirs, str(land / "two.csv"), "lenient", t,
                                     reporting_period="Q3 2026")
    with pytest.raises(ValueError, match="Unknown dataset"):
        batch.register_uploaded_file(spark, store, c, dirs, str(land / "one.csv"), "nope", t)
    m = batch.current_manifest(spark, store).first()
    assert (m.source_system, m.reporting_period, m.status) == ("CRM", "2026-Q3", S.RECEIVED)

    with pytest.raises(ValueError, match="cannot be loaded to bronze"):
        batch.load_upload_to_bronze(spark, store, c, uid, t + dt.timedelta(seconds=2))
    out = batch.validate_registered_upload(spark, store, c, uid, t + dt.timedelta(seconds=3))
    assert out["status"] == S.VALIDATED and out["source_row_count"] == 1
    with pytest.raises(ValueError, match="has status 'VALIDATED' and cannot be validated"):
        batch.validate_registered_upload(spark, store, c, uid, t + dt.timedelta(seconds=4))
    res = batch.load_upload_to_bronze(spark, store, c, uid, t + dt.timedelta(seconds=5))
    assert res["status"] == S.PROCESSED and res["bronze_row_count"] == 1
    assert batch.get_status(spark, store, uid) == S.PROCESSED
    with pytest.raises(ValueError, match="Upload ID was not found"):
        batch.validate_registered_upload(spark, store, c, "nope", t + dt.timedelta(seconds=6))


def test_vanished_and_replaced_files_are_rejected(spark, tmp_path):
    c = {"lenient": CONTRACTS["lenient"]}
    land = tmp_path / "landing" / "lenient"
    _write(str(land / "gone.csv"), HEADER + "P1,A,Active\n")
    _write(str(land / "swapped.csv"), HEADER + "P2,B,Active\n")
    store = batch.Store(str(tmp_path / "store"))
    dirs = {"lenient": str(land)}
    gone = batch.register_uploaded_file(spark, store, c, dirs, str(land / "gone.csv"), "lenient", NOW)
    swapped = batch.register_uploaded_file(spark, store, c, dirs, str(land / "swapped.csv"), "lenient",
                                           NOW + dt.timedelta(seconds=1))
    os.remove(land / "gone.csv")
    _write(str(land / "swapped.csv"), HEADER + "P2,B,Closed\n")
    a = batch.validate_registered_upload(spark, store, c, gone, NOW + dt.timedelta(seconds=2))
    assert a["status"] == S.REJECTED and "no longer exists" in a["validation_message"]
    b = batch.validate_registered_upload(spark, store, c, swapped, NOW + dt.timedelta(seconds=3))
    assert b["status"] == S.REJECTED and "has changed since it was registered" in b["validation_message"]


def test_lineage_wins_over_columns_of_the_file(spark):
    from pyspark.sql import functions as F

    from sluice.operators.bronze import attach_lineage

    scanned = spark.createDataFrame([("f1", "own", "x", "late", "1")], "_file_path string, Upload_Id string, source_file_name string, ingested_at string, a string")
    files = spark.createDataFrame([("f1", "u1", "a.csv")], "file_path string, upload_id string, source_file_name string")
    row = attach_lineage(scanned, files, F.lit("now")).first()
    assert row.asDict() == {"a": "1", "upload_id": "u1", "source_file_name": "a.csv", "ingested_at": "now"}


def test_one_odd_upload_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    from sluice.operators import bronze as BR

    land = tmp_path / "landing"
    _write(str(land / "lenient" / "good.csv"), HEADER + "P1,A,Active\n")
    _write(str(land / "lenient" / "own_id.csv"), HEADER.strip() + ",upload_id\nP2,B,Active,mine\n")
    _write(str(land / "lenient" / "odd.csv"), HEADER.strip() + ",odd_column\nP3,C,Active,x\n")
    _write(str(land / "strict" / "good too.csv"), HEADER + "S1,A,Active\n")
    dirs = {d: str(land / d) for d in CONTRACTS}
    store = batch.Store(str(tmp_path / "store"))
    scan = BR.scan_uploads

    def fails_on_odd(spark, files, ingested_at):
        if any("odd_column" in r.header for r in files.select("header").collect()):
            raise RuntimeError("x" * 2000)
        return scan(spark, files, ingested_at)

    monkeypatch.setattr(BR, "scan_uploads", fails_on_odd)
    summary = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW)
    st = _status(spark, store)
    assert {k: v["status"] for k, v in st.items()} == {
        "good.csv": S.PROCESSED, "own_id.csv": S.PROCESSED, "odd.csv": S.BRONZE_FAILED, "good too.csv": S.PROCESSED}
    assert len(st["odd.csv"]["validation_message"]) == 1000
    assert summary["loaded"] == 3 and summary["errors"] == 1

    monkeypatch.undo()  # the cause is mended: the failed upload is claimed again
    later = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW + dt.timedelta(minutes=5))
    assert later["loaded"] == 1 and later["errors"] == 0
    assert _status(spark, store)["odd.csv"]["status"] == S.PROCESSED


def test_failed_validation_is_recorded(spark, tmp_path, monkeypatch):
    from sluice.operators import validate as V

    land = tmp_path / "landing" / "lenient"
    _write(str(land / "one.csv"), HEADER + "P1,A,Active\n")
    store = batch.Store(str(tmp_path / "store"))

    def boom(*args):
        raise RuntimeError("no rules today")

    monkeypatch.setattr(V, "check_columns", boom)
    summary = batch.run_uploads(spark, store, CONTRACTS, {"lenient": str(land)}, NOW)
    row = _status(spark, store)["one.csv"]
    assert (row["status"], row["validation_message"], summary["errors"]) == (S.FAILED, "no rules today", 1)


def test_validate_without_a_contract_raises(spark, tmp_path):
    land = tmp_path / "landing" / "lenient"
    _write(str(land / "one.csv"), HEADER + "P1,A,Active\n")
    store = batch.Store(str(tmp_path / "store"))
    uid = batch.register_uploaded_file(spark, store, CONTRACTS, {"lenient": str(land)}, str(land / "one.csv"), "lenient", NOW)
    with pytest.raises(ValueError, match="has no contract"):
        batch.validate_registered_upload(spark, store, {"strict": CONTRACTS["strict"]}, uid, NOW)
    # one clock for all three calls: the order of the appends decides
    batch.validate_registered_upload(spark, store, CONTRACTS, uid, NOW)
    batch.load_upload_to_bronze(spark, store, CONTRACTS, uid, NOW)
    assert batch.get_status(spark, store, uid) == S.PROCESSED


def test_unreadable_upload_fails_alone(spark, tmp_path):
    """One file of two datasets cannot be read any more: FAILED, the rest
    PROCESSED; once it can be read again it is validated and loaded."""
    from sluice.plans.fixtures import make_unreadable
    from sluice.sources import landing as LD

    land = tmp_path / "landing"
    for d in CONTRACTS:
        for i in range(3):
            _write(str(land / d / f"{d}{i}.csv"), HEADER + f"P{i},A,Active\n" * (i + 1))
    dirs = {d: str(land / d) for d in CONTRACTS}
    store = batch.Store(str(tmp_path / "store"))
    now_c, run_seq, run_dir = batch._run(store, NOW - dt.timedelta(minutes=15))
    batch.register_stage(spark, store, CONTRACTS, LD.inventory(spark, dirs, now_c, 0), now_c, run_dir, run_seq * 100)
    make_unreadable(spark, str(land / "strict" / "strict1.csv"))
    summary = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW)
    st = _status(spark, store)
    bad = st.pop("strict1.csv")
    assert bad["status"] == S.FAILED and "could not be read to its end" in bad["validation_message"]
    assert {r["status"] for r in st.values()} == {S.PROCESSED}
    assert (summary["loaded"], summary["errors"]) == (5, 1)

    os.remove(land / "strict" / ".strict1.csv.crc")
    again = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW + dt.timedelta(minutes=15))
    assert (again["validated"], again["loaded"], again["errors"]) == (1, 1, 0)

    # Unreadable from the start: not registered, counted, and tried again next time.
    _write(str(land / "lenient" / "new.csv"), HEADER + "N1,A,Active\n")
    make_unreadable(spark, str(land / "lenient" / "new.csv"))
    third = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW + dt.timedelta(minutes=30))
    assert (third["registered"], third["errors"]) == (0, 1)
    os.remove(land / "lenient" / ".new.csv.crc")
    fourth = batch.run_uploads(spark, store, CONTRACTS, dirs, NOW + dt.timedelta(minutes=45))
    assert (fourth["registered"], fourth["loaded"], fourth["errors"]) == (1, 1, 0)


def test_known_files_are_not_read_again(spark, tmp_path, monkeypatch):
    from sluice.sources import landing as LD

    c = {"lenient": CONTRACTS["lenient"]}
    land = tmp_path / "landing"
    for n in ("a", "b", "c"):
        _write(str(land / f"{n}.csv"), HEADER + f"{n},A,Active\n")
    store = batch.Store(str(tmp_path / "store"))
    read: list[str] = []
    hash_files = LD.hash_files

    def noted(spark, files, *more):
        unread = files.where("file_hash IS NULL") if "file_hash" in files.columns else files
        read.extend(r.stored_file_path.rsplit("/", 1)[1] for r in unread.collect())
        return hash_files(spark, files, *more)

    monkeypatch.setattr(LD, "hash_files", noted)

    def run(minutes, **more):
        read.clear()
        summary = batch.run_uploads(spark, store, c, {"lenient": str(land)}, NOW + dt.timedelta(minutes=minutes), **more)
        return sorted(read), summary["registered"], summary["errors"]

    assert run(0) == (["a.csv", "b.csv", "c.csv"], 3, 0)  # once each, though three stages check them
    assert run(15) == ([], 0, 0)
    _write(str(land / "b.csv"), HEADER + "b,B,Active\n")  # same size, other contents and time
    os.utime(land / "b.csv", (1_700_000_000, 1_700_000_000))
    assert run(30) == (["b.csv"], 0, 1)  # CHANGED
    stat = os.stat(land / "c.csv")
    _write(str(land / "c.csv"), HEADER + "c,C,Active\n")  # same size and time: seen only by a full hash
    os.utime(land / "c.csv", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert run(45) == (["b.csv"], 0, 1)
    assert run(60, rehash=True) == (["a.csv", "b.csv", "c.csv"], 0, 2)


def test_silver_takes_up_new_uploads_only(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from sluice.operators import manifest as MF

    c = {"lenient": CONTRACTS["lenient"]}
    land = tmp_path / "landing"
    _write(str(land / "a.csv"), HEADER + "P1,A,Active\nP2,B,Active\n")
    store = batch.Store(str(tmp_path / "store"))
    wanted: list = []
    read_bronze = batch.read_bronze
    monkeypatch.setattr(batch, "read_bronze", lambda s, st, d, uploads=None: wanted.append(uploads) or read_bronze(s, st, d, uploads))

    def run(hours, uploads=False, **more):
        wanted.clear()
        now = NOW + dt.timedelta(hours=hours)
        if uploads:
            batch.run_uploads(spark, store, c, {"lenient": str(land)}, now)
        out = batch.run_silver(spark, store, more.pop("contracts", c), now, **more)[0]
        names = {r.project_id: r.project_name for r in spark.read.parquet(store.silver("lenient")).collect()}
        return out, names

    assert run(0, uploads=True)[0]["incremental"] is False
    _write(str(land / "b.csv"), HEADER + "P2,Newer,Closed\nP3,C,Active\n,keyless,x\n")
    out, names = run(1, uploads=True)
    b = batch.current_manifest(spark, store).where("original_file_name = 'b.csv'").first().upload_id
    assert wanted == [[b]]  # the earlier upload is not read
    assert names == {"P1": "A", "P2": "Newer", "P3": "C"}
    assert out == {"dataset": "lenient", "incremental": True, "bronze_rows": 3, "dropped_corrupt_or_keyless": 1, "deduplicated_away": 1, "silver_rows": 3}
    assert run(2)[0] == {"dataset": "lenient", "skipped": True}

    full, same = run(3, force=True)
    assert full["incremental"] is False and same == names
    # An upload that is no longer PROCESSED leaves the table; another contract builds it anew.
    now = NOW + dt.timedelta(hours=4)
    batch.append_events(MF.manual_update(spark, [b], {"status": S.REJECTED}), store, batch.event_seq(now), F.lit(now))
    out, names = run(4)
    assert out["incremental"] is False and names == {"P1": "A", "P2": "B"}
    other = {"lenient": Contract(("project_id",), (*COLS, ColumnSpec("project_region", "string")))}
    out, names = run(5, contracts=other)
    assert out["incremental"] is False and "project_region" in spark.read.parquet(store.silver("lenient")).columns


def test_interrupted_replacement_is_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store = batch.Store(str(tmp_path))
    batch.replace_table(spark, spark.range(3), path)

    rename = batch._rename
    calls = []

    def dies_at_the_second(s, a, b):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("lost")
        rename(s, a, b)

    monkeypatch.setattr(batch, "_rename", dies_at_the_second)
    with pytest.raises(OSError, match="lost"):
        batch.replace_table(spark, spark.range(5), path)
    monkeypatch.undo()
    assert batch.table_exists(spark, store, path) and batch.read_table(spark, store, path).count() == 3
    assert batch.replace_table(spark, spark.range(5), path).count() == 5
    assert batch.read_table(spark, store, path).count() == 5


def test_views_name_the_old_table_until_the_new_one_is_whole(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.sql("CREATE DATABASE IF NOT EXISTS curation")
    store = batch.Store(str(tmp_path / "store"), database="curation")
    path = store.silver("orders")
    view = store.view(path)
    assert view == "curation.silver_orders" and not batch.table_exists(spark, store, path)
    try:
        for n in (2, 3, 4):
            batch.replace_table(spark, spark.range(n), path, view)
            assert batch.read_table(spark, store, path).count() == n
        broken = spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
        with pytest.raises(Exception, match="no"):
            batch.replace_table(spark, broken, path, view)
        assert batch.read_table(spark, store, path).count() == 4
        versions = [x.name for x in spark.catalog.listTables("curation") if x.name.startswith("silver_orders__")]
        assert 2 <= len(versions) <= 3
    finally:
        spark.sql("DROP DATABASE curation CASCADE")


def test_strict_store_needs_its_manifest(spark, tmp_path):
    store = batch.Store(str(tmp_path / "store"), strict=True)
    with pytest.raises(FileNotFoundError, match="create_manifest"):
        batch.get_status(spark, store, "x")
    with pytest.raises(FileNotFoundError, match="create_manifest"):
        batch.run_uploads(spark, store, CONTRACTS, {}, NOW)
    assert batch.create_manifest(spark, store) and not batch.create_manifest(spark, store)
    assert batch.get_status(spark, store, "x") is None


def test_manifest_state_reads_new_events_only(spark, tmp_path):
    from pyspark.sql import functions as F

    from sluice.operators import manifest as MF
    from sluice.streaming import manifest_state as MS

    store = batch.Store(str(tmp_path / "store"), incremental_manifest=True)
    fields = "upload_id string, status string, validation_message string, missing_columns array<string>, source_row_count long"
    steps = [
        [("a", "RECEIVED", None, None, None), ("b", "RECEIVED", None, None, None)],
        [("a", "VALIDATED", "fine", [], 5)],
        [("b", "FAILED", "broken", None, None), ("c", "RECEIVED", None, None, None)],
        [("a", "PROCESSED", None, None, None), ("b", "RECEIVED", None, ["x"], None)],
    ]
    root = store.manifest_state
    for i, rows in enumerate(steps):
        now = NOW + dt.timedelta(days=i)
        batch.append_events(spark.createDataFrame(rows, fields), store, batch.event_seq(now), F.lit(now))
        if i == 1:  # taken up with the next append
            continue
        assert MS.advance(spark, store.manifest_events, root) == len(rows) + (len(steps[1]) if i == 2 else 0)
        now_known = batch.current_manifest(spark, store)
        folded = MF.fold(batch.read_events(spark, store))
        assert sorted(map(repr, now_known.select(*folded.columns).collect())) == sorted(map(repr, folded.collect()))
    assert MS.advance(spark, store.manifest_events, root) == 0


def test_run_with_an_incremental_manifest(spark, tmp_path):
    c = {"lenient": CONTRACTS["lenient"]}
    land = tmp_path / "landing"
    _write(str(land / "a.csv"), HEADER + "P1,A,Active\n")
    store = batch.Store(str(tmp_path / "store"), incremental_manifest=True, strict=True)
    batch.create_manifest(spark, store)
    assert batch.run_uploads(spark, store, c, {"lenient": str(land)}, NOW)["loaded"] == 1
    assert {r["status"] for r in _status(spark, store).values()} == {S.PROCESSED}
