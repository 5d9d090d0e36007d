"""Link classification/conservation and manifest fold/claims/registration."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.functions import status as S
from sluice.operators import links as L
from sluice.operators import manifest as MF


def test_links_keep_every_mapping_row_once(spark):
    mapping = spark.createDataFrame(
        [("A1", "P1"), ("A1", "P9"), ("A9", "P1"), ("A9", "P9"), ("A1", "P1")], "application_code string, project_code string")
    apps = spark.createDataFrame([("A1",), ("A1",), ("A2",)], "application_code string")  # duplicate entity row
    projects = spark.createDataFrame([("P1",)], "project_code string")
    out = L.resolve_links(mapping, [L.Reference("application", apps, "application_code", "application_code"),
                                    L.Reference("project", projects, "project_code", "project_code")])
    assert out.count() == mapping.count()
    got = sorted((r[0], r[1], r[2]) for r in out.collect())
    assert got == [("A1", "P1", "VALID"), ("A1", "P1", "VALID"), ("A1", "P9", "ORPHAN_PROJECT"),
                   ("A9", "P1", "ORPHAN_APPLICATION"), ("A9", "P9", "ORPHAN_BOTH")]


def test_coverage_distinct_vs_documented(spark):
    ents = spark.createDataFrame([("A1",), ("A2",)], "k string")
    links = spark.createDataFrame([("A1", "VALID"), ("A1", "VALID"), ("A2", "ORPHAN_PROJECT")],
                                  "k string, link_status string")
    d = L.mapping_coverage(ents, "k", links, "k").first()
    assert (d.entities, d.mapped, d.pct) == (2, 1, 50.0)
    raw = L.mapping_coverage_raw(ents, "k", links, "k").first()
    assert (raw.entities, raw.mapped) == (3, 1)  # the documented query's fan-out


def _events(spark, rows):
    df = spark.createDataFrame(rows, "upload_id string, seq long, status string, validation_message string, "
                                     "missing_columns array<string>")
    return MF.as_events(df, F.col("seq"), F.lit(dt.datetime(2026, 1, 1)))


def test_fold_takes_last_set_value_and_empty_array_overwrites_null(spark):
    ev = _events(spark, [("u", 1, "RECEIVED", None, None), ("u", 2, "VALIDATING", None, None),
                         ("u", 3, "VALIDATED", "ok", []), ("u", 4, None, None, None)])
    r = MF.fold(ev).first()
    assert r.status == "VALIDATED" and r.validation_message == "ok" and r.missing_columns == []
    assert r.n_events == 4


def _state(spark, rows):
    return spark.createDataFrame(rows, "upload_id string, status string, updated_at timestamp")


NOW = dt.datetime(2026, 1, 1, 12, 0)


def test_claim_fresh_vs_stale(spark):
    m = _state(spark, [("a", "RECEIVED", NOW), ("b", "VALIDATING", NOW - dt.timedelta(minutes=31)),
                       ("c", "VALIDATING", NOW - dt.timedelta(minutes=5)), ("d", "PROCESSED", NOW)])
    got = {r.upload_id: r for r in MF.claim(m, S.CLAIMABLE_FOR_VALIDATION, S.VALIDATING, "validated", NOW).collect()}
    assert got["a"].claimed and got["b"].claimed
    assert not got["c"].claimed and not got["d"].claimed
    assert got["d"].message == ("Upload d has status 'PROCESSED' and cannot be validated. "
                                "Eligible statuses: RECEIVED, FAILED.")


def test_release_stale(spark):
    m = _state(spark, [("a", "VALIDATING", NOW - dt.timedelta(hours=1)), ("b", "PROCESSING", NOW - dt.timedelta(hours=1)),
                       ("c", "PROCESSING", NOW)])
    got = {r.upload_id: r.new_status for r in MF.release_stale(m, NOW).collect()}
    assert got == {"a": S.FAILED, "b": S.BRONZE_FAILED}


def test_register_decisions(spark):
    inv = spark.createDataFrame([
        ("projects", "/l/projects/a.csv", "h1", 1, "id_a"),
        ("projects", "/l/projects/b.csv", "h2", 1, "id_b"),   # known path, new contents
        ("projects", "/l/projects/c.csv", "h3", 1, "id_c"),   # same contents as registered R3
        ("projects", "/l/projects/d.csv", "h4", 1, "id_d"),   # new
        ("projects", "/l/projects/e.csv", "h4", 1, "id_e"),   # copy of d in the same batch
        (" Other ", "/l/other/x.csv", "h5", 1, "id_x"),
    ], "dataset_name string, stored_file_path string, file_hash string, file_size_bytes long, upload_id string")
    man = spark.createDataFrame([
        ("R1", "projects", "/l/projects/a.csv", "h1", NOW),
        ("R2", "projects", "/l/projects/b.csv", "old", NOW),
        ("R3", "projects", "/l/projects/z.csv", "h3", NOW),
    ], "upload_id string, dataset_name string, stored_file_path string, file_hash string, created_at timestamp")
    got = {r.stored_file_path: r for r in MF.register_decisions(inv, man, ["projects"]).collect()}
    assert got["/l/projects/a.csv"].action == "KNOWN" and got["/l/projects/a.csv"].result_upload_id == "R1"
    assert got["/l/projects/b.csv"].action == "CHANGED"
    assert got["/l/projects/c.csv"].action == "DUPLICATE" and got["/l/projects/c.csv"].duplicate_of_upload_id == "R3"
    assert got["/l/projects/d.csv"].action == "NEW"
    assert got["/l/projects/e.csv"].action == "DUPLICATE" and got["/l/projects/e.csv"].duplicate_of_upload_id == "id_d"
    assert got["/l/other/x.csv"].action == "UNKNOWN_DATASET"


def test_manual_update_sets_only_given_columns(spark):
    base = _events(spark, [("u", 1, "REJECTED", "bad header", ["x"])])
    fix = MF.manual_update(spark, ["u"], {"status": "RECEIVED", "missing_columns": [],
                                          "validation_message": "y" * 1500})
    ev = base.unionByName(MF.as_events(fix, F.lit(2), F.lit(dt.datetime(2026, 1, 2))))
    r = MF.fold(ev).first()
    assert r.status == "RECEIVED" and r.missing_columns == []
    assert len(r.validation_message) == 1000 and r.validation_message.endswith("...")


def test_events_are_ordered_by_their_append(spark, tmp_path):
    from sluice.plans import batch

    store = batch.Store(str(tmp_path / "store"))
    t0 = dt.datetime(2030, 1, 1)
    for run, status in ((t0, "PROCESSING"), (t0 + dt.timedelta(days=1), "RECEIVED"), (t0, "PROCESSED")):
        # the first run ends after a later run began: its last event is the newest
        batch.append_events(MF.manual_update(spark, ["a"], {"status": status, "dataset_name": "d"}), store,
                            batch.event_seq(run), F.lit(run))
    row = batch.current_manifest(spark, store).first()
    assert row.status == "PROCESSED" and row.n_events == 3
    assert row.pipeline_run_id == str(batch.event_seq(t0) // 100)


def test_queues_and_reports_are_ordered(spark):
    import datetime as dt

    from sluice.operators import manifest as MF
    from sluice.operators import quality as Q

    t0 = dt.datetime(2030, 1, 1)
    rows = [(f"u{i}", ["RECEIVED", "VALIDATED", "FAILED", "PROCESSED"][i % 4], t0 + dt.timedelta(hours=(i * 7) % 10), t0 + dt.timedelta(hours=(i * 3) % 11))
            for i in range(20)]
    m = spark.createDataFrame(rows, "upload_id string, status string, created_at timestamp, updated_at timestamp").selectExpr(
        "*", "'f' AS original_file_name", "'' AS validation_message", "'me' AS uploaded_by")
    queue = MF.work_queues(m, {"validate": ("RECEIVED", "FAILED"), "bronze": ("VALIDATED",)}).collect()
    got = [(r.stage, r.created_at, r.upload_id) for r in queue]
    wanted = [("validate", c, u) for u, s, c, _ in rows if s in ("RECEIVED", "FAILED")], [("bronze", c, u) for u, s, c, _ in rows if s == "VALIDATED"]
    assert got == sorted(wanted[0]) + sorted(wanted[1])
    report = [(r.updated_at, r.upload_id) for r in Q.unfinished_uploads(m).collect()]
    assert report == sorted(((x, u) for u, s, _, x in rows if s != "PROCESSED"), key=lambda r: (-r[0].timestamp(), r[1]))


def test_dataset_names_lose_all_white_space(spark):
    from sluice.operators import manifest as MF

    inv = spark.createDataFrame([("\tProjects\n", "/l/a.csv", "h", 1, "id")],
                                "dataset_name string, stored_file_path string, file_hash string, file_size_bytes long, upload_id string")
    empty = spark.createDataFrame([], "upload_id string, dataset_name string, stored_file_path string, file_hash string, created_at timestamp")
    row = MF.register_decisions(inv, empty, ["projects"]).first()
    assert (row.dataset_name, row.action) == ("projects", "NEW")
    assert MF.register_decisions(inv, empty, ["contracts", "applications"]).first().message == (
        "Unknown dataset 'projects'. Expected one of: ['contracts', 'applications']")
