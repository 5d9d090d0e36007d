"""Header vs contract check (set-based), and the outcome shape."""

import pytest

from sluice.contracts import ColumnSpec, Contract, contracts_frame
from sluice.functions import status as S
from sluice.operators import validate as V

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


def check(spark, dataset, header):
    df = spark.createDataFrame([("u", dataset, header)], "upload_id string, dataset_name string, header array<string>")
    return V.check_columns(df, contracts_frame(spark, CONTRACTS)).first()


def test_exact_required_passes(spark):
    r = check(spark, "strict", ["project_id", "project_name", "project_status"])
    assert r.is_valid and r.missing_columns == [] and r.unexpected_columns == [] and r.duplicate_columns == []
    assert r.validation_message == V.PASS_TEXT


def test_optional_and_order_free(spark):
    assert check(spark, "strict", ["start_date", "project_status", "project_id", "project_name"]).is_valid


def test_missing_sorted(spark):
    r = check(spark, "strict", ["project_status"])
    assert not r.is_valid and r.missing_columns == ["project_id", "project_name"]
    assert r.validation_message == "Missing required columns: project_id, project_name"


def test_duplicates(spark):
    r = check(spark, "lenient", ["project_id", "project_name", "project_status", "project_id"])
    assert not r.is_valid and r.duplicate_columns == ["project_id"]


def test_strict_rejects_extras_lenient_allows(spark):
    h = ["project_id", "project_name", "project_status", "zeta", "alpha"]
    s = check(spark, "strict", h)
    assert not s.is_valid and s.unexpected_columns == ["alpha", "zeta"]
    assert s.validation_message == "Unexpected columns: alpha, zeta"
    le = check(spark, "lenient", h)
    assert le.is_valid
    assert le.validation_message == V.PASS_TEXT + "; Extra columns present but allowed: alpha, zeta"


def test_all_problems_in_order(spark):
    r = check(spark, "strict", ["project_name", "project_name", "x"])
    assert r.validation_message == (
        "Missing required columns: project_id, project_status; Duplicate columns: project_name; "
        "Unexpected columns: x")


def test_empty_header(spark):
    r = check(spark, "strict", [])
    assert not r.is_valid and r.missing_columns == ["project_id", "project_name", "project_status"]


def test_unknown_dataset_is_flagged(spark):
    r = check(spark, "nope", ["a"])
    assert r.known_dataset is False and r.is_valid is None


def test_structure_violation_outcome_is_zeroed(spark):
    df = spark.createDataFrame(
        [("u", "strict", ["project_id"], 5, "The CSV header contains a blank column name.")],
        "upload_id string, dataset_name string, header array<string>, row_count long, violation string")
    out = V.validation_outcome(V.check_columns(df, contracts_frame(spark, CONTRACTS))).first()
    assert out.status == S.REJECTED and out.source_row_count == 0
    assert out.missing_columns == [] and out.unexpected_columns == [] and out.duplicate_columns == []


def test_contract_construction_rules():
    with pytest.raises(ValueError):
        Contract(("a",), (ColumnSpec("a", "string"),))  # no required column
    with pytest.raises(ValueError):
        Contract(("a",), (ColumnSpec("a", "string", True), ColumnSpec("a", "date")))
    with pytest.raises(ValueError):
        Contract(("d",), (ColumnSpec("d", "date", True),))  # key must be string
    with pytest.raises(ValueError):
        Contract(("a",), (ColumnSpec("a", "money", True),))


def test_silver_schema_shape():
    c = CONTRACTS["strict"]
    names = [f.name for f in c.silver_schema().fields]
    assert names == ["project_id", "project_name", "project_status", "start_date", "start_date_raw",
                     "start_date_is_valid", "end_date", "end_date_raw", "end_date_is_valid",
                     "upload_id", "ingested_at", "silver_processed_at"]
