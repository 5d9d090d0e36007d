"""availableNow landing stream: new files are registered and loaded once."""

import datetime as dt
import os

from sluice.contracts import ColumnSpec, Contract
from sluice.functions import status as S
from sluice.plans import batch
from sluice.streaming.landing_stream import run_available

C = {"items": Contract(("item_id",), (ColumnSpec("item_id", "string", True), ColumnSpec("qty", "integer")))}


def test_stream_registers_new_files_once(spark, tmp_path):
    land = tmp_path / "landing" / "items"
    os.makedirs(land)
    (land / "a.csv").write_text("item_id,qty\nI1,1\nI2,2\n")
    store = batch.Store(str(tmp_path / "store"))
    clock = iter([dt.datetime(2030, 1, 1, 0, i) for i in range(10)])
    first = run_available(spark, store, C, {"items": str(land)}, clock=lambda: next(clock))
    assert sum(s["loaded"] for s in first) == 1
    (land / "b.csv").write_text("item_id,qty\nI3,3\n")
    second = run_available(spark, store, C, {"items": str(land)}, clock=lambda: next(clock))
    assert sum(s["loaded"] for s in second) == 1  # only the new file
    (land / "empty.csv").write_text("")  # no stream plans a split for it
    third = run_available(spark, store, C, {"items": str(land)}, clock=lambda: next(clock), min_age_seconds=0)
    assert sum(s["rejected"] for s in third) == 1
    assert run_available(spark, store, C, {"items": str(land)}, clock=lambda: next(clock), min_age_seconds=0) == []
    m = {r.original_file_name: r.status for r in batch.current_manifest(spark, store).collect()}
    assert m == {"a.csv": S.PROCESSED, "b.csv": S.PROCESSED, "empty.csv": S.REJECTED}


def test_growing_and_old_files(spark, tmp_path):
    land = tmp_path / "landing" / "items"
    os.makedirs(land)
    (land / "old.csv").write_text("item_id,qty\nI1,1\n")
    (land / "young.csv").write_text("item_id,qty\nI2,")
    real = dt.datetime.now()
    at = real.timestamp()
    os.utime(land / "old.csv", (at - 90 * 86400, at - 90 * 86400))
    os.utime(land / "young.csv", (at, at))
    store = batch.Store(str(tmp_path / "store"))
    first = run_available(spark, store, C, {"items": str(land)}, clock=lambda: real + dt.timedelta(seconds=5))
    assert sum(s["loaded"] for s in first) == 1  # the old one; the young one waits
    (land / "young.csv").write_text("item_id,qty\nI2,2\nI3,3\n")
    os.utime(land / "young.csv", (at, at))
    second = run_available(spark, store, C, {"items": str(land)}, clock=lambda: real + dt.timedelta(seconds=90))
    assert sum(s["loaded"] for s in second) == 1
    assert run_available(spark, store, C, {"items": str(land)}, clock=lambda: real + dt.timedelta(seconds=99)) == []
    assert sorted(r.item_id for r in batch.read_bronze(spark, store, "items").collect()) == ["I1", "I2", "I3"]
