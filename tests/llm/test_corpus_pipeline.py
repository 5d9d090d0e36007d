"""The corpus pipeline: its stages in order, and the entry's queries."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as C

COLUMNS = {"doc_id", "text", "lang", "source", "n_chars"}


def test_run(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    kept = docs
    for name, stage in C.STAGES[:-1]:
        kept = C.materialise(stage(spark, kept, ""), name)
        assert set(kept.columns) == COLUMNS
        now = {r.doc_id for r in kept.select("doc_id").collect()}
        assert now <= ids
        ids = now
    out = C.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "ids"} <= set(out.columns) and out.count() == kept.count()


def test_empty_and_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "x " * 5000, "en", "s", 1)], docs.schema)
    for data in (docs.limit(0), odd):
        for _, stage in C.STAGES:
            data = C.materialise(stage(spark, data, ""), "odd")
        data.count()


def test_near_duplicates_of_null_and_repeated_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(None, a, "en", "s", 1), (None, a, "en", "t", 1), (None, b, "en", "s", 1), (7, b, "en", "s", 1),
            (5, c, "en", "s", 1), (5, c, "en", "s", 1), (5, a + " z", "en", "s", 1), (9, None, None, None, None), (8, "", None, None, None)]
    kept = C.drop_near_duplicates(spark, spark.createDataFrame(rows, docs.schema), "").collect()
    # a: the row with an id, near to the two without one; b: likewise; c: one of two equal rows; one of the empty texts
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(5, a + " z"), (7, b), (5, c), (8, "")])


@pytest.mark.parametrize("n", range(1, 14))
def test_registered(n):
    assert sum(k.startswith(f"op{n}_") for k in E.queries()) == 1
