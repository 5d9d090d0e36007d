"""Uploads of documents as CSV files: many files of a bounded size, put in order by small parts."""

import hashlib
import os

import pandas as pd
import pytest

from sluice.plans import fixtures as FX
from sluice.plans import registry
from sluice.sources import lines as LN

TEXTS = ["plain", 'say "it", twice', "a\nb\nc\nd\ne\nf\ng\nh\ni\nj", '"\n""\n\n"', "", None, "x, y\r\nz", "long " * 100]


@pytest.fixture
def tables(tmp_path):
    rows = [(i, TEXTS[i % len(TEXTS)], "en", "web", 1) for i in [*range(160), 7, 7, 2]]
    pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).to_parquet(tmp_path / "documents.parquet")
    return str(tmp_path), rows


def test_large_uploads_are_many_files_and_small_parts(spark, tables, monkeypatch):
    monkeypatch.setattr(FX, "DOCUMENT_FILE_BYTES", 3000)
    monkeypatch.setattr(LN, "PART_BITS", 2)
    sf_dir, rows = tables
    folder = FX.document_csv(spark, sf_dir)["texts"].removeprefix("file:")
    sizes = {f: os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".csv")}
    # about three kilobytes each, not four files of about a quarter of the table
    assert len(sizes) > 8 and {f[:2] for f in sizes} == {"D0", "D1", "D2", "D3"} and max(sizes.values()) < 3 * 3000
    want = {}
    for doc_id, text, lang, *_ in rows:
        body = f'{text or ""}\nin "{lang}"'
        n, chars, digest = want.get(f"D{doc_id % 4}", (0, 0, 0))
        want[f"D{doc_id % 4}"] = n + 1, chars + len(body), digest + int(hashlib.md5(body.encode()).hexdigest()[:8], 16)
    got = registry.QUERIES["bronze_spanning_records"](spark, sf_dir).collect()
    assert {r.upload_id: (r.n_rows, r.n_chars, r.sum_digest) for r in got} == want
    assert all(r.n_corrupt == 0 for r in got)


def test_another_cut_of_the_files_is_noticed(spark, tables, monkeypatch):
    folder = FX.document_csv(spark, tables[0])["texts"]
    blocks = LN.blocks

    def cut_otherwise(lines, within=()):
        return blocks(lines.where("id % 5 <> 3"), within)

    monkeypatch.setattr(LN, "blocks", cut_otherwise)
    with pytest.raises(Exception, match="split otherwise"):
        LN.records(spark, [folder]).collect()
