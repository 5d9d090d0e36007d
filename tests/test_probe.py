"""CSV structure check: one case per rejection and per reader quirk, from
texts and from files, and against Python's ``csv`` module."""

import csv
import io
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from sluice.functions import messages as M
from sluice.sources import csv_files as CSV
from sluice.sources import landing as LD
from sluice.sources import lines as LN

CASES = {
    "clean": (b"a,b,c\n1,2,3\n4,5,6\n", ["a", "b", "c"], 2, None),
    "empty": (b"", None, None, M.EMPTY_FILE),
    "mark only": (b"\xef\xbb\xbf", None, None, M.EMPTY_FILE),
    "header only": (b"a,b,c\n", None, 0, M.NO_DATA_ROWS),
    "header without break": (b"a,b", None, 0, M.NO_DATA_ROWS),
    "blank name": (b"a,,c\n1,2,3\n", ["a", "", "c"], 1, M.BLANK_COLUMN_NAME),
    "blank first line": (b"\n1,2\n", None, 1, M.NO_HEADER),
    "semicolon": (b"a;b\n1;2\n", ["a;b"], 1, M.NOT_COMMA_SEPARATED),
    "tab": (b"a\tb\n1\t2\n", ["a\tb"], 1, M.NOT_COMMA_SEPARATED),
    "pipe": (b"a|b\n1|2\n", ["a|b"], 1, M.NOT_COMMA_SEPARATED),
    "not utf-8": ("a,b\nCaf\xe9,1\n".encode("cp1252"), None, None, M.NOT_UTF8),
    "not utf-8, both breaks": ("a,b\r\nCaf\xe9,1\r\n".encode("cp1252"), None, None, M.NOT_UTF8),
    "byte order mark": (b"\xef\xbb\xbfa,b\n1,2\n", ["a", "b"], 1, None),
    "mark, no last break": (b"\xef\xbb\xbfa,b\n1,2", ["a", "b"], 1, None),
    "quoted line break": (b'a,b\n"x\ny",1\n', ["a", "b"], 1, None),
    "carriage returns": (b'a,b\r"x\ry",1\r2,3\r', ["a", "b"], 2, None),
    "both breaks": (b'a,b\r\n"x\r\ny",1\r\n2,3\r\n', ["a", "b"], 2, None),
    "header in lines": (b'"first\nname",b\n1,2\n', ["first\nname", "b"], 1, None),
    "header of doubled quotes": (b'"a ""x""",b\n1,2\n', ['a_"x"', "b"], 1, None),
    "repeated names": (b"a,b,a\n1,2,3\n", ["a", "b", "a"], 1, None),
    # Python's csv counts blank lines; Spark's reader skips them (reported, not failed).
    "blank lines": (b"a,b\n1,2\n\n3,4\n", ["a", "b"], 3, None),
    "quote inside a cell": (b'a,b\nx"y,1\nz",2\n', ["a", "b"], 2, None),
    "spreadsheet names": (b"Project ID, Start-Date \n1,2\n", ["project_id", "start_date"], 1, None),
}


def file_structure(spark, folder, **options):
    files = LD.inventory(spark, {"d": str(folder)}, min_age_seconds=0)
    paths = [r[0] for r in files.where("file_size_bytes > 0").select("stored_file_path").collect()]
    return {r["original_file_name"][:-4]: r for r in CSV.file_structure(spark, files, paths).collect()}


def test_cases(spark, tmp_path):
    for name, (data, *_) in CASES.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
    got = {k: (r.header, r.row_count, r.violation) for k, r in file_structure(spark, tmp_path).items()}
    assert got == {k: v[1:] for k, v in CASES.items()}


def random_texts(n, seed=5):
    rng = random.Random(seed)
    parts = ["a", "b", ",", '"', '""', "\n", "\r", "\r\n", " ", "x,", '"y",', "é"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def own_name(name):
    return "_".join(p for p in re.split(r"[ \-./_]+", name.strip().lower()) if p)


def expected(text):
    rows = list(csv.reader(io.StringIO(text, newline="")))
    after = len(rows) - 1 if rows else None
    return after, [own_name(c) for c in rows[0]] if after and rows[0] else None


def test_texts_as_python_reads_them(spark):
    texts = [*random_texts(400), "a,b\n" + "1,2\n" * 5000, "a,b\n" + '"1\n2",3\n' * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {r.k: (r.row_count, r.header) for r in CSV.text_structure(df, "k", "t").collect()}
    assert got == {k: expected(t) for k, t in enumerate(texts)}


def test_blocks_do_not_matter(spark, tmp_path):
    """Files cut into many blocks have the structure, and the records, of whole ones."""
    rng = random.Random(8)
    wanted = {}
    for i in range(4):
        rows = [["id", "text"]] + [[str(k), rng.choice(["plain", "two\nlines", 'a "quoted" one', "x,y", "\n\n", "", "a\r\nb"])] for k in range(3000)]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"])).writerows(rows)
        (tmp_path / f"f{i}.csv").write_bytes(out.getvalue().encode())
        wanted[f"f{i}"] = rows[1:]
    (tmp_path / "open.csv").write_text('id,text\n1,"never closed\n' + "2,x\n" * 3000)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        structure = file_structure(spark, tmp_path)
        paths = [str(tmp_path / f"{k}.csv") for k in wanted]
        assert LN.file_lines(spark, paths).select("file", "block").distinct().count() > 40
        records = LN.records(spark, paths)
        found = records.select(F.regexp_extract("file", r"([^/]*)\.csv$", 1).alias("f"), "record_no", LN.cells(F.col("record")).alias("c")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, rows in wanted.items():
        assert (structure[name].header, structure[name].row_count, structure[name].multiline) == (["id", "text"], 3000, True)
        got = {r.record_no: r.c for r in found if r.f == name}
        assert [got[i + 1] for i in range(3000)] == rows
    assert structure["open"].row_count == 1


def test_records_equal_the_multiline_reader(spark, tmp_path):
    rows = [["id", "text", "n"]] + [[str(k), ["plain", "two\nlines", 'a "q"', "x,y", "", " pad "][k % 6], "é"] for k in range(500)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows(rows)
    text = out.getvalue() + "\n  \nshort,1\nlong,1,2,3\n"
    (tmp_path / "f.csv").write_bytes(text.encode())
    spark_rows = CSV.read_permissive(spark, [str(tmp_path / "f.csv")], ["id", "text", "n"]).drop("_file_path").collect()
    own = CSV.read_records(spark, [], [str(tmp_path / "f.csv")])
    own = own.select(CSV.parse_cells(F.col("_text"), 3).alias("c"), F.when(LN.n_cells(F.col("_text")) != 3, F.col("_text")).alias("t")).collect()
    assert sorted(map(repr, [tuple(r) for r in spark_rows])) == sorted(map(repr, [(*r.c, r.t) for r in own]))


def test_unreadable_file_among_good_ones(spark, tmp_path):
    """A file whose bytes do not match its checksum is reported by itself."""
    for i in range(3):
        (tmp_path / f"good{i}.csv").write_text("a,b\n" + f"{i},2\n" * 10)
    spark.range(3000).selectExpr("concat(id, ',x')").coalesce(1).write.text(str(tmp_path / "w"))
    part = next(p for p in os.listdir(tmp_path / "w") if p.startswith("part-"))
    data = (tmp_path / "w" / part).read_bytes()
    os.rename(tmp_path / "w" / f".{part}.crc", tmp_path / ".rotten.csv.crc")
    (tmp_path / "rotten.csv").write_bytes(data[:100] + b"#" + data[101:])
    got = file_structure(spark, tmp_path)
    assert "could not be read to its end" in got["rotten"].unreadable and got["rotten"].violation is None
    assert [(got[f"good{i}"].unreadable, got[f"good{i}"].row_count) for i in range(3)] == [(None, 10)] * 3


@pytest.mark.parametrize("text,cells", [("a,b", ["a", "b"]), (',"x,""y""",', ["", 'x,"y"', ""]), ('"a"b"c,d', ['ab"c', "d"]), ("", []), (" ", [" "])])
def test_cells(spark, text, cells):
    r = spark.createDataFrame([(text,)], "t string").select(LN.cells(F.col("t")).alias("c"), LN.n_cells(F.col("t")).alias("n")).first()
    assert r.c == cells and r.n == max(1, len(cells))


def test_check_matches_python_on_documents(spark):
    """Brute force: the distributed check equals python csv on every document."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: (r["row_count"], r["header"]) for r in CSV.text_structure(docs, "doc_id", "text").collect()}
    assert got == {r["doc_id"]: expected(r["text"]) for r in docs.select("doc_id", "text").collect()}


def test_file_of_any_size_is_hashed(spark, tmp_path):
    """A sparse file of more bytes than a cell can hold, beside a small one."""
    import hashlib

    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    size = 2**31 + 5
    with open(tmp_path / "huge.csv", "wb") as f:
        f.truncate(size)
    hashed = {r.original_file_name: r for r in LD.hash_files(spark, LD.inventory(spark, {"d": str(tmp_path)}, min_age_seconds=0)).collect()}
    digest = hashlib.sha256()
    for _ in range(size >> 20):
        digest.update(bytes(1 << 20))
    digest.update(bytes(size & (1 << 20) - 1))
    assert (hashed["huge.csv"].file_hash, hashed["huge.csv"].read_error) == (digest.hexdigest(), None)
    assert hashed["good.csv"].file_hash == hashlib.sha256(b"a,b\n1,2\n").hexdigest()


def test_line_too_long_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(LN, "LONGEST_LINE", 1 << 20)
    (tmp_path / "good.csv").write_text("a,b\n1,2\n")
    (tmp_path / "long.csv").write_bytes(b"a,b\n" + bytes(20 << 20))
    got = file_structure(spark, tmp_path)
    assert "could not be read to its end" in got["long"].unreadable
    assert (got["good"].unreadable, got["good"].row_count) == (None, 1)


def test_chunked_hash_of_files_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("a,b\n1,2\n")
    (tmp_path / "gone.csv").write_text("a,b\n")
    files = LD.inventory(spark, {"d": str(tmp_path)}, min_age_seconds=0)
    rows = spark.createDataFrame(files.collect(), files.schema)
    os.remove(tmp_path / "gone.csv")
    got = {r.original_file_name: r for r in LD.hash_files(spark, rows, whole=0).collect()}
    assert len(got["a b.csv"].file_hash) == 64 and got["a b.csv"].read_error is None
    assert got["gone.csv"].file_hash is None and "FileNotFoundError" in got["gone.csv"].read_error
