"""op11 to op13: hand-made cases and brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import filter_audit as FA
from sluice.llm import html_extract as H
from sluice.llm import vector_codes as V

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- pages ----

@pytest.fixture(scope="module")
def weights():
    return H.learn([[H.parse(e) for x in H.EXAMPLES for e in (x, f"<article>{x}</article>")]])


def marked(example):
    """The text between the marks of a labelled page, by a plain reading of its blocks."""
    inner = "".join(re.findall(r"<!--main-->(.*?)<!--/main-->", example, re.S))
    blocks = re.split(r"</?(?:h\d|p|li|ul|ol|div|section|header|blockquote|table|tr|td|figure|figcaption|dl|dt|dd|pre)\b[^>]*>", inner)
    return "\n".join(x for x in (" ".join(re.sub(r"<[^>]*>", "", b).split()) for b in blocks) if x)


@pytest.mark.parametrize("example", H.EXAMPLES)
def test_labelled_pages(weights, example):
    assert H.main_text(example, weights) == marked(example)


ARTICLE = "<h1>One &amp; two</h1><p>First  line<br>goes\non.</p><p>Second <b>bold</b>er &lt;word&gt;.</p><ul><li>item</li></ul>"
TEXT = "One & two\nFirst line goes on.\nSecond bolder <word>.\nitem"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   \n", ""), ("<html><body></body></html>", ""), ("<script>var a = 'x y z';</script><style>p{}</style>", ""),
    (f"<article>{ARTICLE}</article>", TEXT),
    (f"<body><nav><a>Home</a><a>All news of the day in one place</a></nav><main>{ARTICLE}</main><footer>Rights reserved by us and by nobody else</footer>", TEXT),
    (f"<body><div class='sidebar'><p>{'side words ' * 40}</p></div><div id=content>{ARTICLE}</div><form><p>{'form words ' * 40}</p></form></body>", TEXT),
    (f"<BODY><DIV CLASS=Post>{ARTICLE}</DIV><DIV ID='comments'><P>{'I think so too. ' * 50}</P></DIV>", TEXT),
    (f"<article>{ARTICLE}<section class='comments'><p>{'well said ' * 30}</p></section></article>", TEXT),
    (f"<article><h1>One &amp; two</h1><p>First  line<br>goes\non.</p><div class=ad><p>{'buy now ' * 30}</p></div><p>Second <b>bold</b>er &lt;word&gt;.</p><ul><li>item</li></ul></article>", TEXT),
    ("<article><p>cut off in a ta", "cut off in a ta"), ("<article><p>never closed <b>bold<p>next", "never closed bold\nnext"),
    ("just words without any tag &eacute;&#233;&nbsp;x", "just words without any tag éé x"), ("<article><p>a < b and 2 > 1</p></article>", "a < b and 2 > 1"),
    ("<article><!-- <p>hidden</p> --><p>shown</p><script>document.write('<p>no</p>')</script></article>", "shown"),
    ("<div>" * 3000 + "deep words here" + "</div>" * 3000, "deep words here"),
    (f"<article><p>{'long ' * 300_000}</p></article>", " ".join(["long"] * 300_000)),
])
def test_pages(weights, page, text):
    assert H.main_text(page, weights) == text


def test_extract(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "own", 5), (1, "u", f"<article>{ARTICLE}</article>", "own", 5), (None, None, None, None, None), (2, None, "", "x", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in H.extract(pages).select("page_id", "url", "text", "n_chars").collect()]
    assert sorted(got, key=repr) == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (2, None, "", 0)], key=repr)
    assert H.extract(pages.limit(0)).collect() == []


# -------------------------------------------------------------- filters ----

def brute_audit(docs, labels):
    quality, toxic = collections.defaultdict(set), collections.defaultdict(set)
    for i, q, t in labels:
        quality[i].add(q)
        toxic[i].add(t)
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    facts = []
    for i, t, part in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        facts.append((part or "", fails, i is not None and 1 in quality[i], i is not None and 1 in toxic[i]))
    out = {}
    for part in {f[0] for f in facts}:
        here = [f for f in facts if f[0] == part]
        shapley = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(here)
            for s, name in enumerate(order, 1):
                gone = [f for f in left if f[1][name]]
                kept = [f for f in left if not f[1][name]]
                fails = [f for f in here if f[1][name]]
                shapley[name] += len(gone)
                out[part, order, s] = [len(kept), len(gone), len(fails) - len(gone), sum(sum(f[1].values()) == 1 for f in fails),
                                       sum(f[2] for f in gone), sum(f[3] for f in gone), name]
                left = kept
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def test_audit(spark):
    rng = random.Random(6)
    texts = [None, "", "x", "a b " * 30, " ".join(f"w{i}" for i in range(60)), " ".join(f"W{i}" for i in range(60)), " ".join(f"$w{i}" for i in range(55)),
             "é " * 60, "\x0b\x1c z " * 50]
    docs = [(rng.choice([*range(150), None]), rng.choice(texts), rng.choice(["a", "b", "b", None, ""])) for _ in range(400)]
    docs += [docs[3]] * 150  # a third of all rows are one row
    docs += [(999, "only here", "c")]
    labels = [(rng.randrange(160), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)] + [(None, 1, 1)]
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, source string, kept string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in FA.audit(d, lab).collect()}
    assert got == brute_audit(docs, labels) and len(got) == 4 * 600
    assert FA.audit(d.limit(0), lab).collect() == []
    assert len(FA.audit(d, lab.limit(0)).collect()) == 4 * 600


def test_packed_fields_do_not_run_over():
    n = 255
    for kind in (0, 31, 1 | 32, 127):
        fields = FA.unpack(n * FA.packed(kind, 8), 8)
        assert set(fields) <= {0, n}
        assert FA.unpack(7 * FA.packed(kind, 16) + 60_000 * FA.packed(kind, 16), 16) == [60_007 * (f > 0) for f in fields]


# ---------------------------------------------------------------- codes ----

def brute_codes(rows, rounds=2):
    """Exact integers, all distances."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // 16
    parts = [[tuple(v[p * width:(p + 1) * width]) for p in range(16)] for _, v, _ in kept]
    books = [[x[p] for x in parts[:64]] for p in range(16)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        at = [[nearest(p, x[p])[1] for p in range(16)] for x in parts]
        for p in range(16):
            for k in range(len(books[p])):
                mine = [x[p] for x, a in zip(parts, at) if a[p] == k]
                if mine:
                    books[p][k] = tuple(sum(c) // len(mine) for c in zip(*mine))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by_label = [], collections.Counter()
    for (i, _, label), x in zip(kept, parts):
        found = [nearest(p, x[p]) for p in range(16)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    return sorted((i, c, e, by_label[label], digest) for i, c, e, label in out)


@pytest.mark.parametrize("n,dim,spread", [(300, 32, 1.0), (40, 16, 0.01), (200, 48, 1e6), (120, 16, 3e37)])
def test_codes(spark, n, dim, spread):
    rng = np.random.default_rng(n)
    vectors = (rng.standard_normal((n, dim)) * spread).astype(np.float32).round(2 if spread < 10 else 0)
    vectors[n // 2:n // 2 + n // 3] = vectors[1]  # ties and a hot vector
    rows = [(int(i), v.tolist(), int(i) % 3 if i % 4 else None) for i, v in zip(rng.permutation(n), vectors)]
    rows += [(900, None, 1), (901, [float("nan")] * dim, 1), (902, [float("inf")] + [0.0] * (dim - 1), None), (903, [None] + [0.0] * (dim - 1), 1)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, code string")
    got = sorted(tuple(r) for r in V.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    want = brute_codes(rows)
    if spread > 1e30:  # sums beyond a long are held at the largest one
        want = [(i, c, min(e, 2**63 - 1), min(le, 2**63 - 1), d) for i, c, e, le, d in want]
    assert [g[:3] for g in got] == [w[:3] for w in want] and got[0][4] == want[0][4]
    if spread < 1e30:
        assert got == want


def test_codes_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert V.compress(spark.createDataFrame([], schema)).collect() == []
    assert V.compress(spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], schema)).collect() == []
    rows = [(None, [1.0] * 20, None), (1, [0.5] * 20, None), (1, [0.5] * 20, 4), (2, [0.5] * 16, 4)]  # 20 is no multiple of 16; 16 is another length
    got = V.compress(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.error) for r in got) == [(0, 0), (1, 0), (1, 0)] and all(len(r.code) == 32 for r in got)
    empty = V.compress(spark.createDataFrame([(1, [], 1), (2, [], 1)], schema)).collect()
    assert [(r.code, r.error) for r in empty] == [("00" * 16, 0)] * 2


def test_slices_find_the_nearest():
    rng = np.random.default_rng(1)
    for width in (1, 4, 9):
        for entries in (1, 3, 64):
            book = rng.integers(-50, 50, (entries, width))
            points = np.concatenate([rng.integers(-400, 400, (500, width)), book])
            index, apart = V.PartIndex(book).nearest(points)
            every = ((points[:, None] - book[None]) ** 2).sum(axis=2)
            assert (apart == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()


def test_integers_of_sliced_columns():
    column = pa.array([[0.5, -0.001], None, [1.0, float("nan")], [2.0, 0.0]], pa.list_(pa.float32())).slice(1)
    whole, usable = V.integers(column, 2)
    assert usable.tolist() == [False, False, True] and whole.tolist() == [[512, 0] + [0] * 14]


def test_queries(spark):
    import __spark_entry__ as E

    q = E.queries()
    sf = "/root/testdata/sf0.001"
    assert q["op11_html_extraction"](spark, sf).columns == ["page_id", "url", "text", "n_chars"]
    audit = q["op12_filter_audit"](spark, sf)
    per_part = audit.groupBy("part", "filter_order").agg(F.min("kept").alias("kept"), F.sum("removed").alias("gone"))
    total = spark.read.parquet(f"{sf}/documents.parquet").groupBy(F.coalesce("source", F.lit("")).alias("part")).count()
    assert per_part.join(total, "part").where("kept + gone != count").count() == 0
    assert q["op13_vector_codes"](spark, sf).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
