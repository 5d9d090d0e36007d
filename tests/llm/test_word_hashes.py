"""Words of regular sequences keep hashes of their own, and so do what is built on them."""

import numpy as np
import pyarrow as pa

from sluice.llm import common as C
from sluice.llm import search, substring_dedup


def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s, s.translate(str.maketrans("ab", "ba"))


def hashed(text, seed=0):
    raw, offsets = C.text_buffer(pa.array([text]))
    starts, ends, _ = C.word_spans(raw, offsets)
    return C.word_hashes(raw, starts, ends, seed)


def test_words():
    a, b = thue_morse(1024)
    words = [a, b, a + a, a + b, "x", "xx", "x\x00", "é", "a" * 8, "a" * 9, "a" * 16, "a" * 24, "b" * 8 + "a" * 8, "a" * 8 + "b" * 8]
    for seed in (0, 1):
        h = hashed(" ".join(words + words), seed)
        assert len(set(h.tolist())) == len(words) and (h[:len(words)] == h[len(words):]).all()
    assert not np.intersect1d(hashed(" ".join(words)), hashed(" ".join(words), 1)).size
    long = "q" * (3 << 20)  # over several pieces
    assert len(set(hashed(f"{long} {long}r x").tolist())) == 3


def test_windows_that_differ_in_one_such_word_stay(spark):
    a, b = thue_morse(1024)
    same = " ".join(f"w{i}" for i in range(34))
    docs = spark.createDataFrame([(1, f"{same} {a}"), (2, f"{same} {b}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeats(docs, window=35).collect()] == [0, 0]


def test_search_finds_only_the_term(spark):
    a, b = thue_morse(1024)
    docs = spark.createDataFrame([(1, a), (2, b), (3, "c")], "doc_id long, text string")
    found = search.top_k(docs, docs.where("doc_id = 1"), k=3).collect()
    assert [r.doc_id for r in found if r.score > 0] == [1]
