"""The operators against brute force, exact round trips and edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice.llm import bpe, embedding_dedup, language_id, line_templates, mixing, search, simhash, substring_dedup, token_codes, toxicity
from sluice.llm.components import components
from sluice.plans.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, ids string"


def texts(seed=3, n=60):
    """Random texts over a few words with copies, shared passages, nulls and odd white space."""
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma,", "x1", "é", "don't", "日本", "long" * 5]
    passage = " ".join(rng.choice(words) for _ in range(50))
    out = [None, "", " \t\n", "one", "\x1cw\x0b z"]
    for i in range(n):
        t = " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(rng.randrange(1, 90)))
        out.append(t + ("\n" + passage + " " + t[:20] if i % 4 == 0 else ""))
    out += [out[7], out[7], out[12] + "  end", "word " * 3000, "a <|endoftext|> b", "<|endoftext|>", "x, <|endoftext|>. y <|endofte xt|>"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, 1, "x") for i, t in enumerate(texts())]
    rows += [(None, "null id here", None, None, None, None, None), rows[9], rows[9]]  # null id, repeated rows; clashing extra columns
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def kept_words(all_texts, window=35):
    words = [WORD.findall(t or "") for t in all_texts]
    count = collections.Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def test_cover_has_every_difference():
    p, d = substring_dedup.PERIOD, substring_dedup.COVER
    assert {(a - b) % p for a in d for b in d} == set(range(p))


def test_substring_dedup(docs, empty):
    rows = docs.collect()
    want = collections.Counter((r.doc_id, *k) for r, k in zip(rows, kept_words([r.text for r in rows])))
    got = substring_dedup.remove_repeats(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert all(sum(x.end_word - x.first_word for x in r.removed) == r.n_removed for r in got)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_bpe_round_trip(docs, empty):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.decode(bpe.encode(docs, path, P.PATTERN), path, P.PATTERN).collect():
        assert r.ids == enc.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(empty, path, P.PATTERN, decoded=True).count() == 0
    many = docs.sparkSession.range(0, 2300, 1, 1).selectExpr("id AS doc_id", "concat('row ', id) AS text")  # one batch, several slices
    rows = bpe.encode(many, path, P.PATTERN, decoded=True).collect()
    assert sorted(r.doc_id for r in rows) == list(range(2300))
    assert all(bytes(r.decoded).decode() == r.text and r.ids == enc.encode_ordinary(r.text) for r in rows)
    own, rng = bpe.ByteBPE(ranks, P.PATTERN), random.Random(1)
    odd = ["a" * 5000, "ab" * 700 + "\n\n  x", "'s 't  don't'", "　a\x85b"] + ["".join(rng.choice("ab c\n.,é'") for _ in range(200)) for _ in range(200)]
    assert [x.tolist() for x in own.encode(odd)] == [enc.encode_ordinary(t) for t in odd]


def test_token_codes(spark, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert tok.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    path = scratch_path(spark, "codes")
    token_codes.write_tokens(docs, path, P.path("byte_bpe_50k.json"), end_id=2, shard_tokens=500)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    ids = [[*tok.encode(r.text or "", add_special_tokens=False).ids, 2] for r in rows]
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    got = sorted(token_codes.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids_le)) for r in got] == [
        (r.doc_id, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, s, x in zip(rows, starts, ids)]
    flat = [x for d in ids for x in d]
    at = spark.range(0, len(flat) + 5, 3).select(F.col("id").alias("pos"))
    assert {r.pos: r.token for r in token_codes.read_tokens_at(spark, path, at).collect()} == {p: flat[p] for p in range(0, len(flat), 3)}
    path = scratch_path(spark, "codes")
    token_codes.write_tokens(empty, path, P.path("byte_bpe_50k.json"), end_id=2)
    assert token_codes.read_documents(spark, path).count() == 0


def test_codes_of_wide_ids():
    ids = np.random.default_rng(0).choice([0, 255, 256, 70_000, 2**32 - 1], 5000).astype(np.uint32)
    levels = token_codes.pack(ids)
    assert (token_codes.unpack(levels) == ids).all() and len(levels) == 4
    at = np.random.default_rng(1).integers(0, 5000, 300)
    assert (token_codes.access(levels, at) == ids[at]).all()


def test_mix(spark, docs, empty):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 60), rng.choice(["a", "b", "b", "b", "c", None, "é"])) for i in range(400)] + [(7, "w w", "a"), (None, None, None)]
    data = spark.createDataFrame(rows, "doc_id long, text string, source string")
    whole = mixing.mix(data, keep_untaken=True).collect()
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    names = sorted([s for s in size if s is not None]) + [None] * (None in size)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(size.values()))
    while free:  # share, cap, share the excess again
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * size[s]}
        target.update({s: 3.0 * size[s] if s in over else weight[s] * level for s in (over or free)})
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    taken = collections.Counter()
    for r in whole:
        taken[r.source] += r.taken
        assert r.taken <= r.size and r.target == pytest.approx(target[r.source])
    assert all(abs(taken[s] - target[s]) < 1.001 for s in names)
    copies = sorted((r for r in whole if r.copy is not None), key=lambda r: r.position)
    assert [r.position for r in copies] == np.cumsum([0, *(r.taken for r in copies)])[:-1].tolist()
    assert [min(r.virtual_finish, 1) for r in copies] == sorted(min(r.virtual_finish, 1) for r in copies)
    again = mixing.mix(data, keep_untaken=True).collect()
    assert sorted(map(str, whole)) == sorted(map(str, again))
    assert mixing.mix(docs).count() > 0 and mixing.mix(empty).count() == 0


def fingerprint(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(n, links):
    least = list(range(n))
    while True:
        new = least[:]
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == least:
            return least
        least = new


@pytest.mark.parametrize("piece", [4096, 5])
def test_simhash(spark, docs, empty, piece, monkeypatch):
    monkeypatch.setattr(simhash.links_within, "__defaults__", (4, 2, piece))
    rows = [r for r in docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()]
    more = [Row(doc_id=1000 + i, text=rows[20].text + f" tail{i}") for i in range(30)]
    rows = [Row(doc_id=r.doc_id, text=r.text) for r in rows] + more
    bits = [fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(bits)) for j in range(i) if (bits[i] ^ bits[j]).bit_count() <= 4]
    want = {rows[i].doc_id: (bits[i], rows[c].doc_id) for i, c in enumerate(reach(len(rows), links))}
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.fingerprint % 2**64, r.component_id) for r in got} == want
    assert simhash.near_duplicates(docs).count() == docs.count() and simhash.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(999, i) for i in range(300, 340)] + [(i, i + 1) for i in range(400, 460)]
    least = reach(1000, pairs)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: least[x] for p in pairs if p[0] != p[1] for x in p}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "beam": 4}])
def test_embeddings(spark, options):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 8))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 8)) * 0.1, np.repeat(base[:1], 50, 0) + rng.normal(size=(50, 8)) * 0.05, base[3:6]])
    rows = [(i, v.tolist(), i % 2 if i < 120 else 0) for i, v in enumerate(x)]
    odd = [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0), (903, [None] + [1.0] * 7, 0), (904, x[0].tolist(), None), (905, [], 0), (906, [1.0], 0)]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    least = reach(len(x), list(zip(*np.nonzero(near))))
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int"), **options).collect()}
    assert sum(r.n_links for r in got.values()) >= 0.99 * near.sum() and all(got[i].n_links <= near[i].sum() for i in range(len(x)))
    if got and sum(r.n_links for r in got.values()) == near.sum():
        assert all((got[i].component_id, got[i].kept) == (c, c == i) for i, c in enumerate(least))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, *_ in odd)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_line_templates(spark, docs, empty):
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice([f"Page {rng.randrange(9)} of 10", "All rights reserved.", "", f"own line {i} " + "abcdefgh"[rng.randrange(8)], f"Posted by user{i} today"]) for _ in range(rng.randrange(1, 6)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n")]
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def shape(line):
        w = WORD.findall(line)
        return tuple("#" if re.search("[0-9]", x) else x for x in w)

    seen = set()
    for i, t in rows:
        if t is None:
            assert (got[i].text, got[i].n_lines, got[i].n_dropped) == (None, 0, 0)
            continue
        keep = []
        for line in t.split("\n"):
            s = shape(line)
            if s[:1] in (("Page",), ("All",), ("Posted",)):
                if s in seen:
                    continue
                seen.add(s)
            keep.append(line)
        if not any(x.startswith("own") for x in t.split("\n")):
            assert got[i].text == "\n".join(keep)
    assert line_templates.drop_recurring_lines(docs).count() == docs.count() and line_templates.drop_recurring_lines(empty).count() == 0


def test_lines_copied_in_few_documents(spark):
    """Two documents are enough for a line that is the same word for word, digits included; like lines are no copies."""
    rows = [
        (1, "a passage of some words\nshared 7 times\nown one"), (2, "shared  7 times\nown two\na passage of some words"),
        (3, "shared 8 times\ntwice in here\ntwice in here"), (4, "a passage of other words\n"), (5, "own two"), (None, "own two\n")]
    got = line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got} == {
        1: (rows[0][1], 3, 0), 2: ("own two", 3, 2), 3: (rows[2][1], 3, 0), 4: (rows[3][1], 2, 0), 5: ("", 1, 1), None: ("", 2, 1)}


def test_search(spark, docs, empty):
    rows = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text")
    data = rows.collect()
    terms = {r.doc_id: collections.Counter(WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or ""))) for r in data}
    df = collections.Counter(t for c in terms.values() for t in c)
    n, avg = len(terms), sum(sum(c.values()) for c in terms.values()) / len(terms)
    want = []
    for q in [d for d in terms if d % 10 == 0]:
        score = {}
        for d, c in terms.items():
            s = sum(w * np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / avg)) for t, w in terms[q].items() if t in c)
            if s:
                score[d] = round(float(s), 6)
        want += [(q, i + 1, d) for i, d in enumerate(sorted(score, key=lambda d: (-score[d], d))[:10])]
    got = search.top_k(rows, rows.where("doc_id % 10 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.doc_id) for r in got) == sorted(want)
    assert search.top_k(empty, empty).count() == 0 and search.top_k(docs, empty).count() == 0 and search.top_k(docs, docs).count() > 0


def test_search_in_waves(spark, monkeypatch):
    """Many shards, searched in waves with carried scores: as one shard does, ties and repeated documents included."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(400)], k=rng.randint(0, 60))) for _ in range(600)]
    rows = [(i, texts[i % 500], "x") for i in range(600)] + [(None, texts[3], "x"), (7000, None, "x"), (7001, " ".join(words * 20), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    asked = docs.where("doc_id % 20 = 0 OR doc_id = 7001")

    def result(k):
        return sorted((r.query_id, r.rank, r.doc_id, round(r.score, 5)) for r in search.top_k(docs, asked, k=k).collect())

    whole = {k: result(k) for k in (1, 10)}
    assert len(whole[10]) > 300 and all(r[2] is not None for r in whole[10])
    monkeypatch.setattr(search, "SHARD_BYTES", 4000)
    monkeypatch.setattr(search, "FIRST_WAVE", 2)
    monkeypatch.setattr(search, "QUERY_BYTES", 6000)
    assert len(search._waves(30)) == 4 and search._waves(1) == [0, 1]
    assert {k: result(k) for k in (1, 10)} == whole


def test_search_skips_segments_and_scores_exactly(monkeypatch):
    """Segments hold like documents and those that cannot reach a query's score are not computed; sums of single precision decide nothing."""
    rng = random.Random(11)
    kinds = [[f"{c}{i}" for i in range(300)] for c in "ab"]
    texts = [" ".join(rng.choices(kinds[i % 2], [1 / (j + 1) for j in range(300)], k=rng.randint(40, 90))) + " common" for i in range(600)]
    texts[50] = texts[52] = " ".join(f"a{i} " * 300 for i in range(60)) + "a7"  # large counts, equal but for one word
    texts[54] = texts[50] + " a299"
    texts[56] = texts[58] = texts[60]
    texts += [None, texts[50]]
    ids = [*range(601), None]
    asked = [0, 1, 50, 54, 60, 77, 301]
    counts = [collections.Counter((t or "").split()) for t in texts]
    df = collections.Counter(t for c in counts for t in c)
    average = sum(sum(c.values()) for c in counts) / len(texts)
    idf = {t: np.log(1 + (len(texts) - f + 0.5) / (f + 0.5)) for t, f in df.items()}

    def brute(q, k):
        found = []
        for i, c in zip(ids[:600], counts):
            score = sum(n * idf[t] * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / average)) for t, n in counts[q].items() if t in c)
            found.append((-round(float(score), 6), i))
        return [(i, -s) for s, i in sorted(x for x in found if x[0])[:k]]

    hashes = {t: search.word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0]), np.array([len(t)]))[0] for t in df}
    terms, weights = zip(*[(np.array([hashes[t] for t in counts[q]], np.uint64), np.array([n * idf[t] for t, n in counts[q].items()])) for q in asked])
    queries = search._Queries(asked, asked, terms, weights)
    packed = search._pack(search._index(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts})))
    for shared, frequent in ((128, 32), (1, 1), (10 ** 6, 10 ** 6)):  # by matrices and postings, only postings, only matrices
        monkeypatch.setattr(search, "SHARED", shared)
        monkeypatch.setattr(search, "FREQUENT", frequent)
        for k in (1, 7):
            best = search._Best(queries.least, k)
            ix = search._open(packed, queries, average, 1.2, 0.75)
            best.add(*search._search(ix, queries, best.least, k))
            q, found, score = best.found()
            assert [(asked[a], b, c) for a, b, c in zip(q, found.tolist(), score.tolist())] == [(x, *y) for x in asked for y in brute(x, k)]
            # with the scores known, segments of the other kind may hold anything: they are not taken up
            first = np.array([i is not None and i % 2 for i in ix["ids"].tolist()])
            other = {x % 2: search._open(packed, queries, average, 1.2, 0.75) for x in asked}
            for kind, spoilt in other.items():
                segments = spoilt["segments"]
                mixed = [len(set(first[a:z].tolist())) > 1 for a, z, _, _ in segments]
                assert len(segments) > 3 and sum(mixed) <= 1
                for (a, z, _, matrix), unlike in zip(segments, mixed):
                    if not unlike and first[a] != kind:
                        matrix[:] = 1e20
                mine = [i for i, x in enumerate(asked) if x % 2 == kind]
                for least, same in ((best.least, True), (queries.least, not sum(m.size for *_, m in segments))):
                    again = search._Best(least, k)
                    again.add(*search._search(spoilt, queries, least, k))
                    assert same == ((again.ids[mine] == best.ids[mine]).all() and (again.scores[mine] == best.scores[mine]).all())


def test_toxicity_of_any_letters():
    """Landmarks of hundreds of different letters are learnt; insults may be spelled out with any marks."""
    rng = random.Random(4)
    clean = ["".join(chr(0x4E00 + rng.randrange(400)) for _ in range(rng.randint(3, 6))) for _ in range(300)]
    bad = ["".join(chr(0x3041 + 7 * i + j) for j in range(6)) for i in range(8)]
    texts = [" ".join(rng.choices(clean, k=12)) for _ in range(160)]
    texts = [t + " " + rng.choice(bad) if i % 2 else t for i, t in enumerate(texts)]
    model = toxicity.train(texts, [i % 2 for i in range(160)])
    assert model.letters.size > 128 and len(model.letters.code) == model.letters.size - 1
    asked = [" ".join(rng.choices(clean, k=12)) for _ in range(20)]
    assert all(model.scores(asked) < 0.5)
    assert all(model.scores([a + " " + b[:3] + "x" + b[3:] for a, b in zip(asked, bad)]) >= 0.5)
    assert all(model.scores([a + " " + ".. ".join(b) for a, b in zip(asked, bad)]) >= 0.5)
    assert toxicity.tokens("v.. o.. z.. z") >= {"v.. o.. z.. z"}


def test_language(spark, docs, empty):
    rng = random.Random(5)
    vocab = {"aa": ["der", "und", "nicht", "ein", "haus", "strasse"], "bb": ["the", "and", "house", "street", "with", "for"]}
    rows = [(i, " ".join(rng.choice(vocab[k]) for _ in range(40)), k) for i in range(200) for k in [("aa", "bb")[i % 2]]]
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(data.where("doc_id % 4 != 0"))
    got = language_id.identify(data, model).where("doc_id % 4 = 0").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    odd = language_id.identify(spark.createDataFrame([(None,), ("",), ("12 !?",)], "text string"), model).collect()
    assert all((r.lang_pred, r.rejected) == ("und", True) for r in odd)
    assert language_id.identify(docs, language_id.fit(empty)).where("lang_pred != 'und'").count() == 0
    assert language_id.identify(empty, model).count() == 0


def test_unlearned_languages_are_rejected(spark):
    """Texts in an invented language and of random letters, of 25 words and more; clean documents stay."""
    rng = random.Random(11)
    data = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 50")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.fit(data.where(~held_out))
    syllable = lambda: rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") + rng.choice(["", *"lnrst"])
    vocab = ["".join(syllable() for _ in range(rng.randrange(1, 4))) for _ in range(2000)]
    letters = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10)))
    rows = [(f"{kind} {n}", " ".join(word() for _ in range(n))) for kind, word in (("invented", lambda: rng.choice(vocab)), ("letters", letters)) for n in (25, 100, 250, 1000) for _ in range(60)]
    found = language_id.identify(spark.createDataFrame(rows, "kind string, text string"), model)
    kept = {r.kind: r.kept for r in found.groupBy("kind").agg(F.avg((~F.col("rejected")).cast("int")).alias("kept")).collect()}
    assert len(kept) == 8 and max(kept.values()) <= 0.1 and max(v for k, v in kept.items() if k.endswith("250") or k.endswith("1000")) <= 0.02
    clean = language_id.identify(data.where(held_out), model).agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    assert clean <= 0.02
    short = language_id.identify(spark.createDataFrame([("zu",), ("kral bo",)], "text string"), model, min_margin=0.0).collect()
    assert all(r.rejected for r in short)


def test_toxicity(spark, docs, empty):
    rng = random.Random(6)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(300):
        w = [rng.choice(words) for _ in range(40)]
        if i % 4 == 0:
            w[rng.randrange(40)] = rng.choice(["vozzgack", "qwibbly"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    data = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int")
    model = toxicity.fit(data, marks)
    got = {r.doc_id: r.score for r in toxicity.score(data, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, y in labels if i % 5 == 0]) > 0.95
    clean = " ".join(words[:20])
    plain, marked, gapped = model.scores([clean, clean + " V.o-z.z.g.a.c.k", clean + " vozxzgack"])
    assert marked > 0.5 and gapped > plain
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(empty, toxicity.fit(empty, marks)).count() == 0


def test_substring_digest_query(spark):
    from sluice.llm.queries import QUERIES

    row = QUERIES["op2_substring_dedup"](spark, "/root/testdata/sf0.001").first()
    assert len(row.kept_sha256) == len(hashlib.sha256(b"").hexdigest())
