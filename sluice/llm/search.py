"""Exact top-k search: BM25 over inverted indexes per shard, bounded by segment.

A shard is a block of documents of bounded size with an inverted index of
its own. Within it, documents are ordered by a clustering of their frequent
terms and cut into segments, so that a segment holds similar documents; the
clusters are only an order and bear on no score. Shards are rows of a table
in the shared folder; nothing of the postings is shuffled. Document
frequencies, document count and average length are global, so a score does
not depend on the sharding.

A query comes with the score that a document must reach, its k-th best so
far. The largest part that each of its terms can give in a segment are added
up, and segments whose sum falls short are skipped. In the others, terms
that many pairs of query and document share are rows of a matrix: one
product gives their parts for many queries and all documents. The other
terms are added by postings, which lie in tables of padded rows by length, so
that a row is taken up whole. Both are sums of single precision whose error
is bounded; documents that may reach the score within that bound are the
candidates, and only these are scored in double precision.

The shards are searched in waves, each four times the one before. Shards of
one task share the k-th best score of a query, and a wave starts with those
that all waves before have found, so what a shard returns falls as more is
known, and rows grow with the queries, not with queries times shards. The
results are merged by query: exact, as every score is. Queries go to the
shards as broadcasts of bounded size; their number is not bounded.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import blocks as B
from sluice.llm.common import giving_back, giving_back_group, materialise, prepare, text_buffer, word_hashes, word_spans
from sluice.plans.session import scratch_path

SHARD_BYTES, QUERY_BYTES = 12_000_000, 48_000_000
#: Shards of the first wave at most, and how much larger the shards seen are after each further wave.
FIRST_WAVE, WAVE_GROWTH = 16, 4
#: Clusters of a shard, its segments besides one for each cluster, the documents of a cluster at least, and frequent terms that tell clusters apart.
CLUSTERS, SEGMENTS, CLUSTER_DOCS, CLUSTER_TERMS = 8, 8, 64, 512
#: Queries that are searched at a time, places for their scores, and more than any rounding to 6 digits.
_QUERIES, _PLACES, _SLACK = 128, 1_000_000, 1e-5
#: Postings that are added at a time, and the least sum of a document that has a term.
_POSTS, _TINY = 50_000, np.float32(1e-37)
#: A term is a row of a segment's matrix if one of so many documents has it, and one of so many pairs of query and document.
FREQUENT, SHARED = 32, 128
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _terms(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (term, row) of a text column, by term and row, and how often each occurs."""
    raw, offsets = text_buffer(column)
    raw = _LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    term = word_hashes(raw, starts, ends)
    rows = len(offsets) - 1
    counts = np.diff(first)
    del raw, starts, ends, first
    names, inverse = np.unique(term, return_inverse=True)
    del term
    key = inverse.astype(np.int64, copy=False)
    key *= rows
    key += np.repeat(np.arange(rows), counts)
    key, count = np.unique(key, return_counts=True)
    return names[key // max(1, rows)], (key % max(1, rows)).astype(np.int32), count.astype(np.int32)


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """start[0]..stop[0]-1, start[1]..stop[1]-1, ... in one array."""
    size = stop - start
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _clusters(name: np.ndarray, row: np.ndarray, part: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    """A cluster for each of n documents: k-means by the cosine of their most frequent terms."""
    k = min(CLUSTERS, n // CLUSTER_DOCS)
    if k < 2:
        return np.zeros(n, np.int64)
    m = min(CLUSTER_TERMS, len(df), max(8, 4_000_000 // n))
    top = np.argsort(-df, kind="stable")[:m]
    column = np.full(len(df), -1)
    column[top] = np.arange(m)
    at = np.flatnonzero(column[name] >= 0)
    x = np.zeros((n, m), np.float32)
    x[row[at], column[name[at]]] = part[at] * np.log(1 + n / df[name[at]])

    def scaled(y):
        return y / np.maximum(np.sqrt((y * y).sum(axis=1, keepdims=True)), 1e-9)

    x = scaled(x)
    centres = x[np.linspace(0, n - 1, k).astype(np.int64)]
    for _ in range(6):
        mine = (x @ centres.T).argmax(axis=1)
        centres = scaled(np.stack([x[mine == i].sum(axis=0) for i in range(len(centres))]))
    mine = (x @ centres.T).argmax(axis=1)
    held = np.flatnonzero(np.bincount(mine, minlength=k) >= CLUSTER_DOCS)
    return (x @ centres[held].T).argmax(axis=1) if len(held) else np.zeros(n, np.int64)


def _index(table: pa.Table) -> dict:
    term, row, count = _terms(table.column("text"))
    n = table.num_rows
    length = np.bincount(row, count, n)
    # terms come in order: documents by cluster, then length
    new = np.ones(len(term), bool)
    new[1:] = term[1:] != term[:-1]
    first = np.flatnonzero(new)
    cluster = _clusters(np.cumsum(new) - 1, row, count / (count + length[row] / max(1.0, length.mean())), np.diff(first, append=len(term)), n)
    order = np.lexsort((length, cluster))
    cuts = [0]
    for size in np.bincount(cluster).tolist():
        pieces = -(-size // max(CLUSTER_DOCS, -(-n // SEGMENTS)))
        cuts += [cuts[-1] + size * (i + 1) // pieces for i in range(pieces)]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    row = place[row]
    by = np.lexsort((row, term))
    return {
        "ids": table.column("doc_id").take(pa.array(order)).to_numpy(), "n": n, "length": length[order], "cuts": np.array(cuts),
        "terms": term[first], "term_post": np.append(first, len(term)).astype(np.int32), "doc": row[by].astype(np.int32),
        "count": count[by].astype(np.uint16 if count.max(initial=0) < 65536 else np.int64),
    }


def _pack(ix: dict) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(ix))


def _open(raw, queries: _Queries, average: float, k1: float, b: float) -> dict:
    """A shard's index ready for the search of queries, of the terms that they have: documents with a null id give nothing."""
    ix = pickle.loads(zstandard.ZstdDecompressor().decompress(raw))
    held, ix["asked"] = queries.places(ix["terms"])
    df = np.diff(ix["term_post"])
    post = _ranges(ix["term_post"][held], ix["term_post"][held + 1])
    doc, count, cuts, df = ix["doc"][post], ix["count"][post].astype(np.float64), ix["cuts"], df[held]
    part = count * (k1 + 1)
    count += (k1 * (1 - b + b * ix["length"] / average))[doc]
    part /= count
    del count, post
    ix["n_terms"], ix["name"], ix["doc"] = len(held), np.repeat(np.arange(len(held), dtype=np.int32), df), doc
    if ix["ids"].dtype.kind == "f":  # nulls among the ids
        null = np.isnan(ix["ids"])
        ix["ids"] = np.where(null, 0, ix["ids"]).astype(np.int64)
        part[null[doc]] = 0.0
    ix["part"] = part
    # entries: the postings of a term in a segment
    sizes = np.diff(cuts)
    segment = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[doc]
    name = ix["name"]
    new = np.ones(len(doc), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (name[1:] != name[:-1])
    entry = np.flatnonzero(new)
    if not len(entry):
        ix["segments"] = []
        return ix
    own, place, df = name[entry], segment[entry], np.diff(entry, append=len(doc))
    ix["most"] = np.zeros((len(held), len(sizes)), np.float32)
    ix["most"][own, place] = np.nextafter(np.maximum.reduceat(part, entry).astype(np.float32), np.float32(np.inf))
    # matrices of the segments: the rows are terms, a column is a document
    rows = (df * FREQUENT >= sizes[place]) & (df * queries.asked[ix["asked"]][own] * SHARED >= sizes[place] * len(queries.ids))
    often = np.unique(own[rows])
    ix["row"] = np.full(len(held), -1)
    ix["row"][often] = np.arange(len(often))
    ix["rows"], ix["segments"] = len(often), []
    part32 = part.astype(np.float32)
    for s in range(len(sizes)):
        e = np.flatnonzero(rows & (place == s))
        p = _ranges(entry[e], entry[e] + df[e])
        matrix = np.zeros((len(e), sizes[s]), np.float32)
        matrix[np.repeat(np.arange(len(e)), df[e]), doc[p] - cuts[s]] = part32[p]
        ix["segments"].append((int(cuts[s]), int(cuts[s + 1]), ix["row"][own[e]], matrix))
    # the other postings: tables by length, filled up with parts of 0
    left = np.flatnonzero(~np.repeat(rows, df))
    doc, part32 = doc[left], part32[left]
    size = np.bincount(name[left], minlength=len(held))
    first = np.cumsum(size) - size
    widths = [0]
    while widths[-1] < size.max():
        widths.append(widths[-1] + max(1, widths[-1] // 3))
    ix["width"] = np.searchsorted(widths, size).astype(np.uint8)
    ix["line"], ix["tables"] = np.zeros(len(size), np.int64), []
    by, ends = np.argsort(ix["width"], kind="stable"), np.cumsum(np.bincount(ix["width"], minlength=len(widths)))
    for i in range(1, len(widths)):
        mine, column = by[ends[i - 1]:ends[i]], np.arange(widths[i])
        ix["line"][mine] = np.arange(len(mine))
        at = first[mine, None] + column
        parts = part32.take(at, mode="clip") if len(at) else np.zeros(at.shape, np.float32)
        parts[column >= size[mine, None]] = 0
        ix["tables"].append((doc.take(at, mode="clip") if len(at) else np.zeros(at.shape, np.int32), parts))
    return ix


class _Queries:
    """Queries and what a document must reach for each: the terms of all as places in a sorted list."""

    def __init__(self, ids, hashes, terms, weights):
        self.ids, self.hashes = np.array(ids, np.int64), np.array(hashes, np.int64)
        sizes = [len(t) for t in terms]
        self.number, self.first = np.repeat(np.arange(len(terms), dtype=np.int32), sizes), np.append(0, np.cumsum(sizes))
        self.terms, inverse, self.asked = np.unique(np.concatenate(terms), return_inverse=True, return_counts=True)
        self.inverse = inverse.astype(np.int32)
        self.weights = np.concatenate(weights)
        self.least = np.zeros(len(terms))

    def places(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of a shard's terms that queries have, in the shard and here."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        held = np.flatnonzero(self.terms[at] == terms)
        return held, at[held]

    def hits(self, place: np.ndarray, a: int, z: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query (the first is 0), place in the index and weight of the terms of queries a to z that a shard has; ``place`` has each term's, or -1."""
        mine = slice(self.first[a], self.first[z])
        term = place[self.inverse[mine]]
        hit = np.flatnonzero(term >= 0)
        return self.number[mine][hit] - np.int32(a), term[hit], self.weights[mine][hit]


class _Best:
    """The k best documents of each query so far, and the score that a further one must reach."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k
        self.ids, self.scores = np.zeros((len(least), k), np.int64), np.full((len(least), k), -np.inf)

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(q):
            return
        own = np.unique(q)
        q = np.concatenate([np.repeat(own, self.k), q])
        ids, scores = np.concatenate([self.ids[own].ravel(), ids]), np.concatenate([self.scores[own].ravel(), scores])
        at = np.lexsort((ids, -scores, q))
        q, ids, scores = q[at], ids[at], scores[at]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        self.ids[q[keep], rank[keep]], self.scores[q[keep], rank[keep]] = ids[keep], scores[keep]
        self.least[own] = np.maximum(self.least[own], self.scores[own, -1])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, rank = np.nonzero(self.scores > -np.inf)
        return q, self.ids[q, rank], self.scores[q, rank]


def _below(x: np.ndarray) -> np.ndarray:
    """Numbers of single precision that are no larger."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _search(ix: dict, queries: _Queries, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, id and rounded score of every document of a shard that may be among the k best of a query."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if ix["segments"]:
        place = np.full(len(queries.terms), -1, np.int32)
        place[ix["asked"]] = np.arange(ix["n_terms"])
        wide = max(1, min(_QUERIES, _PLACES // ix["n"]))
        for a in range(0, len(least), wide):
            z = min(a + wide, len(least))
            hits = queries.hits(place, a, z)
            if len(hits[0]):
                own, doc, score = _search_some(ix, *hits, least[a:z], k)
                found.append((own + a, ix["ids"][doc], score))
    return tuple(np.concatenate(x) for x in zip(*found))


def _search_some(ix: dict, q: np.ndarray, term: np.ndarray, weight: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, with places of documents, for a few queries numbered from 0."""
    n, many = ix["n"], len(least)
    weight32 = weight.astype(np.float32)
    start = np.searchsorted(q, np.arange(many + 1))
    # sums of single precision are off by no more than this share of themselves
    off = np.minimum(1.0, (np.diff(start) + 8) * 2.0 ** -23)
    floor = np.maximum(_below(least * (1 - 2 * off) - _SLACK), _TINY)
    # what the terms can give in each segment; segments that cannot reach the score are closed
    some = np.flatnonzero(np.diff(start))
    open_ = np.zeros((many, len(ix["segments"])), bool)
    most = ix["most"].take(term, axis=0)
    most *= weight32[:, None]
    open_[some] = np.add.reduceat(most, start[some], axis=0) >= floor[some, None]
    del most
    if not open_.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    # terms that are rows of the segments' matrices
    sums = np.full((many, n), -np.inf, np.float32)
    row = ix["row"][term]
    at = np.flatnonzero(row >= 0)
    weights = np.zeros((ix["rows"], many), np.float32)
    weights[row[at], q[at]] = weight32[at]
    for s, (a, z, rows, matrix) in enumerate(ix["segments"]):
        asked = np.flatnonzero(open_[:, s])
        if 2 * len(asked) > many:
            sums[:, a:z] = weights[rows].T @ matrix
            sums[~open_[:, s], a:z] = -np.inf
        elif len(asked):
            sums[asked, a:z] = weights[rows].take(asked, axis=1).T @ matrix
    # the postings of the others
    flat = sums.reshape(-1)
    width, line, base = ix["width"][term], ix["line"][term], (q * n).astype(np.int32)
    by = np.argsort(width, kind="stable")
    ends = np.cumsum(np.bincount(width, minlength=len(ix["tables"]) + 1))
    for i, (docs, parts) in enumerate(ix["tables"]):
        mine = by[ends[i]:ends[i + 1]]
        step = max(1, _POSTS // docs.shape[1])
        for j in range(0, len(mine), step):
            own = mine[j:j + step]
            place = docs.take(line[own], axis=0)
            place += base[own, None]
            value = parts.take(line[own], axis=0)
            value *= weight32[own, None]
            np.add.at(flat, place.reshape(-1), value.reshape(-1))
    # candidates: those that may reach the score and, where many do, the k-th best of this shard
    own, doc = np.divmod(np.flatnonzero(sums >= floor[:, None]), n)
    much = np.flatnonzero(np.bincount(own, minlength=many) > k)
    if len(much):
        kth = np.partition(sums[much], n - k, axis=1)[:, n - k]
        floor[much] = np.maximum(floor[much], _below(kth * (1 - 2 * off[much]) - _SLACK))
        at = sums[own, doc] >= floor[own]
        own, doc = own[at], doc[at]
    if not len(own):
        return own, doc, np.zeros(0)
    score = _scores(ix, own, doc, start, term, weight)
    keep = (score > 0) & (score >= least[own])
    return own[keep], doc[keep], score[keep]


def _scores(ix: dict, q: np.ndarray, doc: np.ndarray, start: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The rounded score of each pair of a query and a document, by query: sums of double precision over the document's terms."""
    if "by_doc" not in ix:
        by = np.argsort(ix["doc"].astype(np.uint16) if ix["n"] < 65536 else ix["doc"], kind="stable")
        ix["by_doc"] = ix["name"][by], ix["part"][by], np.append(0, np.cumsum(np.bincount(ix["doc"], minlength=ix["n"]))), np.zeros(ix["n_terms"])
    names, parts, posts, weights = ix["by_doc"]
    score = np.empty(len(q))
    first = np.append(np.flatnonzero(np.diff(q, prepend=-1)), len(q))
    for a, z in zip(first.tolist(), first[1:].tolist()):
        mine = slice(start[q[a]], start[q[a] + 1])
        own = term[mine]
        weights[own] = weight[mine]
        for i in range(a, z):
            at = slice(posts[doc[i]], posts[doc[i] + 1])
            score[i] = weights[names[at]] @ parts[at]
        weights[own] = 0.0
    return np.round(score, 6)


def _waves(shards: int) -> list[int]:
    """The first shard of every wave, and their number."""
    ends = [shards]
    while ends[-1] > FIRST_WAVE:
        ends.append(-(-ends[-1] // WAVE_GROWTH))
    return [0, *reversed(ends)]


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
          query_id_col: str = "doc_id", query_text_col: str = "text", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """query_id, rank, doc_id, score: for every query with a match its ``k`` best documents.

    Terms are words with A-Z lower-cased; a query's terms count as often as
    they occur in it. Scores are rounded to 6 digits, ties go to the lesser
    id. Null and empty texts count as documents without terms and match
    nothing; rows with a null id count for the statistics and are not
    returned; queries with a null id are no queries; equal queries (id and
    text) are one, of queries with equal ids and other texts each gets its
    rows. Repeated documents are documents. Other columns are ignored. Ids
    are integers.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    count, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    out = "query_id long, rank int, doc_id long, score double"
    n = max(1, -(-(size or 0) // SHARD_BYTES))
    held = B.dealt(rows, n, "doc_id")
    ends = _waves(n)

    def build(table):
        wave = int(np.searchsorted(ends, table.column("__block")[0].as_py(), "right")) - 1
        ix = _index(table)
        return pa.table({"shard": pa.array([_pack(ix)], pa.binary()), "words": pa.array([int(ix["length"].sum())], pa.int64()), "wave": pa.array([wave], pa.int32())})

    shards = materialise(held.groupBy("__block").applyInArrow(giving_back_group(build), "shard binary, words long, wave int"), "search-shards", compression="none", partition="wave")
    words = shards.agg(F.sum("words")).first()[0]
    if not words:
        return spark.createDataFrame([], out)
    average = words / count

    def frequencies(batches):
        for batch in batches:
            for held_shard in batch.column(0):
                ix = pickle.loads(zstandard.ZstdDecompressor().decompress(held_shard.as_buffer()))
                df = np.diff(ix["term_post"])
                for i in range(0, len(ix["terms"]), 100_000):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ix["terms"][i:i + 100_000].view(np.int64)), pa.array(df[i:i + 100_000].astype(np.int64))], ["term", "df"])

    def query_terms(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                term, row, n = _terms(part.column(2))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["query_id", "h", "term", "n"])

    asked = queries.select(F.col(query_id_col).cast("long").alias("query_id"), F.xxhash64(query_text_col).alias("h"), F.col(query_text_col).alias("text"))
    asked = asked.where("query_id IS NOT NULL AND text IS NOT NULL").mapInArrow(query_terms, "query_id long, h long, term long, n long")
    asked = asked.dropDuplicates(["query_id", "h", "term"])
    df = shards.select("shard").mapInArrow(giving_back(frequencies), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.col("n") * F.log(1 + (F.lit(count) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = asked.join(df, "term").select("query_id", "h", F.struct("term", weight.alias("weight")).alias("t"))
    # one row per query; a query has at most as many terms as its text
    weighed = weighed.groupBy("query_id", "h").agg(F.sort_array(F.collect_list("t")).alias("t"))
    weighed = materialise(weighed.select("query_id", "h", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "queries")

    path = scratch_path(spark, "search-results")
    result = "chunk int, query_id long, h long, doc_id long, score double"
    best = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "doc_id")

    def search(chunk: int, wave: int, asked_now: _Queries) -> None:
        sent = spark.sparkContext.broadcast(asked_now)

        def run(batches):
            own = sent.value
            found = _Best(own.least, k)
            for batch in batches:
                for held_shard in batch.column(0):
                    found.add(*_search(_open(held_shard.as_buffer(), own, average, k1, b), own, found.least, k))
            rows, ids, scores = found.found()
            for i in range(0, len(rows), 100_000):
                q = rows[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(q), chunk, np.int32)), pa.array(own.ids[q]), pa.array(own.hashes[q]),
                    pa.array(ids[i:i + 100_000]), pa.array(scores[i:i + 100_000])], ["chunk", "query_id", "h", "doc_id", "score"])

        shards.where(F.col("wave") == wave).select("shard").mapInArrow(giving_back(run), result).write.mode("append").parquet(path)
        sent.unpersist()

    def search_all(chunk: int, rows: list) -> None:
        """All waves for the queries of a chunk, whose k-th best scores (one number per query) carry over."""
        ids, hashes, terms, weights = zip(*rows)
        asked_now = _Queries(ids, hashes, terms, weights)
        place = {x: i for i, x in enumerate(zip(ids, hashes))}
        for wave in range(len(ends) - 1):
            if wave:
                so_far = spark.read.schema(result).parquet(path).where(F.col("chunk") == chunk)
                for r in so_far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).collect():
                    asked_now.least[place[r.query_id, r.h]] = r.score
            search(chunk, wave, asked_now)

    chunk, held_rows, held_bytes = 0, [], 0
    for row in weighed.toLocalIterator():
        if held_rows and held_bytes + 16 * len(row.terms) > QUERY_BYTES:
            search_all(chunk, held_rows)
            chunk, held_rows, held_bytes = chunk + 1, [], 0
        held_rows.append((row.query_id, row.h, np.array(row.terms, np.int64).view(np.uint64), np.array(row.weights, np.float64)))
        held_bytes += 16 * len(row.terms)
    if not held_rows:
        return spark.createDataFrame([], out)
    search_all(chunk, held_rows)

    results = spark.read.schema(result).parquet(path)
    return results.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
