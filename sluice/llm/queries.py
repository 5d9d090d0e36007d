"""The registered queries of these operators, with production parameters,
each over its whole table. ``ORACLE`` has DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    bpe, embedding_dedup, filter_audit, html_extract, language_id, line_templates, mixing, search, simhash, substring_dedup, token_codes, toxicity, vector_codes)
from sluice.llm.common import crc32_of
from sluice.plans.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_embedding_dedup")
def op1_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


@register("op2_substring_dedup", r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35),
k AS (SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS h FROM s),
d AS (SELECT r, i FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM d),
p AS (SELECT r, list(p) AS gone FROM c GROUP BY r),
o AS (
  SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
    CASE WHEN gone IS NULL THEN words ELSE list_transform(list_filter(range(1, len(words) + 1), lambda x: NOT list_contains(gone, x)), lambda x: words[x]) END AS kept
  FROM w LEFT JOIN p USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM o
""")
def op2_substring_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substring_dedup.remove_repeats(docs, window=35)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op3_token_codes")
def op3_token_codes(spark, sf_dir):
    path = scratch_path(spark, "token-codes")
    token_codes.write_tokens(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), path,
        public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_codes.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids_le").alias("ids_crc32"))


@register("op4_byte_bpe")
def op4_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return bpe.decode(coded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op5_source_mix", r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS k, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS lim FROM s),
x AS (
  SELECT *, sum(lim) OVER (ORDER BY lim / weight, source ROWS UNBOUNDED PRECEDING) - lim AS full_,
    sum(weight) OVER () - sum(weight) OVER (ORDER BY lim / weight, source ROWS UNBOUNDED PRECEDING) + weight AS open_, sum(source_size) OVER () AS total FROM w),
l AS (SELECT full_ AS lf, open_ AS lo FROM x WHERE lim * open_ >= (total - full_) * weight ORDER BY full_, open_ LIMIT 1),
t AS (
  SELECT source, source_size,
    CASE WHEN full_ < lf THEN CAST(lim AS DOUBLE) ELSE CAST(weight * (total - lf) AS DOUBLE) / CAST(lo AS DOUBLE) END AS target FROM x, l),
q AS (
  SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS start_
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, least(size, floor(target) - (start_ + n * source_size)) AS words, CAST(start_ + n * source_size + size AS DOUBLE) / target AS finish
  FROM q, (SELECT unnest([0, 1, 2]) AS n)),
p AS (
  SELECT *, sum(words) OVER (ORDER BY least(floor(finish * 1024), 1024), finish, k, n ROWS UNBOUNDED PRECEDING) - words AS position
  FROM c WHERE words > 0)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, q.target,
  CAST(coalesce(sum(words), 0) AS BIGINT) AS taken, CAST(min(position) AS BIGINT) AS first_position
FROM q LEFT JOIN p ON q.doc_id = p.doc_id GROUP BY ALL
""")
def op5_source_mix(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    copies = mixing.mix(docs, keep_untaken=True)
    return copies.groupBy("row", "doc_id", "size", "source_size", "target").agg(
        F.sum("taken").alias("taken"), F.min("position").alias("first_position")).drop("row")


@register("op6_simhash")
def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc32_of("doc_id") % 5 == 0
    labels = _table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@register("op8_line_templates")
def op8_line_templates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_templates.drop_recurring_lines(docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register("op9_search", r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
l AS (SELECT doc_id, sum(tf) AS dl FROM f GROUP BY doc_id),
n AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(dl) FROM l) / (SELECT count(*) FROM documents) AS avgdl),
i AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM f, n GROUP BY term, n),
s AS (
  SELECT q.doc_id AS query_id, f.doc_id, round(sum(q.tf * idf * f.tf * 2.2 / (f.tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM f AS q JOIN f USING (term) JOIN i USING (term) JOIN l ON l.doc_id = f.doc_id, n WHERE q.doc_id % 100 = 0 GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
""")
def op9_search(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.top_k(docs, docs.where("doc_id % 100 = 0"), k=10)


@register("op10_language_id")
def op10_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = crc32_of("doc_id") % 4 == 2
    model = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


@register("op11_html_extraction", r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|\z)', 1) AS body FROM pages),
b AS (SELECT page_id, url, regexp_split_to_array(body, '</?(?:p|h[1-6]|ul|ol|li|div|section)(?:\s[^>]*)?>') AS blocks FROM a),
d AS (
  SELECT page_id, url, list_filter(list_transform(blocks, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'),
    '\s+', ' ', 'g'))), lambda x: x <> '') AS lines FROM b),
t AS (SELECT page_id, url, coalesce(array_to_string(lines, chr(10)), '') AS text FROM d)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
""")
def op11_html_extraction(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


@register("op12_filter_audit", r"""
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)} AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (
  SELECT part, good, toxic, fails, [fails.A, fails.B, fails.C, fails.D, fails.E] AS bits, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT p.c || q.c || r.c || s.c || t.c AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.c, q.c, r.c, s.c, t.c])) = 5),
y AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
z AS (
  SELECT part, filter_order, step, n, good, toxic, bits, substr(filter_order, step, 1) AS c,
    bits[ascii(substr(filter_order, step, 1)) - 64] AS here,
    len(list_filter(range(1, step), lambda i: bits[ascii(substr(filter_order, i, 1)) - 64])) > 0 AS gone
  FROM g, y),
u AS (
  SELECT part, filter_order, step, c, coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (here AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (here AND len(list_filter(bits, lambda b: b)) = 1), 0) AS unique_fails,
    coalesce(sum(n) FILTER (here AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (here AND NOT gone AND toxic), 0) AS toxic_lost
  FROM z GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley FROM u
""")
def op12_filter_audit(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def _nearest(books: str) -> str:
    """SQL: the nearest entry of every part, as entry and squared distance."""
    return f"""
  SELECT r, part, y, least // 64 AS apart, least % 64 AS entry FROM (
    SELECT r, p.part, any_value(p.y) AS y, min(list_sum(list_transform(range(1, len(p.y) + 1), lambda i: (p.y[i] - e.y[i]) * (p.y[i] - e.y[i]))) * 64 + e.entry) AS least
    FROM p JOIN {books} AS e ON p.part = e.part GROUP BY r, p.part)"""


def _moved(books: str, assigned: str) -> str:
    """SQL: every entry as the floored mean of its parts; unused ones stay."""
    return f"""
  SELECT e.part, e.entry, coalesce(m.y, e.y) AS y FROM {books} AS e LEFT JOIN (
    SELECT part, entry, list(CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ORDER BY i) AS y FROM (
      SELECT part, entry, i, sum(y[i]) AS total, count(*) AS n FROM (SELECT part, entry, y, unnest(range(1, len(y) + 1)) AS i FROM {assigned}) GROUP BY ALL) GROUP BY ALL
  ) AS m ON e.part = m.part AND e.entry = m.entry"""


@register("op13_vector_codes", f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, part, z[part * len(z) // 16 + 1:(part + 1) * len(z) // 16] AS y FROM (SELECT r, z, unnest(range(0, 16)) AS part FROM v)),
b0 AS (SELECT part, r - 1 AS entry, y FROM p WHERE r <= 64),
a0 AS ({_nearest("b0")}),
b1 AS ({_moved("b0", "a0")}),
a1 AS ({_nearest("b1")}),
b2 AS ({_moved("b1", "a1")}),
a2 AS ({_nearest("b2")}),
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2),
c AS (SELECT r, string_agg(printf('%02x', CAST(entry AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(apart) AS BIGINT) AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN c USING (r), h
""")
def op13_vector_codes(spark, sf_dir):
    coded = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
