"""A corpus pipeline over ``documents``: each stage calls one operator of ``sluice.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``;
all but the last return the columns of documents. What a stage returns is
written as a table in the shared folder and read by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, language_id, line_templates, mixing, simhash
from sluice.llm.common import crc32_of, materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; undetermined and narrowly decided ones go.

    Fitted on the rows of ``docs`` whose crc32 of the id is not 2 modulo 4.
    Without any labelled row nothing can be decided and all rows stay.
    """
    model = language_id.fit(docs.where(crc32_of("doc_id") % 4 != 2))
    if not model.dictionaries:
        return docs
    return language_id.identify(docs, model).where(~F.col("rejected")).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates; n_chars follows the text. All rows stay."""
    done = line_templates.drop_recurring_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the least id, null
    ids last; of rows that share it, one. Rows are told apart by a number of
    their own, so repeated and null ids are documents like any other."""
    rows = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")
    found = simhash.near_duplicates(rows.select(place.alias("doc_id"), "text"), shingle=4, max_bits=4)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id.__row")
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, as rows; a copy taken in part has its text cut to the words taken."""
    mixed = mixing.cut_text(mixing.mix(docs))
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids of every text, and the digest of the bytes that the ids decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", "lang", "source", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: SQL cannot express the models, clusterings and codes of the stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order on all of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
    return docs
