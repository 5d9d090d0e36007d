"""Language identification by compression.

Every language has raw-content dictionaries for zstandard, made of folded
training text (lower case, letters only). A text is folded the same way, cut
into short chunks so that the dictionary and not the text itself is what a
chunk is matched against, and each chunk of the whole text is compressed
with every language's dictionary; the language with the fewest bytes wins. A
text of a single chunk is compressed with several dictionaries per language,
whole, in halves and in quarters, for a finer measure. A margin (bytes saved to the second best, as a share)
below the model's ``min_margin`` is a rejection, and so is less than
``min_bytes`` saved each time the text is compressed, a floor for short texts.

The margin of a text in no learned language is chance: a few bytes, a smaller
share the longer the text. That of a clean text is many times larger, so the
fit measures it: dictionaries of one half of the sample, margins of texts of
the other half that they get right, and ``MARGIN_SHARE`` of the
``MARGIN_PERCENTILE`` of these is the least margin. With one language learned
there is no second best and nothing is rejected by margin.

Fitting reads a bounded sample (``Model`` parameters): per language one
document for each of ``sample_slots`` hash slots, at most ``sample_chars``
characters of each; scoring is map-only over all documents and whole texts.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import giving_back, prepare

_NOT_LETTERS = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"

#: The least margin of a model: this share of this percentile of clean margins, and never under the floor.
MARGIN_SHARE, MARGIN_PERCENTILE, MARGIN_FLOOR = 0.2, 5, 0.001


def fold(text: str) -> bytes:
    """Lower-case letters, everything else one space."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


class Model:
    """Dictionaries per language; bounded in size by its parameters."""

    def __init__(self, dictionaries: dict[str, list[bytes]], prior: dict[str, int], chunk: int = 300, min_margin: float = MARGIN_FLOOR):
        self.dictionaries, self.prior, self.chunk, self.min_margin = dictionaries, prior, chunk, min_margin
        self._compressors: dict[str, list] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_compressors": None}

    def _ready(self) -> dict[str, list]:
        if self._compressors is None:
            self._compressors = {}
            for lang, contents in self.dictionaries.items():
                self._compressors[lang] = []
                for content in contents:
                    params = zstandard.ZstdCompressionParameters.from_level(
                        9, dict_size=len(content), source_size=self.chunk, strategy=zstandard.STRATEGY_GREEDY, min_match=4, write_content_size=False)
                    raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    raw.precompute_compress(compression_params=params)
                    self._compressors[lang].append(zstandard.ZstdCompressor(dict_data=raw, compression_params=params))
        return self._compressors

    def sizes(self, text: str) -> tuple[dict[str, int], int]:
        """Compressed bytes of the whole text by language (none if it has no
        letter), and how many times the text is in them."""
        raw = fold(text)
        if not raw.strip() or not any(map(str.isalpha, raw.decode())):
            return {}, 1
        chunks = [raw[i:i + self.chunk] for i in range(0, len(raw), self.chunk)]
        few = len(chunks) == 1
        if few:
            chunks += [raw[len(raw) * i // n:len(raw) * (i + 1) // n] for n in (2, 4) for i in range(n)]
        return {
            lang: sum(len(c.compress(x)) for c in (own if few else own[:1]) for x in chunks)
            for lang, own in self._ready().items()}, 3 * max(map(len, self.dictionaries.values()), default=1) if few else 1

    def predict(self, text: str | None) -> tuple[str, float, float, float]:
        """Language, score (0 to 1), margin, and bytes saved each time the text
        is compressed; undetermined and 0 for null, no letters or no learned language."""
        sizes, times = self.sizes(text) if text else ({}, 1)
        if not sizes:
            return UNDETERMINED, 0.0, 0.0, 0.0
        order = sorted(sizes, key=lambda k: (sizes[k], -self.prior[k], k))
        best = sizes[order[0]]
        score = 1.0 / sum(2.0 ** -min(sizes[k] - best, 1000) for k in order)
        if len(order) == 1:
            return order[0], score, 1.0, best / times
        saved = sizes[order[1]] - best
        return order[0], score, saved / sizes[order[1]], saved / times


def _least_margin(texts: dict[str, list[bytes]], prior: dict[str, int], dictionary_bytes: int, dictionaries: int, most: int) -> float:
    """The least margin, from folded sample texts by language: at most
    ``most`` of them are measured, but up to 8 of each language."""
    probe = Model({lang: _dictionaries(own[::2], dictionary_bytes, dictionaries) for lang, own in texts.items()}, prior)
    found = [(lang, probe.predict(t.decode())) for lang, own in texts.items() for t in own[1::2][:max(8, most // len(texts))]]
    margins = [x[2] for lang, x in found if x[0] == lang]
    return max(MARGIN_FLOOR, MARGIN_SHARE * float(np.percentile(margins, MARGIN_PERCENTILE))) if margins else MARGIN_FLOOR


def _dictionaries(texts: list[bytes], size: int, n: int) -> list[bytes]:
    """The first has the first texts, each further one what is left, or else the end again."""
    whole = b" ".join(texts) or b" "
    parts = [whole[i * size:(i + 1) * size] for i in range(n)]
    return [(p if len(p) >= min(8, len(whole)) else whole[-size:]).ljust(8) for p in parts]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dictionary_bytes: int = 64_000,
        dictionaries: int = 4, sample_slots: int = 512, sample_chars: int = 2000, max_languages: int = 200, margin_texts: int = 1000) -> Model:
    """A model from rows with a text and a label (others do not count).

    Bounds: the ``max_languages`` most frequent labels, ``dictionaries`` of
    ``dictionary_bytes`` each, from at most ``sample_slots`` different texts
    per label and ``sample_chars`` characters of each. Equal texts count once.
    The least margin is measured on at most ``margin_texts`` of these (but up
    to 8 per label), on the driver.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL AND text != ''")
    rows = rows.withColumn("h", F.xxhash64("text"))
    picked = rows.groupBy("lang", F.pmod("h", F.lit(sample_slots)).alias("slot")).agg(F.min("h").alias("h"), F.count("*").alias("n"))
    picked = [r for r in picked.groupBy("lang").agg(F.sum("n").alias("n"), F.collect_list("h").alias("h")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()]
    prior = {r.lang: int(r.n) for r in picked}
    keys = [(r.lang, h) for r in picked for h in r.h]
    if not keys:
        return Model({}, {})
    spark = labelled.sparkSession
    wanted = spark.createDataFrame(keys, "lang string, h long")  # at most sample_slots * max_languages rows
    sample = rows.join(F.broadcast(wanted), ["lang", "h"]).select("lang", "h", F.substring("text", 1, sample_chars).alias("text"))
    sample = sample.dropDuplicates(["lang", "h"]).collect()
    texts = {lang: [fold(r.text) for r in sorted((r for r in sample if r.lang == lang), key=lambda r: r.h)] for lang in prior}
    contents = {lang: _dictionaries(own, dictionary_bytes, dictionaries) for lang, own in texts.items()}
    return Model(contents, prior, min_margin=_least_margin(texts, prior, dictionary_bytes, dictionaries, margin_texts))


def identify(docs: DataFrame, model: Model, text_col: str = "text", min_margin: float | None = None, min_bytes: float = 1.0) -> DataFrame:
    """``docs`` with lang_pred, score, margin and rejected (undetermined, a
    margin below ``min_margin``, which is the model's unless given, or fewer
    than ``min_bytes`` saved). Input columns of these names are replaced."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("lang_pred", "score", "margin", "rejected")
    names = docs.columns
    held = spark.sparkContext.broadcast(pickle.dumps(model))
    least = model.min_margin if min_margin is None else min_margin

    def run(batches):
        own = pickle.loads(held.value)
        for big in batches:
            for i in range(0, big.num_rows, 500):
                batch = big.slice(i, 500)
                out = [own.predict(t) for t in batch.column(names.index(text_col)).to_pylist()]
                lang, score, margin = ([x[k] for x in out] for k in range(3))
                rejected = [x[0] == UNDETERMINED or x[2] < least or x[3] < min_bytes for x in out]
                yield pa.RecordBatch.from_arrays([
                    *batch.columns, pa.array(lang, pa.string()), pa.array(np.array(score, float)), pa.array(np.array(margin, float)), pa.array(rejected, pa.bool_())],
                    [*names, "lang_pred", "score", "margin", "rejected"])

    schema = T.StructType([
        *docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(giving_back(run), schema)
