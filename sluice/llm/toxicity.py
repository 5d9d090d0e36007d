"""Toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words sums, over the letter triples that both have in
order, decay ** (span in one + span in the other), spans at most ``SPAN``,
scaled by the words' lengths: gaps and inserted letters cost a little, not
the match. A Nyström map on landmark words makes it linear, and because the
kernel is an inner product over triples, the trained machine folds into one
weight per triple of the landmarks, whatever their letters: a word is scored
by looking up its triples. A sentence scores as its strongest word, a text as its
strongest sentence, squashed to 0..1 by a fitted logistic.

Words are reduced to lower-case letters, so marks put between letters fall
away; runs of single letters count as a word too; words longer than a piece
are scored in overlapping pieces.

Labels are of texts, not of sentences. Training therefore picks in every
toxic text the sentence whose word is the best witness (first by how much
more often toxic texts have the word, then by the machine itself) against
all words of the clean texts, and repeats. Landmark witnesses also train in
forms with one letter inserted, so the machine keeps the tolerance that the
kernel offers.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import prepare

DECAY, SPAN, PIECE = 0.8, 7, 32
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SINGLES = re.compile(r"(?<!\w)(?:[^\W\d_][\W\d_]{1,3}){2,}[^\W\d_](?!\w)")
_SENTENCE = re.compile(r"[.!?\n]+")
_WIDTHS = (6, 8, 10, 12, 16, 24, PIECE)


def _triples(width: int):
    for i in range(width):
        for j in range(i + 1, min(width, i + SPAN)):
            for k in range(j + 1, min(width, i + SPAN + 1)):
                yield i, j, k, DECAY ** (k - i + 1)


_SCALE = np.array([1.0] * 3 + [np.sqrt(sum(w * w for *_, w in _triples(n))) for n in range(3, PIECE + 1)])


def units(tokens) -> dict[str, list[str]]:
    """For each token its letters, in pieces if it is long; tokens of under three letters have none."""
    out = {}
    for t in tokens:
        w = t if t.isalpha() else _NOT_LETTERS.sub("", t)
        if len(w) <= PIECE:
            out[t] = [w] if len(w) >= 3 else []
        else:
            out[t] = [w[i:i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2)]
    return out


def tokens(text: str) -> set[str]:
    """Different words of a text, and its runs of single letters."""
    text = text.lower()
    words = text.split()
    return {*words, *_SINGLES.findall(text)}


class _Letters:
    """Codes of every letter of some words, and the triples that these have."""

    def __init__(self, words: list[str]):
        count = Counter(c for w in words for c in w)
        self.code = {c: i + 1 for i, (c, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0])))}
        self.size = len(self.code) + 1
        self.keys = np.unique(np.concatenate([self.triples(w)[0] for w in words] or [np.zeros(0, np.int64)]))
        self.cube = None
        if self.size <= 128:  # a place for every triple of the alphabet; of larger ones only those that occur
            self.cube = np.zeros(self.size ** 3, np.int32)
            self.cube[self.keys] = np.arange(len(self.keys)) + 1

    def triples(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """The keys of a word's triples and their weights."""
        codes = np.array([self.code[c] for c in word], np.int64)
        i, j, k, w = (np.array(x) for x in zip(*_triples(len(word))))
        return (codes[i] * self.size + codes[j]) * self.size + codes[k], w

    def rows(self, key: np.ndarray) -> np.ndarray:
        """The places of triples in a table of weights; 0 for those that no word has."""
        if self.cube is not None:
            return self.cube[key]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at + 1, 0)

    def matrix(self, words: list[str], width: int) -> np.ndarray:
        """Letter codes, one row per word; 0 for letters that no landmark has, and padding."""
        raw = np.frombuffer("".join(w.ljust(width) for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width)
        values, inverse = np.unique(raw, return_inverse=True)
        codes = np.array([self.code.get(chr(v), 0) for v in values], np.int64)
        return codes[inverse].reshape(raw.shape)


def _sums(letters: _Letters, weights: np.ndarray, words: list[str]) -> np.ndarray:
    """Scaled sums of triple weights; ``weights`` has a row per triple, after one of zeros, and any number of columns."""
    out = np.zeros((len(words), weights.shape[1]), np.float32)
    lengths = np.array([len(w) for w in words], np.int64)
    low, a = 2, letters.size
    whole = weights[letters.cube] if letters.cube is not None and weights.shape[1] == 1 else None
    for width in _WIDTHS:
        rows = np.flatnonzero((lengths > low) & (lengths <= width))
        low = width
        for s in range(0, len(rows), 4096):
            part = rows[s:s + 4096]
            codes = letters.matrix([words[r] for r in part], width)
            total = np.zeros((len(part), weights.shape[1]), np.float32)
            for i, j, k, w in _triples(width):
                key = (codes[:, i] * a + codes[:, j]) * a + codes[:, k]
                total += np.float32(w) * (weights[letters.rows(key)] if whole is None else whole[key])
            out[part] = total / _SCALE[lengths[part]][:, None]
    return out


def _triple_table(letters: _Letters, words: list[str]) -> np.ndarray:
    """For each landmark (column) the scaled weights of its triples."""
    table = np.zeros((len(letters.keys) + 1, len(words)), np.float32)
    for c, word in enumerate(words):
        key, w = letters.triples(word)
        np.add.at(table[:, c], letters.rows(key), (w / _SCALE[len(word)]).astype(np.float32))
    return table


class Model:
    """The folded machine: one weight per triple, a bias, and the logistic's slope and offset."""

    def __init__(self, letters: _Letters | None, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.letters, self.weights, self.bias, self.slope, self.offset = letters, weights, bias, slope, offset
        self._known: dict[str, float] = {}

    def margins(self, words: list[str]) -> np.ndarray:
        return _sums(self.letters, self.weights, words)[:, 0] + self.bias if self.letters and words else np.zeros(len(words))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Of each whole text, 0 to 1."""
        sets = [tokens(t) for t in texts]
        known = self._known
        if len(known) > 400_000:
            known.clear()
        new = units(w for w in set().union(*sets) if w not in known) if sets else {}
        words = list({u for us in new.values() for u in us})
        margin = dict(zip(words, self.margins(words).tolist()))
        known.update((t, max((margin[u] for u in us), default=-1.0)) for t, us in new.items())
        top = np.array([max(map(known.__getitem__, s), default=-1.0) for s in sets], float)
        for t in [t for t in new if len(t) > 64]:
            del known[t]
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.offset, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Squared-hinge support vector machine in the primal, by Newton steps on the active rows; the last weight is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] *= 1e-3
    for _ in range(25):
        on = y * (x @ w) < 1
        xa = x[on] * weight[on, None]
        new = np.linalg.solve(penalty + xa.T @ x[on], xa.T @ y[on])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def train(texts: list[str], toxic: list[int], landmarks: int = 160, rounds: int = 4, ridge: float = 0.05, working: int = 12_000) -> Model:
    """A model from a bounded list of labelled texts; the same lists give the
    same model. Of the clean texts' words the ``working`` most frequent train,
    and in each round as many of those the machine has most wrong."""
    place: dict[str, int] = {}
    have = []
    for text in texts:
        found = {u for s in _SENTENCE.split(text) for us in units(s.lower().split()).values() for u in us}
        found.update(u for us in units(_SINGLES.findall(text.lower())).values() for u in us)
        have.append(np.array(sorted(place.setdefault(u, len(place)) for u in sorted(found)), np.int64))
    pos = [i for i, y in enumerate(toxic) if y == 1 and len(have[i])]
    neg = [i for i, y in enumerate(toxic) if y == 0]
    if not pos or not neg:
        return Model(None, np.zeros((0, 1), np.float32), 0.0, 0.0, 3.0 if pos and not neg else -3.0)
    words = list(place)
    in_pos, in_neg = (np.bincount(np.concatenate([have[i] for i in side]), minlength=len(words)) for side in (pos, neg))
    odds = np.log((in_pos + 0.5) / (len(pos) + 1)) - np.log((in_neg + 0.5) / (len(neg) + 1))

    # witnesses; a label that no word shared with other toxic texts supports is left out for now
    supported = np.where(in_pos > 2, odds, -9.0)
    witness = {i: int(have[i][supported[have[i]].argmax()]) for i in pos}
    witness = {i: u for i, u in witness.items() if supported[u] > 1.5} or witness
    # a text's other sentences count as well where their word is as telling in general
    telling = np.flatnonzero((in_pos >= max(5, len(pos) / 200)) & (odds > 3))
    named = np.bincount(list(witness.values()), minlength=len(words)).astype(float)
    named[telling] += in_pos[telling] / 2
    ranked = np.flatnonzero(named)
    ranked = ranked[np.lexsort((ranked, -named[ranked] * np.maximum(odds[ranked], 0)))]
    common = np.lexsort((np.arange(len(words)), -in_neg))[:landmarks // 3]
    chosen = [words[k] for k in dict.fromkeys([*ranked[:landmarks - len(common)].tolist(), *common.tolist()])]
    letters = _Letters(chosen)
    table = _triple_table(letters, chosen)
    gram = _sums(letters, table, chosen)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    ok = value > 1e-3 * value.max()
    root = (vector[:, ok] / np.sqrt(value[ok])).astype(np.float32)  # Nyström: kernel to landmarks -> features

    def features(numbers) -> np.ndarray:
        return _sums(letters, table, [words[k] for k in numbers]) @ root

    rng = np.random.default_rng(5)
    alphabet = sorted({c for u in chosen for c in u})
    known = set(words)
    inserted = {}
    for u in chosen:
        if odds[place[u]] > 2 and len(u) < PIECE:
            for i in range(1, len(u)):
                w = u[:i] + alphabet[rng.integers(len(alphabet))] + u[i:]
                if w not in known:
                    inserted[w] = named[place[u]] / (len(u) - 1)
    extra = _sums(letters, table, list(inserted)) @ root if inserted else np.zeros((0, root.shape[1]), np.float32)

    clean = np.flatnonzero(in_neg)
    active = clean[np.lexsort((clean, -in_neg[clean]))][:working]
    best = dict(witness)
    for _ in range(rounds):
        share = np.bincount(list(best.values()), minlength=len(words)).astype(float)
        share[telling] += in_pos[telling] / 2
        up = np.flatnonzero(share)
        x = np.concatenate([features(up), extra, features(active)])
        y = np.concatenate([np.ones(len(up) + len(extra)), -np.ones(len(active))])
        share = np.concatenate([share[up], list(inserted.values())])
        w = _svm(x, y, np.concatenate([share / share.sum() * len(clean) ** 0.5 * 10, np.ones(len(active))]), ridge)
        fold = (table @ (root @ w[:-1].astype(np.float32)))[:, None]
        margin = _sums(letters, fold, words)[:, 0] + w[-1]
        worst = clean[np.lexsort((clean, -margin[clean]))][:working]
        active = np.union1d(active, worst[margin[worst] > -1])
        # the witness sentence of each toxic text: the one with the strongest word
        best = {i: int(have[i][margin[have[i]].argmax()]) for i in pos}
        best = {i: k for i, k in best.items() if margin[k] > -0.5 or i in witness}
    top = [margin[have[i]].max(initial=-1.0) for i in [*best, *neg]]
    top = np.concatenate([top, extra @ w[:-1] + w[-1]])
    y = np.array([1.0] * len(best) + [0.0] * len(neg) + [1.0] * len(inserted))
    weight = np.array([1.0] * (len(best) + len(neg)) + [0.03 * len(best) / max(1, len(inserted))] * len(inserted))
    slope, offset = _logistic(np.maximum(top, -1.0), y, weight)
    return Model(letters, fold, float(w[-1]), slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a one-dimensional logistic with softened targets and a slight pull to zero."""
    target = np.where(y == 1, 1 - 1 / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    design = np.stack([x, np.ones(len(x))], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        grad = design.T @ (weight * (p - target)) + 1e-3 * b
        hess = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b = b - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 1000, **options) -> Model:
    """A model from texts and labels of 0 or 1 with the same id (others, null
    texts and null ids do not count).

    Bound: at most ``sample`` documents per label, one for each hash slot;
    equal texts fall into one slot. Only ids and hashes are shuffled to find
    them; the texts of those chosen are fetched by a broadcast of their ids.
    """
    light = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    picked = light.join(known, "id").groupBy("y", F.pmod("h", F.lit(sample)).alias("slot")).agg(F.min(F.struct("h", "id")).alias("p"))
    picked = picked.select("y", F.col("p.h").alias("h"), F.col("p.id").alias("id")).collect()  # at most 2 * sample rows
    if not picked:
        return Model(None, np.zeros((0, 1), np.float32), 0.0, 0.0, -3.0)
    wanted = docs.sparkSession.createDataFrame([(r.id,) for r in picked], light.select("id").schema).distinct()
    texts = docs.join(F.broadcast(wanted), F.col(id_col) == F.col("id")).select("id", F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    text = {(r.id, r.h): r.text for r in texts.dropDuplicates(["id", "h"]).collect()}
    taken = sorted((r.y, r.h, text[r.id, r.h]) for r in picked)
    return train([t for *_, t in taken], [y for y, *_ in taken], **options)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, higher is more likely toxic), of the whole
    text. Null and empty texts score as a text without words. A column of
    that name is replaced."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("score")
    names = docs.columns
    held = spark.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        own = pickle.loads(held.value)
        for big in batches:
            for i in range(0, big.num_rows, 500):
                batch = big.slice(i, 500)
                values = own.scores([t or "" for t in batch.column(names.index(text_col)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
