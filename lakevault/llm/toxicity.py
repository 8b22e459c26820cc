"""Toxicity by non-negative positive-unlabelled learning.

Linear classifiers over the distinct words of a text are trained with numpy
from confirmed toxic texts (P) and unlabelled ones (U).  With the class prior
pi = P(toxic), the risk of calling U clean is corrected for the toxic texts in it:

    pi R_p(+) + max(0, R_u(-) - pi R_p(-))

where the maximum keeps the corrected part from going below zero (if it does,
its gradient is followed upwards).  MODELS classifiers see different parts
of U; the score is their mean probability.

Labels of rows with crc32(id) mod 3 = 1 are never read: they are held out.
The sample is bounded by three parameters of ``train``: ``positives`` and
``unlabelled`` texts with the smallest id hashes, and ``features`` distinct words in all (texts
are taken in the order of their hashes, so toxic and unlabelled ones alike, until there are that many);
the prior is the share of toxic rows
among all other labels.  Scoring covers every whole text.

Edge cases: NULL and empty texts get the score of no words; a NULL id is held
out or not by the check sum of ""; NULL labels are no labels; a label of an
unknown document is ignored; repeated rows are scored each; without positive
labels every score is 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import staged, staged_matches, table
from lakevault.llm.hashing import Prefix, slices_by_size, text_buffers

POSITIVES = 3000
UNLABELLED = 6000
FEATURES = 12_000_000
BEGINNINGS = (4, 5, 6)  # bytes; inflected words share them
MIN_TEXTS = 40  # a feature counts if that many sampled texts hold it
KEPT = 4096  # features of the largest weights that stay in the classifier
MODELS = 3
STEPS = 220
DECAY = 0.2  # of the squared weights, over the number of toxic texts
SHARE = 0.8  # of the unlabelled texts for each classifier
RATE = 0.05
THRESHOLD = 0.7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash), texts in order: every word (letters, digits and
    non-ASCII bytes, ASCII in lower case) and the beginnings of longer words."""
    data = _LOWER[data]
    word = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    text, prefix = np.searchsorted(offsets, start, "right") - 1, Prefix(data)
    texts, hashes = [text], [prefix.of(start, end)]
    for k in BEGINNINGS:
        longer = end - start > k
        texts.append(text[longer])
        hashes.append(~prefix.of(start[longer], start[longer] + k))
    order = np.argsort(np.concatenate(texts).astype(np.uint16 if len(offsets) < 65_000 else np.int64), kind="stable")
    return np.concatenate(texts)[order], np.concatenate(hashes)[order]


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


class Classifier:
    """Sorted word hashes, a weight for each and model, and a bias for each model."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.words, self.weights, self.bias = words, weights, bias
        self.maybe = np.zeros(1 << 16, bool)  # by the low bits: most words are ruled out by one look
        self.maybe[(words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.words):
            return np.zeros(n)
        text, word = word_features(data, offsets)
        likely = self.maybe[word & np.uint64(0xFFFF)]
        text, word = text[likely], word[likely]
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        known = self.words[at] == word
        pair = np.unique(text[known] * len(self.words) + at[known])
        text, at = np.divmod(pair, len(self.words))
        z = np.stack([np.bincount(text, self.weights[m, at], n) + self.bias[m] for m in range(len(self.bias))])
        return (1 / (1 + np.exp(-np.clip(z, -40, 40)))).mean(axis=0)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, models: int = MODELS, steps: int = STEPS) -> Classifier:
    """Non-negative PU risk, minimised by Adam; arguments hold each text's distinct word hashes."""
    texts = positive + unlabelled
    if not positive or not unlabelled:
        return Classifier(np.zeros(0, np.uint64), np.zeros((1, 0)), np.zeros(1))
    every, held = np.unique(np.concatenate(texts), return_counts=True)
    words = every[held >= min(MIN_TEXTS, max(1, len(positive) // 8))]
    if not len(words):
        return Classifier(words, np.zeros((1, 0)), np.zeros(1))
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    flat = np.concatenate(texts)
    at = np.minimum(np.searchsorted(words, flat), len(words) - 1)
    keep = words[at] == flat
    text, at = text[keep], at[keep]
    is_p = np.arange(len(texts)) < len(positive)
    weights, biases = [], []
    for m in range(models):
        rng = np.random.default_rng(m)
        used = is_p | (rng.random(len(texts)) < SHARE)
        w, b = _minimise(text[used[text]], at[used[text]], is_p & used, ~is_p & used, len(words), prior, steps)
        weights.append(w)
        biases.append(b)
    weights = np.stack(weights)
    top = np.sort(np.argsort(-np.abs(weights).max(axis=0), kind="stable")[:KEPT])
    return Classifier(words[top], weights[:, top], np.array(biases))


def risk_and_gradient(z: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """What is minimised, and its gradient, for the texts' scores ``z``; ``p`` and ``u`` mark toxic and unlabelled texts.

    If the corrected part of the risk is below zero, it alone is followed upwards.
    """
    n_p, n_u = max(1, p.sum()), max(1, u.sum())
    s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    soft = np.logaddexp(0, z)
    rest = soft[u].sum() / n_u - prior * soft[p].sum() / n_p
    g = np.zeros(len(z))
    if rest >= 0:
        g[p] = prior * (s[p] - 1) / n_p - prior * s[p] / n_p
        g[u] = s[u] / n_u
        return prior * (soft[p] - z[p]).sum() / n_p + rest, g
    # below zero: undo the overfit part
    g[p] = prior * s[p] / n_p
    g[u] = -s[u] / n_u
    return -rest, g


def _minimise(text, at, p, u, n_words: int, prior: float, steps: int) -> tuple[np.ndarray, float]:
    n, n_p = len(p), max(1, p.sum())
    w = np.zeros(n_words + 1)
    w[-1] = np.log(prior / (1 - prior))
    m1, m2 = np.zeros(n_words + 1), np.zeros(n_words + 1)
    for t in range(1, steps + 1):
        z = np.bincount(text, w[at], n) + w[-1]
        _, g = risk_and_gradient(z, p, u, prior)
        grad = np.append(np.bincount(at, g[text], n_words), g.sum())
        grad[:-1] += DECAY / n_p * w[:-1]
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        w -= RATE * (1 - t / (steps + 1)) * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(2))
        for lo, hi in slices_by_size(offsets, 1 << 20):
            text, word = word_features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            first = np.searchsorted(text, np.arange(hi - lo + 1))
            sets = [np.unique(word[first[i] : first[i + 1]]).tobytes() for i in range(hi - lo)]
            yield pa.record_batch(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sets, pa.binary())],
                names=["h", "positive", "words"],
            )


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Classifier:
    """Fit on the bounded sample; see the module docstring."""
    seen = labels.select(F.col("doc_id"), F.col(label_col).alias("y")).filter(~held_out(F.col("doc_id")) & F.col("y").isNotNull() & F.col("doc_id").isNotNull())
    n, toxic = seen.agg(F.count(F.lit(1)), F.sum((F.col("y") == 1).cast("long"))).first()
    if not n or not toxic:
        return Classifier(np.zeros(0, np.uint64), np.zeros((1, 0)), np.zeros(1))
    prior = min(0.9, toxic / n)
    by_hash = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    pos = seen.filter("y = 1").select("doc_id", F.lit(True).alias("positive")).distinct().orderBy(by_hash, "doc_id").limit(positives)
    open_ids = docs.select(F.col(id_col).alias("doc_id")).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    unl = open_ids.select("doc_id", F.lit(False).alias("positive")).orderBy(by_hash, "doc_id").limit(unlabelled)
    ids = staged(pos.union(unl.distinct()), "toxic-sample-ids")
    texts = staged_matches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ids, "doc_id", "toxic-sample")
    rows = texts.select(by_hash.alias("h"), "positive", "text").mapInArrow(_distinct_words, "h bigint, positive boolean, words binary")
    sample: dict[bool, list] = {True: [], False: []}
    size = 0
    for r in rows.orderBy("h", "positive").toLocalIterator():
        size += len(r["words"]) // 8
        if size > features:
            break
        sample[r["positive"]].append(np.frombuffer(r["words"], np.uint64))
    return fit(sample[True], sample[False], prior)


def _score(c: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            for lo, hi in slices_by_size(offsets, 1 << 20):
                s = c.scores(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(s)],
                                      names=["doc_id", "held_out", "score"])

    return run


def toxicity_scores(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    d = docs.select(F.col(id_col).cast("string").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    s = d.mapInArrow(_score(classifier), "doc_id string, held_out boolean, score double")
    return s.withColumns({"doc_id": F.col("doc_id").cast(docs.schema[id_col].dataType), "predicted": (F.col("score") >= THRESHOLD).cast("int")})


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity_scores(docs, train(docs, labels))
