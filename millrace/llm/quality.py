"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives every document a latent quality; ordered thresholds cut it into
grades: P(grade <= k) = logistic(threshold_k - quality). All grades share the weights, so each rating informs the
whole scale. From the grade chances follow the expected grade and, for selection, the chance of at least a given grade.

Features: which words a text has (hashed), how its words look (shares of first and last letter kind and
length), and how varied and how long it is. Texts are read whole.

Fitting uses a bounded sample of rated rows (`rows` of each grade, the least by a hash of the id).

Defined results: null and empty texts have only the features of "no words". With ratings of one grade only, that
grade is certain; with none, the expected grade is 0. Null ratings and ids are not used; of several ratings of one id
the largest holds, and of several rows of one id the text with the least hash is learnt from. Repeated rows get equal
results; an empty table has none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import words as W
from .common import prepare

ROWS = 3000
WORD_BITS = 15
KINDS, LENGTHS, BINS = 6, 5, 12
_WORDS = 1 << WORD_BITS
_SHAPES = KINDS * KINDS * LENGTHS
FEATURES = _WORDS + _SHAPES + 2 * BINS

# Kind of a byte: small, capital, digit, beyond ASCII, stop or comma, other signs.
_KIND = np.full(256, 5, np.int64)
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A], _KIND[0x80:] = 0, 1, 2, 3
_KIND[[0x2C, 0x2E]] = 4


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of a batch, sorted by text."""
    found = W.find(texts)
    n_texts = len(found.first) - 1
    text, n = found.text_of(), np.diff(found.first)
    pairs = np.unique(text * _WORDS + (found.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    owner, word = pairs // _WORDS, pairs % _WORDS
    distinct = np.bincount(owner, minlength=n_texts)
    out = [(owner, word, 1 / np.sqrt(distinct[owner]))]

    if len(text):
        size = np.minimum(np.log2(found.end - found.start).astype(np.int64), LENGTHS - 1)
        shape = (_KIND[found.data[found.start]] * KINDS + _KIND[found.data[found.end - 1]]) * LENGTHS + size
        share = np.bincount(text * _SHAPES + shape, minlength=n_texts * _SHAPES)
        seen = np.flatnonzero(share)
        out.append((seen // _SHAPES, _WORDS + seen % _SHAPES, share[seen] / n[seen // _SHAPES]))

    every = np.arange(n_texts)
    varied = np.where(n > 0, np.ceil(distinct / np.maximum(n, 1) * (BINS - 1)), 0).astype(np.int64)
    long = np.minimum(np.log2(n + 1).astype(np.int64), BINS - 1)
    for k, column in enumerate((varied, long)):
        out.append((every, _WORDS + _SHAPES + k * BINS + column, np.full(n_texts, 0.5)))
    text, feature, value = (np.concatenate(c) for c in zip(*out))
    order = np.argsort(text, kind="stable")
    return text[order], feature[order], value[order]


@dataclass
class Model:
    """Fitted weights and thresholds; column functions for the results."""

    weights: np.ndarray
    thresholds: np.ndarray  # ascending; grade k lies between the thresholds k - 1 and k

    def latent(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for begin, end in W.slices(texts):
            text, feature, value = features(texts.slice(begin, end - begin))
            out[begin:end] = np.bincount(text, self.weights[feature] * value, end - begin)
        return out

    def at_least(self, quality: np.ndarray) -> np.ndarray:
        """Chance of at least grade 1, 2, ...; one column each."""
        return 1 / (1 + np.exp(-np.clip(quality[:, None] - self.thresholds[None, :], -30, 30)))

    def tails(self, text: Column) -> Column:
        """array<double>: the chance of at least grade 1, 2, ..."""

        def run(texts: pa.Array) -> pa.Array:
            return pa.array(list(self.at_least(self.latent(texts))), pa.list_(pa.float64()))

        return F.arrow_udf(run, "array<double>")(text)


def expected_grade(tails: Column) -> Column:
    """Expected grade from the tail chances: their sum."""
    return F.aggregate(tails, F.lit(0.0), lambda s, x: s + x)


def train(
    rows: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int,
    penalty: float = 2e-5, steps: int = 400,
) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam steps over the whole sample."""
    n = len(grade)
    begin = np.searchsorted(rows, np.arange(n))
    theta = np.zeros(FEATURES + grades - 1)
    counts = np.cumsum(np.bincount(grade, minlength=grades))[:-1] / n
    cut = np.log(np.clip(counts, 1e-3, 1 - 1e-3) / (1 - np.clip(counts, 1e-3, 1 - 1e-3)))
    theta[FEATURES] = cut[0]
    theta[FEATURES + 1 :] = np.log(np.maximum(np.diff(cut), 1e-2))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    reach = np.concatenate([[-np.inf], cut, [np.inf]])
    for step in range(1, steps + 1):
        gaps = np.exp(theta[FEATURES + 1 :])
        cut = theta[FEATURES] + np.concatenate([[0], np.cumsum(gaps)])
        reach = np.concatenate([[-np.inf], cut, [np.inf]])
        quality = np.add.reduceat(theta[feature] * value, begin)
        high = 1 / (1 + np.exp(-np.clip(reach[grade + 1] - quality, -30, 30)))
        low = 1 / (1 + np.exp(-np.clip(reach[grade] - quality, -30, 30)))
        low[grade == 0], high[grade == grades - 1] = 0, 1
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        slope = np.zeros_like(theta)
        # Each row's loss falls with its upper threshold and rises with its lower one.
        slope[:FEATURES] = np.bincount(feature, np.repeat(d_high - d_low, np.diff(np.append(begin, len(rows)))) * value, FEATURES)
        by_cut = np.bincount(grade, -d_high, grades)[: grades - 1]
        by_cut += np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, d_low, 0), grades)[: grades - 1]
        slope[FEATURES] = by_cut.sum()
        slope[FEATURES + 1 :] = gaps * np.cumsum(by_cut[::-1])[::-1][1:]
        slope = slope / n
        slope[:FEATURES] += penalty * theta[:FEATURES]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta = theta - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:FEATURES].astype(np.float32), theta[FEATURES] + np.concatenate([[0], np.cumsum(np.exp(theta[FEATURES + 1 :]))]))


def fit(
    docs: DataFrame,
    ratings: DataFrame,
    grades: int,
    grade_col: str = "grade",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = ROWS,
) -> Model:
    """Fit on at most `rows` rated documents of each grade from 0 to grades - 1."""
    spark = prepare(docs.sparkSession)
    known = ratings.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(grade_col).cast("int").alias("grade"))
    order = F.xxhash64(F.col("id").cast("string"))
    ids = [
        (r.id, g)
        for g in range(grades)
        for r in known.where(F.col("grade") == g).orderBy(order, "id").limit(rows).collect()
    ]
    # Bounded: at most `rows` ids for each grade.
    sample = spark.createDataFrame(ids, known.schema)

    def packed(texts: pa.Array) -> pa.Array:
        text, feature, value = features(texts)
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        both = np.stack([feature.astype("<f4"), value.astype("<f4")], axis=1)
        return pa.array([both[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = chosen.join(F.broadcast(sample), "id")
    # One text of each id before anything is collected, whatever the number of its rows.
    least = F.min_by("text", F.xxhash64(F.coalesce("text", F.lit(""))))
    chosen = chosen.groupBy("id", "grade").agg(least.alias("text"))
    found = chosen.select("id", "grade", F.arrow_udf(packed, "binary")("text").alias("x")).collect()
    found = sorted(found, key=lambda r: (r.id, r.grade, bytes(r.x)))
    grade = np.array([r.grade for r in found], np.int64)
    if len(np.unique(grade)) < 2:
        only = int(grade[0]) if len(grade) else 0
        return Model(np.zeros(FEATURES, np.float32), np.where(np.arange(1, grades) <= only, -30.0, 30.0))
    parts = [np.frombuffer(r.x, "<f4").reshape(-1, 2) for r in found]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    both = np.concatenate(parts)
    return train(row, both[:, 0].astype(np.int64), both[:, 1].astype(np.float64), grade, grades)
