"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Statistics of each whole text (class shares, word lengths, repeats, ...) are
standardised and mapped to ``cos(Wx + b)`` features, which approximate a
Gaussian kernel.  Every partition sums its own normal equations; the sums are
added up as a tree, and the driver solves one small system.  One in
``CALIBRATION`` of the training rows is held back from that: their raw scores
are counted in fixed bins and fitted by pool-adjacent-violators, which gives a
calibrated, rising score from 0 to 1.

Only the statistics are inputs: never ids, labels, languages or sources.

Result for odd input: a null or empty text has all-zero counts and a score
like any other; repeated rows are scored alike and weigh as often as they
occur; labels that are null, unknown or of unknown documents are not used;
conflicting labels of one document average to their mean; with no usable label
the score is 0.5; where the held-back part has fewer than ``LEAST_HELD`` rows
on either side, all rows are fitted and all calibrate; an empty table gives no rows; other columns travel along (``with_features``
and ``classify`` replace those named like their output, ``keep`` none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import frozen, packed, require, unpacked
from casetrace.llm.divergence import COMMON_WORDS
from casetrace.llm.doc_stats import CLASS_COLUMNS, share, with_classes, with_repeats, with_words
from casetrace.llm.sums import sum_arrays

FEATURES = ["f_words", "f_word_chars", "f_distinct", "f_repeats", "f_dup_lines", "f_common",
            "f_line_words"] + [f"f_{c}" for c in CLASS_COLUMNS]
_SCRATCH = [*CLASS_COLUMNS, "n_chars_read", "n_words", "n_dup_lines", "n_repeat_words"]
BINS = 1000
_LOW, _HIGH = -0.5, 1.5
THRESHOLD = 0.3
CALIBRATION = 5
LEAST_HELD = 100


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``f_...`` columns, on DataFrame functions only."""
    require(docs, ["text"])
    own = docs.drop(*FEATURES, *_SCRATCH)
    common = sorted({f for ws in COMMON_WORDS.values() for w in ws
                     for f in (w, w.capitalize(), w.upper())})
    out = with_repeats(with_words(with_classes(own)))
    words, chars = F.col("n_words"), F.col("n_chars_read")
    out = (out.withColumn("f_distinct", share(F.size(F.array_distinct("__words")), words))
           .withColumn("f_common", share(F.size(F.filter("__words", lambda w: w.isin(common))),
                                         words))
           .drop("__words"))
    lines = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^\n]+", "")) + 1
    out = (out.withColumn("f_words", F.log1p(words))
           .withColumn("f_word_chars", share(chars - F.col("n_space"), words))
           .withColumn("f_repeats", share(F.col("n_repeat_words"), words))
           .withColumn("f_dup_lines", share(F.col("n_dup_lines"), lines))
           .withColumn("f_line_words", F.log1p(share(words, lines))))
    for c in CLASS_COLUMNS:
        out = out.withColumn(f"f_{c}", share(F.col(c), chars))
    return out.select(*own.columns, *[F.col(f).cast("double").alias(f) for f in FEATURES])


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray   # W: statistics x features
    phases: np.ndarray
    ridge: np.ndarray     # one weight per feature and the constant
    steps: np.ndarray     # calibrated score per bin of the raw score

    def mapped(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8.0, 8.0)
        wave = np.cos(z @ self.weights + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.hstack([wave, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.mapped(x) @ self.ridge

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.ridge):
            return np.full(len(x), 0.5)
        centres = _LOW + (np.arange(BINS) + 0.5) * (_HIGH - _LOW) / BINS
        return np.clip(np.interp(self.raw(x), centres, self.steps), 0.0, 1.0)


def rising(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the rising step function closest to the bin
    means; empty bins take the value between their neighbours."""
    blocks: list[list[float]] = []  # sum, count, bins
    at = np.flatnonzero(counts)
    for i in at:
        blocks.append([sums[i], counts[i], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, c, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, blocks[-1][2] + n]
    values = np.concatenate([[s / c] * int(n) for s, c, n in blocks])
    return np.interp(np.arange(len(counts)), at, values)


def fit(labelled: DataFrame, features: int = 128, bandwidth: float = 3.0,
        ridge: float = 1e-4, seed: int = 7) -> Model:
    """Fit on rows with the ``f_...`` columns and ``label`` (0 to 1).

    All labelled rows are used, for the equations or for the calibration.
    What reaches the driver has a fixed size: means, the normal equations and
    ``BINS`` counts.
    """
    rows = frozen(labelled.where(F.col("label").isNotNull())
                  .select(*FEATURES, F.col("label").cast("double").alias("label"))
                  # equal rows are held back together, whatever their order
                  .withColumn("back", F.pmod(F.xxhash64(*FEATURES), F.lit(CALIBRATION)) == 0))
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("back") & (F.col("label") > 0.5)).alias("good"),
                     F.count_if(F.col("back") & (F.col("label") <= 0.5)).alias("bad"),
                     *[F.avg(f).alias(f"m_{f}") for f in FEATURES],
                     *[F.stddev_pop(f).alias(f"s_{f}") for f in FEATURES]).first()
    empty = np.zeros(0)
    if not stats["n"]:
        return Model(empty, empty, empty, empty, empty, empty)
    mean = np.array([stats[f"m_{f}"] for f in FEATURES])
    scale = np.array([stats[f"s_{f}"] or 1.0 for f in FEATURES])
    rng = np.random.default_rng(seed)
    start = Model(mean, np.maximum(scale, 1e-9),
                  rng.normal(size=(len(FEATURES), features)) / bandwidth,
                  rng.uniform(0, 2 * np.pi, features), empty, empty)

    whole = min(stats["good"], stats["bad"]) < LEAST_HELD

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        return np.column_stack(columns[:-2]).reshape(-1, len(FEATURES)), columns[-2], columns[-1]

    def equations(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            x, label, back = read(batch)
            z = start.mapped(x[~back | whole])
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ label[~back | whole]
        return total

    system = sum_arrays(rows, equations, (features + 1, features + 2))
    weights = np.linalg.solve(system[:, :-1] + ridge * stats["n"] * np.eye(features + 1),
                              system[:, -1])
    fitted = Model(start.mean, start.scale, start.weights, start.phases, weights, empty)

    def bins(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        held = np.zeros((2, BINS))
        for batch in batches:
            x, label, back = read(batch)
            use = back | whole
            at = (fitted.raw(x[use]) - _LOW) * BINS / (_HIGH - _LOW)
            at = np.clip(at, 0, BINS - 1).astype(np.int64)
            held += [np.bincount(at, minlength=BINS), np.bincount(at, label[use], BINS)]
        return held

    counts, sums = sum_arrays(rows, bins, (2, BINS))
    return Model(start.mean, start.scale, start.weights, start.phases, weights,
                 rising(sums, counts))


def score_column(model: Model) -> Column:
    """Calibrated score of a row that has the ``f_...`` columns."""
    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.column_stack([c.to_numpy() for c in columns])))
    return score(*FEATURES)


def with_label(features: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Rows of ``features`` whose document has a usable label, with ``label``."""
    known = (labels.where(F.col(column).isin(0, 1)).groupBy("doc_id")
             .agg(F.avg(column).alias("label")))
    return features.select("doc_id", *FEATURES).join(known, "doc_id")


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (with the ``f_...`` columns) with ``score`` and ``predicted``."""
    return (docs.drop("score", "predicted").withColumn("score", score_column(model))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (without the ``f_...`` columns) that score ``threshold`` or
    more, with their columns.  The row number keeps the filter above the
    statistics; pushed below them it would repeat every expression it is made
    of, inside the scoring function's arguments."""
    numbered = with_features(packed(docs, ["text"])).withColumn("__row", F.monotonically_increasing_id())
    scored = numbered.withColumn("score", score_column(model))
    return unpacked(scored.where((F.col("score") >= threshold) & (F.col("__row") >= 0)),
                    docs.columns, ["text"])
