"""Operator 4, quality classifier: random Fourier features approximate a
Gaussian kernel over document statistics; normal equations, summed within each
partition, fit ridge scores; isotonic regression calibrates them.

Learning uses labelled rows of the training folds only, at most
``max_train_rows`` of them (a documented bound: a larger set is thinned by a
hash of the document's statistics, alike for all rows). Everything that
reaches the driver has a size that the parameters fix: one matrix for each of
``FIT_PARTS`` partitions, and a histogram of ``BINS`` bins for calibration.

Defined results: a very long text is worked on whole, by the task that holds it;
a null text counts as empty and gets a score as any text; null
labels teach nothing; a document with several label rows takes their mean;
rows without doc_id are scored and never learned from; an empty table gives no
rows; without training rows, or with one class only, the score is constant
(that class's share, 0.5 without rows).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import release, slim, stage
from sftforge.llm.textstats import TextView

MAX_TRAIN_ROWS = 1_000_000
N_FEATURES = 256
RIDGE = 1e-4
FIT_PARTS = 8
BINS = 1000
SEED = 2024


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray   # random frequencies, statistics x features
    phase: np.ndarray
    coef: np.ndarray      # features + 1 (the last is the constant)
    knots: np.ndarray     # raw scores
    levels: np.ndarray    # calibrated scores at the knots, rising


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the array ``stats`` of its whole text; nothing else enters a score."""
    return docs.select(docs["doc_id"], _stats_of(docs["text"]).alias("stats"))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 1 is held out. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def fourier(x: np.ndarray, model: Model) -> np.ndarray:
    """Random Fourier features of raw statistics, with a constant column."""
    z = np.clip((x - model.mean) / model.scale, -6, 6) @ model.weights + model.phase
    z = np.cos(z) * np.sqrt(2.0 / model.weights.shape[1])
    return np.hstack([z, np.ones((len(x), 1))])


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def _isotonic(levels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the rising sequence nearest in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(levels, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            total = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / total, total, a[2] + b[2]])
    return np.concatenate([[v] * int(n) for v, _, n in blocks])


def _constant(n_stats: int, level: float) -> Model:
    zero = np.zeros(1)
    return Model(np.zeros(n_stats), np.ones(n_stats), np.zeros((n_stats, 1)), zero, np.zeros(2), zero,
                 np.array([level]))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality",
        max_train_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on the rows of ``stats`` (from :func:`statistics`) that have a label
    and are not held out; four fifths fit, one fifth calibrates."""
    known = (labels.select(labels["doc_id"], labels[label].cast("double").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
             .groupBy("doc_id").agg(F.avg("y").alias("y")))
    train = stage(stats.filter(fold(F.col("doc_id")) != 1).join(known, "doc_id")
                  .select("stats", "y", F.pmod(F.xxhash64("stats"), F.lit(1_000_003)).alias("draw")), "op4-train")
    n_stats = len(TextView("").features())
    n, ones = train.agg(F.count("*"), F.avg("y")).first()
    if not n or ones in (0.0, 1.0):
        return _constant(n_stats, 0.5 if not n else ones)
    if n > max_train_rows:
        train = train.filter(F.col("draw") < int(1_000_003 * max_train_rows / n))
    moments = train.agg(*[f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(n_stats)]).first()
    mean, spread = np.array(moments[:n_stats]), np.array(moments[n_stats:])
    rng = np.random.default_rng(SEED)
    model = Model(mean, np.where(spread > 1e-9, spread, 1.0),
                  rng.normal(size=(n_stats, N_FEATURES)) / np.sqrt(n_stats),
                  rng.uniform(0, 2 * np.pi, N_FEATURES), np.zeros(N_FEATURES + 1), np.zeros(1), np.zeros(1))
    width = N_FEATURES + 1

    def normal_equations(batches):
        import pyarrow as pa
        total = np.zeros((width, width + 1))
        for b in batches:
            z = fourier(_matrix(b.column(0)), model)
            total += z.T @ np.hstack([z, b.column(1).to_numpy()[:, None]])
        yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]})

    parts = (train.filter(F.col("draw") % 5 != 0).select("stats", "y").repartition(FIT_PARTS)
             .mapInArrow(normal_equations, "m binary").collect())  # FIT_PARTS matrices
    total = sum(np.frombuffer(x.m).reshape(width, width + 1) for x in parts)
    penalty = np.eye(width) * RIDGE * max(total[-1, width - 1], 1.0)
    penalty[-1, -1] = 1e-9
    model = Model(model.mean, model.scale, model.weights, model.phase,
                  np.linalg.solve(total[:, :width] + penalty, total[:, width]), model.knots, model.levels)
    edge = F.least(F.greatest(raw_score(model)(F.col("stats")), F.lit(-0.5)), F.lit(1.5))
    bins = (train.filter(F.col("draw") % 5 == 0)
            .select(F.floor((edge + 0.5) / 2 * BINS).alias("bin"), edge.alias("s"), "y")
            .groupBy("bin").agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count("*").alias("n"))
            .orderBy("bin").collect())  # BINS rows at most
    if not bins:
        return Model(model.mean, model.scale, model.weights, model.phase, model.coef,
                     np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    levels = _isotonic(np.array([x.y for x in bins]), np.array([float(x.n) for x in bins]))
    return Model(model.mean, model.scale, model.weights, model.phase, model.coef,
                 np.array([x.s for x in bins]), levels)


def raw_score(model: Model):
    """Column function: statistics -> ridge score."""
    @F.arrow_udf("double")
    def ridge(stats):
        import pyarrow as pa
        return pa.array(fourier(_matrix(stats), model) @ model.coef if len(stats) else [], pa.float64())

    return ridge


def calibrated(model: Model):
    """Column function: statistics -> probability of label 1. Between knots the
    calibrated level is drawn on straight lines; a share of 1 % follows the raw
    score itself, so that documents of one level keep their order."""
    @F.arrow_udf("double")
    def probability(stats):
        import pyarrow as pa
        if not len(stats):
            return pa.array([], pa.float64())
        if len(model.levels) == 1:
            return pa.array(np.full(len(stats), model.levels[0]), pa.float64())
        raw = fourier(_matrix(stats), model) @ model.coef
        level = np.interp(raw, model.knots, model.levels)
        return pa.array(0.99 * level + 0.01 / (1 + np.exp(-4 * (raw - 0.5))), pa.float64())

    return probability


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row of ``stats``."""
    return stats.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"),
                        calibrated(model)(F.col("stats")).alias("score")
                        ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled training rows and score every document."""
    stats = stage(statistics(slim(docs, "doc_id", "text")), "op4-stats")
    return score(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be of label 1, with their own columns."""
    slimmed = slim(docs, "doc_id", "text")
    teaching = stage(statistics(slimmed.filter(fold(slimmed["doc_id"]) != 1)), "op4-stats")  # held-out rows teach nothing
    model = fit(teaching, labels)
    release(teaching)
    return docs.filter(calibrated(model)(_stats_of(docs["text"])) >= 0.5)


def _stats_of(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def stats(texts):
        import pyarrow as pa
        return pa.array([TextView(t).features() for t in texts.to_pylist()], pa.list_(pa.float64()))

    return stats(text)
