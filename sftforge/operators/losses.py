"""Loss arithmetic and run logs: W1 next-token shift, W2 weighted token loss,
W3 token cross-entropy, R1 loss curves, R2 best checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftforge.functions import constants as K

IGN = K.IGNORE_INDEX


def shift_next(df: DataFrame, example_col: str = "example_id", pos_col: str = "pos",
               label_col: str = "label", weight_col: str = "weight", method: str = "window") -> DataFrame:
    """Pair position i's prediction with the label and weight at i + 1;
    the last position of each example is dropped. Positions are dense (0..n-1).

    ``window`` (default): ``lead`` over (example) ordered by pos, which reuses
    the partitioning of a table ranked by example. ``join``: equi-join on
    (example, pos + 1), whose shuffle is keyed by both columns, for examples
    too long for one task."""
    if method == "window":
        w = Window.partitionBy(example_col).orderBy(pos_col)
        out = (df.withColumn("target", F.lead(label_col).over(w))
                 .withColumn("target_weight", F.lead(weight_col).over(w))
                 .withColumn("_has", F.lead(pos_col).over(w) == F.col(pos_col) + 1))
        return out.filter(F.col("_has")).drop("_has")
    if method != "join":
        raise ValueError(f"unknown method {method!r}")
    nxt = df.select(F.col(example_col), (F.col(pos_col) - 1).alias(pos_col),
                    F.col(label_col).alias("target"), F.col(weight_col).alias("target_weight"))
    return df.join(nxt, [example_col, pos_col])


def weighted_loss(df: DataFrame, group_col: str = "batch_id", label_col: str = "target",
                  weight_col: str = "target_weight", loss_col: str = "loss") -> DataFrame:
    """Per group sum(loss * w * mask) / max(sum(w * mask), 1e-8), mask =
    label != -100; plain mean of the unmasked losses when there is no weight
    column. Partial aggregation, so hot groups are combined map-side."""
    mask = (F.col(label_col) != IGN).cast("double")
    if weight_col is None or weight_col not in df.columns:
        return df.groupBy(group_col).agg(
            (F.sum(F.col(loss_col) * mask) / F.greatest(F.sum(mask), F.lit(1.0))).alias("loss"))
    w = F.col(weight_col).cast("double")
    return df.groupBy(group_col).agg(
        F.sum(F.col(loss_col) * w * mask).alias("weighted_sum"),
        F.sum(w * mask).alias("weight_sum")).withColumn(
        "loss", F.col("weighted_sum") / F.greatest(F.col("weight_sum"), F.lit(K.LOSS_WEIGHT_FLOOR)))


def cross_entropy(logits: Column, label: Column) -> Column:
    """logsumexp(logits) - logits[label] (max-shifted); 0 for ignored
    labels, null for labels out of range (an error in a training step)."""
    m = F.array_max(logits).cast("double")
    lse = m + F.log(F.aggregate(logits, F.lit(0.0).cast("double"), lambda a, x: a + F.exp(x.cast("double") - m)))
    ok = (label >= 0) & (label < F.size(logits))
    return F.when(label == IGN, F.lit(0.0)).when(ok, lse - F.try_element_at(logits, label + 1).cast("double"))


def loss_curves(log: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Run log -> long form (run_id, series, step, value): train points
    (rows with loss and step) and eval points (rows with eval_loss and step).
    One scan: a row gives up to two points."""
    points = F.array(F.struct(F.lit("train").alias("series"), F.col("loss").alias("value")),
                     F.struct(F.lit("eval").alias("series"), F.col("eval_loss").alias("value")))
    return (log.filter(F.col("step").isNotNull()).select(run_col, "step", F.explode(points).alias("p"))
            .filter(F.col("p.value").isNotNull()).select(run_col, "p.series", "step", "p.value"))


def best_checkpoint(log: DataFrame, keep: int = K.SAVE_TOTAL_LIMIT, run_col: str = "run_id") -> DataFrame:
    """R2: lowest eval_loss per run (ties -> smallest step) and whether that
    checkpoint is still among the last ``keep`` saved (saves coincide with
    evals). One scan: the best and the last ``keep`` evals of a run are picked
    by ranks that Spark also applies before the shuffle, so a very long run
    sends a few rows from each task."""
    ev = log.filter(F.col("eval_loss").isNotNull() & F.col("step").isNotNull()).select(run_col, "step", "eval_loss")
    picks = F.explode(F.array(F.struct(F.lit(True).alias("late"), (-F.col("step")).cast("double").alias("by")),
                              F.struct(F.lit(False).alias("late"), F.col("eval_loss").cast("double").alias("by"))))
    x = ev.select(run_col, "step", "eval_loss", picks.alias("p")).select(run_col, "step", "eval_loss", "p.*")
    place = F.row_number().over(Window.partitionBy(run_col, "late").orderBy("by", "step"))
    x = x.withColumn("_r", place).filter(F.col("_r") <= max(keep, 1))
    late, best = F.col("late") & (F.col("_r") <= keep), ~F.col("late") & (F.col("_r") == 1)
    g = x.groupBy(run_col).agg(
        F.max(F.when(best, F.col("step"))).alias("best_step"),
        F.max(F.when(best, F.col("eval_loss"))).alias("best_eval_loss"),
        F.min(F.when(late, F.col("step"))).alias("_kth"))
    return g.select(run_col, "best_step", "best_eval_loss", (F.col("best_step") >= F.col("_kth")).alias("still_kept"))
