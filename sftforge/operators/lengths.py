"""Length audit: L1 line cap, L2 token lengths, L3 rank statistics, L4 advice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.text import token_count
from sftforge.sources.conversations import number_lines


def cap_lines(lines: DataFrame, n: int | None = None) -> DataFrame:
    """L1: every physical line (blank ones counted) with its ``line_no``, or
    only the first ``n``. ``lines`` comes from :func:`sftforge.sources.read_lines`,
    which reads no file behind the cap if it is told of it (``first=n``)."""
    numbered = number_lines(lines)
    return numbered if n is None else numbered.filter(F.col("line_no") < n)


def in_sample(n: int = K.AUDIT_MAX_LINES):
    """Whether the audit's cap of ``n`` lines would have read a numbered line."""
    return F.col("line_no") < n


def sequence_lengths(df: DataFrame, text_col: str = "full_text", out: str = "length") -> DataFrame:
    """L2: untruncated token count per row (regex match count; no array built)."""
    return df.withColumn(out, token_count(F.col(text_col)).cast("bigint"))


def _rank_value(k):
    """Smallest length whose cumulative count exceeds the 0-based rank ``k``."""
    return F.min(F.when(F.col("_cum") > k, F.col("_len")))


def length_stats(df: DataFrame, length_col: str = "length", skipped: DataFrame | int | str | None = None,
                 over: int | None = None) -> DataFrame:
    """L3: n, n_skipped, min, max, mean, p50, p95, p99 (and ``n_over``, the rows
    longer than ``over``, if that is given).

    Ranks follow the audit: element ``n//2``, ``int(n*0.95)``, ``int(n*0.99)`` of
    the sorted list, p95 = max if n < 20, p99 = max if n < 100. Computed from a
    histogram (one row per distinct length, partial aggregation) in one pass, so
    no global sort of the rows; the running counts are windows over the
    histogram only. ``skipped``: ``"nulls"`` = rows with a null length are the
    skipped ones (one classified table), a DataFrame of rejected rows, an int,
    or None. An empty input gives zero rows.
    """
    size = F.when(F.col("_len").isNotNull(), F.col("_cnt")).otherwise(F.lit(0))
    hist = df.groupBy(F.col(length_col).alias("_len")).agg(F.count(F.lit(1)).alias("_cnt"))
    whole = Window.orderBy("_len").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("_len").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("_cum", F.sum(size).over(upto)).withColumn("_n", F.sum(size).over(whole))
    n = F.col("_n")
    k95 = F.when(n >= K.P95_MIN_N, F.floor(n * F.lit(0.95)).cast("bigint")).otherwise(n - 1)
    k99 = F.when(n >= K.P99_MIN_N, F.floor(n * F.lit(0.99)).cast("bigint")).otherwise(n - 1)
    n_skipped = F.sum(F.when(F.col("_len").isNull(), F.col("_cnt")).otherwise(F.lit(0))).cast("bigint")
    stats = (hist.agg(
        F.max("_n").alias("n"), n_skipped.alias("n_skipped"),
        F.min("_len").cast("bigint").alias("min"), F.max("_len").cast("bigint").alias("max"),
        (F.sum(F.col("_len") * F.col("_cnt")) / F.max("_n")).alias("mean"),
        _rank_value(F.expr("_n div 2")).cast("bigint").alias("p50"),
        _rank_value(k95).cast("bigint").alias("p95"), _rank_value(k99).cast("bigint").alias("p99"),
        F.sum(F.when(F.col("_len") > (over or 0), F.col("_cnt")).otherwise(F.lit(0))).cast("bigint").alias("n_over"))
        .filter(F.col("n") > 0))
    if skipped is None or isinstance(skipped, int):
        stats = stats.withColumn("n_skipped", F.lit(skipped or 0).cast("bigint"))
    elif not isinstance(skipped, str):
        stats = stats.drop("n_skipped").crossJoin(F.broadcast(skipped.agg(F.count(F.lit(1)).alias("n_skipped"))))
    return stats.select("n", "n_skipped", "min", "max", "mean", "p50", "p95", "p99",
                        *(["n_over"] if over is not None else []))


def audit_lengths(df: DataFrame, id_col: str = "conv_id", template=None) -> DataFrame:
    """The audit in one pass: (id, reason, length) for every conversation --
    ``length`` is the token count of the rendered full text, null for rows
    the audit skips (``reason`` says why). Feed to
    ``length_stats(..., skipped="nulls")``."""
    from sftforge.functions.text import DEFAULT_TEMPLATE
    from sftforge.operators import chat
    c = chat.reject_reason(chat.last_messages(df, id_col))
    t = chat.render_chat(chat.compose_assistant(c), template or DEFAULT_TEMPLATE)
    length = F.when(F.col("reason").isNull(), token_count(F.col("full_text"))).cast("bigint")
    return t.select(id_col, "reason", length.alias("length"))


def max_length_advice(stats: DataFrame, configured: int = K.MAX_LENGTH_TRAIN) -> DataFrame:
    """L4: is the configured max length enough; if not, suggest max + 64. With
    ``n_over`` among the stats (:func:`length_stats` with ``over=configured``),
    also the number of rows that would be truncated."""
    return stats.select(
        "max", F.lit(configured).cast("bigint").alias("configured"),
        (F.col("max") <= configured).alias("ok"),
        F.when(F.col("max") > configured, F.col("max") + K.ADVICE_MARGIN).cast("bigint").alias("suggested"),
        *([F.col("n_over").alias("n_truncated")] if "n_over" in stats.columns else []))
