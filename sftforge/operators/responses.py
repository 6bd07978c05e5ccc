"""Response tables around the model: I1 requests, I2 extraction, I3 parsing,
I4 conformance. The model itself is not part of the library; I1 feeds any
scorer, I2-I4 read its output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.text import DEFAULT_TEMPLATE, ChatTemplate, infer_prompt, py_strip, token_count, tokens
from sftforge.operators.brackets import closers_needed

THOUGHT_RE = r"(?m)^# Thought \d+:"
STEP_RE = r"# Step \d+: add '(.)'\."


def inference_requests(df: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE,
                       max_length: int = K.MAX_LENGTH_INFER, seq_col: str = "sequence") -> DataFrame:
    """Sequence -> chat text with generation prompt, head-truncated to
    ``max_length`` tokens (arrays are built only for rows that exceed it)."""
    text = template.request_text(infer_prompt(F.col(seq_col)))
    n = token_count(text)
    cut = F.array_join(F.slice(tokens(text), 1, max_length), "")
    return (df.withColumn("request_text", F.when(n <= max_length, text).otherwise(cut))
              .withColumn("n_tokens", F.least(n, F.lit(max_length)).cast("bigint"))
              .withColumn("truncated", n > max_length))


def extract_response(df: DataFrame, output_col: str = "output_text", prompt_col: str = "request_text") -> DataFrame:
    """I2 (text form): the output's tokens after the prompt's tokens, joined
    and stripped -- generated ids minus the prompt ids, at the token level."""
    out_toks = tokens(F.col(output_col))
    n_prompt = token_count(F.col(prompt_col))
    rest = F.slice(out_toks, n_prompt + 1, F.greatest(F.size(out_toks) - n_prompt, F.lit(0)))
    return df.withColumn("response", py_strip(F.array_join(rest, "")))


def extract_response_ids(df: DataFrame, output_col: str = "output_ids", prompt_col: str = "prompt_ids") -> DataFrame:
    """I2 (id form): ``output_ids`` without the leading prompt ids."""
    n = F.size(prompt_col)
    return df.withColumn("response_ids", F.slice(output_col, n + 1, F.greatest(F.size(output_col) - n, F.lit(0))))


def parse_responses(df: DataFrame, response_col: str = "response") -> DataFrame:
    """Number of ``# Thought N:`` lines, the closers named by ``# Step k:
    add 'X'.`` lines in order, and the final answer (after the last
    ``FINAL ANSWER: ``, stripped; null when absent)."""
    r = F.col(response_col)
    final = F.when(F.instr(r, K.ANSWER_MARKER) > 0, py_strip(F.substring_index(r, K.ANSWER_MARKER, -1)))
    return (df.withColumn("n_thoughts", F.regexp_count(r, F.lit(THOUGHT_RE)).cast("bigint"))
              .withColumn("step_closers", F.array_join(F.regexp_extract_all(r, F.lit(STEP_RE), F.lit(1)), ""))
              .withColumn("final_answer", final))


def response_conformance(df: DataFrame, seq_col: str = "sequence", response_col: str = "response") -> DataFrame:
    """I4: per response, the format rules stated in the prompts; then rates
    per prefix length. The expected completion is computed in the same row
    (B4 fold), so no join is needed. A null response keeps no rule, so it counts
    in every rate."""
    p = parse_responses(df, response_col)
    r = F.col(response_col)
    completion = closers_needed(F.col(seq_col))
    fmt_ok = (F.col("n_thoughts") > 0) & (F.instr(r, K.RESPONSE_ORDER_LINE) > 0) & (F.instr(r, K.ANSWER_MARKER) > 0)
    banned = F.lit(False)
    for ph in K.BANNED_PHRASES:
        banned = banned | (F.instr(r, ph) > 0)
    flags = (p.withColumn("format_ok", fmt_ok)
              .withColumn("banned", banned)
              .withColumn("steps_ok", F.col("step_closers") == completion)
              .withColumn("answer_ok", F.coalesce(F.col("final_answer") == F.concat(F.col(seq_col), completion),
                                                  F.lit(False))))
    rate = lambda c: F.avg(F.coalesce(F.col(c), F.lit(False)).cast("double"))
    return flags.groupBy(F.length(seq_col).cast("bigint").alias("prefix_length")).agg(
        F.count(F.lit(1)).alias("n"), rate("format_ok").alias("format_rate"), rate("banned").alias("banned_rate"),
        rate("steps_ok").alias("steps_rate"), rate("answer_ok").alias("answer_rate"))
