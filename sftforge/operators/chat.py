"""Conversations to SFT texts: P1 last messages, P2 rejects, P3 compose,
P4 chat render, P5 inference prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.text import DEFAULT_TEMPLATE, ChatTemplate, infer_prompt, py_strip


def last_messages(df: DataFrame, id_col: str = "conv_id", reasoning: str = "none") -> DataFrame:
    """Last user and last assistant message per conversation, chosen
    independently (last wins per role); other roles are dropped.

    Input is either a turn table (id, turn, role, text) -- one aggregation with
    ``max_by`` (partial aggregation, so a huge conversation does not land whole
    in one task) -- or an array column ``conversation`` (no shuffle at all).
    From a turn table, ``reasoning='previous_assistant'`` takes the assistant
    message before the last as its reasoning: the last two messages of each role
    are picked by a rank that Spark also applies before the shuffle, so here too
    a huge conversation sends two rows from each task.
    Output: id, user, user_turn, assistant, reasoning, assistant_turn,
    user_after_assistant (+ malformed when the input has it).
    """
    if "conversation" in df.columns:
        idx = F.transform("conversation", lambda m, i: F.struct(i.alias("i"), m.alias("m")))
        u = F.try_element_at(F.filter(idx, lambda x: x["m"]["role"] == "user"), F.lit(-1))
        a = F.try_element_at(F.filter(idx, lambda x: x["m"]["role"] == "assistant"), F.lit(-1))
        extra = [c for c in ("malformed", "errors", "line_no") if c in df.columns]
        out = df.select(
            id_col, *extra,
            u["m"]["content"].alias("user"), u["i"].cast("bigint").alias("user_turn"),
            a["m"]["content"].alias("assistant"),
            a["m"]["reasoning_content"].alias("reasoning"),
            a["i"].cast("bigint").alias("assistant_turn"))
    elif reasoning == "previous_assistant":
        late = Window.partitionBy(id_col, "role").orderBy(F.desc("turn"))
        two = (df.filter(F.col("role").isin("user", "assistant")).select(id_col, "role", "turn", "text")
               .withColumn("_r", F.row_number().over(late)).filter(F.col("_r") <= 2))
        pick = lambda role, r, c: F.max(F.when((F.col("role") == role) & (F.col("_r") == r), F.col(c)))
        # conversations without either role keep their row
        out = (df.select(id_col).distinct().join(two, id_col, "left").groupBy(id_col).agg(
            pick("user", 1, "text").alias("user"), pick("user", 1, "turn").alias("user_turn"),
            pick("assistant", 1, "text").alias("assistant"), pick("assistant", 1, "turn").alias("assistant_turn"),
            F.coalesce(pick("assistant", 2, "text"), F.lit("")).alias("reasoning")))
    elif reasoning != "none":
        raise ValueError(f"unknown reasoning mode {reasoning!r}")
    else:
        role, turn = F.col("role"), F.col("turn")
        ut = F.when(role == "user", turn)
        at = F.when(role == "assistant", turn)
        out = (df.groupBy(id_col).agg(
            F.max_by("text", ut).alias("user"), F.max(ut).alias("user_turn"),
            F.max_by("text", at).alias("assistant"), F.max(at).alias("assistant_turn"))
            .withColumn("reasoning", F.lit("")))
    return out.withColumn("user_after_assistant",
                          F.coalesce(F.col("user_turn") > F.col("assistant_turn"), F.lit(False)))


def reject_reason(df: DataFrame) -> DataFrame:
    """Add ``reason`` (null = usable): malformed, missing_user,
    missing_assistant, wrong_type (a number, list or object where text is needed;
    from the reader's ``errors``), null_text (an explicit JSON null there).
    The audit's skip rule, used for preparation too."""
    r = F.when(F.lit(False), F.lit(None))
    if "malformed" in df.columns:
        r = r.when(F.col("malformed"), F.lit("malformed"))
    r = (r.when(F.col("user_turn").isNull(), F.lit("missing_user"))
          .when(F.col("assistant_turn").isNull(), F.lit("missing_assistant"))
          .when(F.col("user").isNull() | F.col("assistant").isNull() | F.col("reasoning").isNull(),
                wrong_type(df)))
    return df.withColumn("reason", r)


def wrong_type(df: DataFrame):
    """Why a text that the last messages need is null: one of their ``errors``, or a JSON null."""
    if "errors" not in df.columns:
        return F.lit("null_text")
    def has(turn, field):
        return F.exists("errors", lambda e: e.startswith(F.concat(F.col(turn).cast("string"), F.lit(f": {field} is "))))
    return F.when(has("user_turn", "content") | has("assistant_turn", "content")
                  | has("assistant_turn", "reasoning_content"), F.lit("wrong_type")).otherwise(F.lit("null_text"))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with reason) from one classified frame."""
    c = reject_reason(df)
    return c.filter(F.col("reason").isNull()).drop("reason"), c.filter(F.col("reason").isNotNull())


def compose_assistant(df: DataFrame, reasoning: str = "reasoning", completion: str = "assistant",
                      out: str = "assistant_text") -> DataFrame:
    """Strip both parts; both non-empty -> reasoning + "\\n\\nFINAL ANSWER: " +
    completion; otherwise whichever is non-empty (completion first)."""
    r, c = py_strip(F.col(reasoning)), py_strip(F.col(completion))
    text = (F.when((r != "") & (c != ""), F.concat(r, F.lit(K.ANSWER_JOIN), c))
            .when(c != "", c).otherwise(r))
    return df.withColumn(out, text)


def render_chat(df: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, user: str = "user",
                assistant: str = "assistant_text") -> DataFrame:
    """Full text, user-only text without generation prompt, and user text
    with generation prompt (inference)."""
    u, a = F.col(user), F.col(assistant)
    return (df.withColumn("full_text", template.full_text(u, a))
              .withColumn("user_text", template.user_text(u))
              .withColumn("request_text", template.request_text(u)))


def render_infer_prompt(df: DataFrame, sequence_col: str = "sequence", out: str = "prompt") -> DataFrame:
    """P5: inference prompt (its own wording) for a table of sequences."""
    return df.withColumn(out, infer_prompt(F.col(sequence_col)))


def prepare_texts(df: DataFrame, id_col: str = "conv_id", template: ChatTemplate = DEFAULT_TEMPLATE,
                  reasoning: str = "none") -> tuple[DataFrame, DataFrame]:
    """P1 -> P2 -> P3 -> P4 in one plan: (usable rows with texts, rejected rows)."""
    usable, rejected = split_rejects(last_messages(df, id_col, reasoning))
    return render_chat(compose_assistant(usable), template), rejected
