"""Registered queries: conversation fold, last messages, rejects, compose,
chat render and the length audit (S3, P1-P4, L2-L4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.text import DEFAULT_TEMPLATE as TPL
from sftforge.functions.text import STRIP_PATTERN, TOKEN_PATTERN, sql_str
from sftforge.operators import chat, lengths
from sftforge.plans.registry import register
from sftforge.sources.conversations import fold_turns
from sftforge.sources.tables import table

STRIP_SQL = sql_str(STRIP_PATTERN)
TOKEN_SQL = sql_str(TOKEN_PATTERN)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {STRIP_SQL}, '', 'g')"


def sql_compose(r: str, c: str) -> str:
    return (f"CASE WHEN {r} <> '' AND {c} <> '' THEN {r} || {sql_str(K.ANSWER_JOIN)} || {c} "
            f"WHEN {c} <> '' THEN {c} ELSE {r} END")


def sql_tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {TOKEN_SQL})"


def turns(spark, d):
    return table(spark, d, "conversations")


def usable_texts(spark, d, reasoning: str = "none"):
    """Conversations -> usable rows with full/user/request texts.

    Last messages straight from the turn table; ``'previous_assistant'``: the
    assistant's reasoning is the previous assistant turn."""
    return chat.prepare_texts(turns(spark, d), "conv_id", TPL, reasoning)


# --- SQL building blocks over the turn table -------------------------------------------------

LAST_SQL = """
SELECT conv_id,
       max(turn) FILTER (WHERE role = 'user') AS u_turn,
       max(turn) FILTER (WHERE role = 'assistant') AS a_turn,
       max_by(text, turn) FILTER (WHERE role = 'user') AS u,
       max_by(text, turn) FILTER (WHERE role = 'assistant') AS a
FROM conversations GROUP BY conv_id"""

USABLE_SQL = f"""
SELECT conv_id, u, {TPL.sql_full('u', sql_compose(sql_strip("''"), sql_strip('a')))} AS full_text
FROM ({LAST_SQL}) WHERE u_turn IS NOT NULL AND a_turn IS NOT NULL AND u IS NOT NULL AND a IS NOT NULL"""

# assistant with the previous assistant turn as reasoning
COMPOSED_SQL = f"""
WITH a AS (
  SELECT conv_id, turn, text,
         coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS prev,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
  FROM conversations WHERE role = 'assistant'),
u AS (SELECT conv_id, arg_max(text, turn) AS u FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT a.conv_id, u.u AS u, {sql_compose(sql_strip('a.prev'), sql_strip('a.text'))} AS assistant_text
FROM a JOIN u ON a.conv_id = u.conv_id WHERE a.rn = 1"""


# --- S3 --------------------------------------------------------------------------------------

@register("conversation_fold", """
SELECT conv_id, count(*)::BIGINT AS n_messages,
       string_agg(role, ',' ORDER BY turn) AS roles,
       sum(length(text))::BIGINT AS n_chars,
       md5(string_agg(text, chr(1) ORDER BY turn)) AS content_md5
FROM conversations GROUP BY conv_id""")
def q_conversation_fold(spark, d):
    f = fold_turns(turns(spark, d))
    conv = F.col("conversation")
    return f.select(
        "conv_id",
        F.size(conv).cast("bigint").alias("n_messages"),
        F.array_join(F.transform(conv, lambda m: m["role"]), ",").alias("roles"),
        F.aggregate(conv, F.lit(0).cast("bigint"), lambda acc, m: acc + F.length(m["content"])).alias("n_chars"),
        F.md5(F.array_join(F.transform(conv, lambda m: m["content"]), "\x01")).alias("content_md5"))


# --- P1 --------------------------------------------------------------------------------------

@register("role_last_wins", f"""
SELECT conv_id, u AS "user", a AS assistant, coalesce(u_turn > a_turn, false) AS user_after_assistant
FROM ({LAST_SQL})""")
def q_role_last_wins(spark, d):
    return chat.last_messages(turns(spark, d)).select("conv_id", "user", "assistant", "user_after_assistant")


# --- P2 --------------------------------------------------------------------------------------

@register("conversation_rejects", f"""
SELECT conv_id,
       CASE WHEN u_turn IS NULL THEN 'missing_user' WHEN a_turn IS NULL THEN 'missing_assistant'
            ELSE 'null_text' END AS reason
FROM ({LAST_SQL}) WHERE u_turn IS NULL OR a_turn IS NULL OR u IS NULL OR a IS NULL""")
def q_conversation_rejects(spark, d):
    _, rejected = chat.split_rejects(chat.last_messages(turns(spark, d)))
    return rejected.select("conv_id", "reason")


# --- P3 --------------------------------------------------------------------------------------

@register("assistant_compose", f"SELECT conv_id, assistant_text FROM ({COMPOSED_SQL})")
def q_assistant_compose(spark, d):
    texts, _ = usable_texts(spark, d, reasoning="previous_assistant")
    return texts.select("conv_id", "assistant_text")


# --- P4 --------------------------------------------------------------------------------------

@register("chat_render", f"""
SELECT conv_id, {TPL.sql_full('u', 'assistant_text')} AS full_text,
       {TPL.sql_user('u')} AS user_text, {TPL.sql_request('u')} AS request_text
FROM ({COMPOSED_SQL})""")
def q_chat_render(spark, d):
    texts, _ = usable_texts(spark, d, reasoning="previous_assistant")
    return texts.select("conv_id", "full_text", "user_text", "request_text")


# --- L2 / L3 / L4 ----------------------------------------------------------------------------

LENGTHS_SQL = f"SELECT conv_id, len({sql_tokens('full_text')})::BIGINT AS length FROM ({USABLE_SQL})"

STATS_SQL = f"""
WITH t AS ({LENGTHS_SQL}),
s AS (SELECT length, row_number() OVER (ORDER BY length) - 1 AS rk, count(*) OVER () AS cnt FROM t),
sk AS (SELECT count(*)::BIGINT AS n_skipped FROM ({LAST_SQL})
       WHERE u_turn IS NULL OR a_turn IS NULL OR u IS NULL OR a IS NULL)
SELECT count(*)::BIGINT AS n, any_value(sk.n_skipped) AS n_skipped,
       min(length)::BIGINT AS min, max(length)::BIGINT AS max,
       sum(length)::DOUBLE / count(*) AS mean,
       max(length) FILTER (WHERE rk = cnt // 2)::BIGINT AS p50,
       max(length) FILTER (WHERE rk = CASE WHEN cnt >= 20 THEN floor(cnt * 0.95::DOUBLE) ELSE cnt - 1 END)::BIGINT AS p95,
       max(length) FILTER (WHERE rk = CASE WHEN cnt >= 100 THEN floor(cnt * 0.99::DOUBLE) ELSE cnt - 1 END)::BIGINT AS p99
FROM s, sk HAVING count(*) > 0"""


def audit_table(spark, d):
    """One classified pass: every conversation with its length (null = skipped)."""
    return lengths.audit_lengths(turns(spark, d), "conv_id", TPL)


@register("sequence_lengths", LENGTHS_SQL)
def q_sequence_lengths(spark, d):
    return audit_table(spark, d).filter(F.col("reason").isNull()).select("conv_id", "length")


@register("length_stats", STATS_SQL)
def q_length_stats(spark, d):
    return lengths.length_stats(audit_table(spark, d), skipped="nulls")


@register("max_length_advice", f"""
WITH st AS ({STATS_SQL}), t AS ({LENGTHS_SQL})
SELECT st.max, {K.MAX_LENGTH_TRAIN}::BIGINT AS configured, st.max <= {K.MAX_LENGTH_TRAIN} AS ok,
       CASE WHEN st.max > {K.MAX_LENGTH_TRAIN} THEN st.max + {K.ADVICE_MARGIN} END::BIGINT AS suggested,
       (SELECT count(*) FROM t WHERE length > {K.MAX_LENGTH_TRAIN})::BIGINT AS n_truncated
FROM st""")
def q_max_length_advice(spark, d):
    st = lengths.length_stats(audit_table(spark, d), skipped="nulls", over=K.MAX_LENGTH_TRAIN)
    return lengths.max_length_advice(st, K.MAX_LENGTH_TRAIN)
