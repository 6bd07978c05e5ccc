"""Registered queries: losses (W1-W3), run logs (R1-R2), inference prompt and
response tables (P5, I1-I4).

Token-loss table: ``lineitem`` as token rows -- example = l_orderkey, pos =
rank inside the order by (l_linenumber, l_partkey, l_suppkey, l_shipdate,
l_extendedprice), label = l_partkey (-100 for returned lines), weight 5.0 for
status F, loss = a 16-bit hash / 1024 (exact binary fractions, so sums are
exact in any order), batch = l_orderkey div 32.
Run log: ``events`` -- run = user_id, step = event_id, 'view' rows carry the
training loss, 'purchase' rows the eval loss.
Responses: every ``benchmark`` item's whole text mapped to brackets (the
documents rule), answered by a trace-format response whose answer and phrasing
vary by hash draws.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.hashing import draw, draw_sql
from sftforge.functions.text import DEFAULT_TEMPLATE as TPL
from sftforge.functions.text import sql_str, tokens
from sftforge.operators import chat, losses, responses, synth
from sftforge.operators.brackets import closers_needed
from sftforge.plans.bracket_queries import KEEP_CLASS, MAP_FROM, MAP_TO, doc_sequences
from sftforge.plans.chat_queries import STRIP_SQL, TOKEN_SQL
from sftforge.plans.registry import register
from sftforge.plans.synth_queries import SPLIT_SQL, main_split, stack_after_sql, trace_sql
from sftforge.sources.tables import table

# --- lineitem as a token-loss table -------------------------------------------------------------


def token_losses(spark, d):
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                                                 "l_extendedprice")
    li = li.withColumn("pos", (F.row_number().over(w) - 1).cast("bigint"))
    loss = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("loss"), F.col("l_orderkey").cast("string"),
                                                F.col("pos").cast("string"))), 1, 4), 16, 10).cast("bigint") / 1024.0
    return li.select(
        F.col("l_orderkey").alias("example_id"), "pos",
        F.when(F.col("l_returnflag") == "R", F.lit(K.IGNORE_INDEX)).otherwise(F.col("l_partkey").cast("int"))
         .alias("label"),
        F.when(F.col("l_linestatus") == "F", F.lit(5.0)).otherwise(F.lit(1.0)).alias("weight"),
        loss.alias("loss"),
        F.floor(F.col("l_orderkey") / 32).cast("bigint").alias("batch_id"))


TOKEN_LOSS_SQL = f"""
tl0 AS (SELECT l_orderkey AS example_id,
               (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                   l_shipdate, l_extendedprice) - 1) AS pos,
               CASE WHEN l_returnflag = 'R' THEN {K.IGNORE_INDEX} ELSE CAST(l_partkey AS INTEGER) END AS label,
               CASE WHEN l_linestatus = 'F' THEN 5.0 ELSE 1.0 END::DOUBLE AS weight,
               l_orderkey // 32 AS batch_id
        FROM lineitem),
tl AS (SELECT *, ('0x' || substr(md5('loss:' || CAST(example_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR)), 1, 4))::BIGINT
                 / 1024.0 AS loss FROM tl0),
sh AS (SELECT a.*, b.label AS target, b.weight AS target_weight
       FROM tl a JOIN tl b ON a.example_id = b.example_id AND b.pos = a.pos + 1)"""


@register("next_token_shift", f"WITH {TOKEN_LOSS_SQL} SELECT example_id, pos::BIGINT AS pos, target, target_weight FROM sh")
def q_next_token_shift(spark, d):
    return losses.shift_next(token_losses(spark, d)).select("example_id", "pos", "target", "target_weight")


@register("weighted_token_loss", f"""
WITH {TOKEN_LOSS_SQL}
SELECT batch_id::BIGINT AS batch_id,
       sum(CASE WHEN target <> {K.IGNORE_INDEX} THEN loss * target_weight ELSE 0 END) AS weighted_sum,
       sum(CASE WHEN target <> {K.IGNORE_INDEX} THEN target_weight ELSE 0 END) AS weight_sum,
       sum(CASE WHEN target <> {K.IGNORE_INDEX} THEN loss * target_weight ELSE 0 END)
         / greatest(sum(CASE WHEN target <> {K.IGNORE_INDEX} THEN target_weight ELSE 0 END), {K.LOSS_WEIGHT_FLOOR})
         AS loss
FROM sh GROUP BY batch_id""")
def q_weighted_token_loss(spark, d):
    return losses.weighted_loss(losses.shift_next(token_losses(spark, d)), "batch_id")


@register("token_cross_entropy", """
WITH e AS (SELECT vec_id, label, embedding, list_max(embedding)::DOUBLE AS m FROM embeddings)
SELECT vec_id, label,
       round(CASE WHEN label = -100 THEN 0.0 WHEN label >= 0 AND label < len(embedding)
             THEN m + ln(list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE - m))))
                  - embedding[label + 1]::DOUBLE END, 6) AS loss
FROM e""")
def q_token_cross_entropy(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.round(losses.cross_entropy(F.col("embedding"), F.col("label")), 6).alias("loss"))


# --- run log -----------------------------------------------------------------------------------

def run_log(spark, d):
    ev = table(spark, d, "events")
    return ev.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("step"),
                     F.when(F.col("event_type") == "view", F.col("value")).alias("loss"),
                     F.when(F.col("event_type") == "purchase", F.col("value")).alias("eval_loss"))


LOG_SQL = """
lg AS (SELECT user_id AS run_id, event_id AS step,
              CASE WHEN event_type = 'view' THEN value END AS loss,
              CASE WHEN event_type = 'purchase' THEN value END AS eval_loss FROM events)"""


@register("loss_curves", f"""
WITH {LOG_SQL}
SELECT run_id, 'train' AS series, step, loss AS value FROM lg WHERE loss IS NOT NULL AND step IS NOT NULL
UNION ALL
SELECT run_id, 'eval' AS series, step, eval_loss AS value FROM lg WHERE eval_loss IS NOT NULL AND step IS NOT NULL""")
def q_loss_curves(spark, d):
    return losses.loss_curves(run_log(spark, d))


@register("best_checkpoint", f"""
WITH {LOG_SQL},
ev AS (SELECT * FROM lg WHERE eval_loss IS NOT NULL AND step IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) AS rb,
             row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS rs FROM ev),
k AS (SELECT run_id, min(step) AS kth FROM r WHERE rs <= {K.SAVE_TOTAL_LIMIT} GROUP BY run_id)
SELECT r.run_id, r.step AS best_step, r.eval_loss AS best_eval_loss, r.step >= k.kth AS still_kept
FROM r JOIN k ON r.run_id = k.run_id WHERE r.rb = 1""")
def q_best_checkpoint(spark, d):
    return losses.best_checkpoint(run_log(spark, d))


# --- P5 / I1 ------------------------------------------------------------------------------------

def infer_prompt_sql(x: str) -> str:
    return f"({sql_str(K.INFER_PROMPT_HEAD)} || {x} || {sql_str(K.INFER_PROMPT_TAIL)})"


@register("prompt_render_infer", f"WITH {SPLIT_SQL} SELECT task_row, {infer_prompt_sql('q')} AS prompt FROM sp")
def q_prompt_render_infer(spark, d):
    return chat.render_infer_prompt(main_split(spark, d), "question_sequence").select("task_row", "prompt")


def request_sql(seq: str, max_length: int = K.MAX_LENGTH_INFER) -> tuple[str, str]:
    text = TPL.sql_request(infer_prompt_sql(seq))
    toks = f"regexp_extract_all({text}, {TOKEN_SQL})"
    req = (f"CASE WHEN len({toks}) <= {max_length} THEN {text} "
           f"ELSE array_to_string(list_slice({toks}, 1, {max_length}), '') END")
    return req, f"len({toks})"


_REQ, _REQ_N = request_sql("seq")


@register("inference_requests", f"""
WITH src AS (SELECT doc_id AS seq_id,
                    regexp_replace(translate(text, '{MAP_FROM}', '{MAP_TO}'), '{KEEP_CLASS}', '', 'g') AS seq
             FROM documents)
SELECT seq_id, {_REQ} AS request_text, least({_REQ_N}, {K.MAX_LENGTH_INFER})::BIGINT AS n_tokens,
       {_REQ_N} > {K.MAX_LENGTH_INFER} AS truncated
FROM src""")
def q_inference_requests(spark, d):
    s = doc_sequences(spark, d).withColumnRenamed("seq", "sequence")
    return responses.inference_requests(s).select("seq_id", "request_text", "n_tokens", "truncated")


# --- I2 / I3 / I4 over synthetic responses -------------------------------------------------------

def bench_outputs(spark, d):
    b = table(spark, d, "benchmark")
    seq = F.regexp_replace(F.translate("text", MAP_FROM, MAP_TO), KEEP_CLASS, "")
    b = b.select(F.col("item_id").alias("seq_id"), seq.alias("sequence"))
    comp = closers_needed(F.col("sequence"))
    full = F.concat(F.col("sequence"), comp)
    answer = F.when(F.pmod(draw("answer", F.col("seq_id")), F.lit(4)) == 0, F.col("sequence")).otherwise(full)
    banned = F.when(F.pmod(draw("banned", F.col("seq_id")), F.lit(5)) == 0, F.lit("Wait... ")).otherwise(F.lit(""))
    body = F.concat(banned, synth.trace_text(F.col("sequence"), comp, full), F.lit("\n" + K.ANSWER_MARKER), answer)
    r = responses.inference_requests(b)
    return r.withColumn("output_text", F.concat(F.col("request_text"), F.lit("\n"), body, F.lit("\n")))


def bench_responses(spark, d):
    return responses.extract_response(bench_outputs(spark, d))


BENCH_SQL = f"""
bs AS (SELECT item_id AS seq_id,
              regexp_replace(translate(text, '{MAP_FROM}', '{MAP_TO}'), '{KEEP_CLASS}', '', 'g') AS seq
       FROM benchmark),
bq AS (SELECT seq_id, seq AS q, reverse({stack_after_sql('seq')}) AS c FROM bs),
bsrc AS (SELECT seq_id, q, c, q || c AS full_sequence FROM bq),
{trace_sql('bsrc', 'seq_id')},
bo AS (SELECT s.seq_id, s.q AS sequence, s.c AS completion,
              {request_sql('s.q')[0]} AS request_text,
              CASE WHEN {draw_sql('banned', 's.seq_id')} % 5 = 0 THEN 'Wait... ' ELSE '' END || tr.trace
                || {sql_str(chr(10) + K.ANSWER_MARKER)}
                || CASE WHEN {draw_sql('answer', 's.seq_id')} % 4 = 0 THEN s.q ELSE s.full_sequence END AS body
       FROM bsrc s LEFT JOIN tr ON s.seq_id = tr.seq_id),
bx AS (SELECT *, request_text || chr(10) || body || chr(10) AS output_text FROM bo),
br AS (SELECT seq_id, sequence, completion,
              regexp_replace(array_to_string(list_slice(regexp_extract_all(output_text, {TOKEN_SQL}),
                  len(regexp_extract_all(request_text, {TOKEN_SQL})) + 1,
                  len(regexp_extract_all(output_text, {TOKEN_SQL}))), ''), {STRIP_SQL}, '', 'g') AS response
       FROM bx),
bp AS (SELECT *, len(regexp_extract_all(response, '{responses.THOUGHT_RE}'))::BIGINT AS n_thoughts,
              array_to_string(regexp_extract_all(response, '{responses.STEP_RE.replace("'", "''")}', 1), '') AS step_closers,
              CASE WHEN strpos(response, {sql_str(K.ANSWER_MARKER)}) > 0
                   THEN regexp_replace(string_split(response, {sql_str(K.ANSWER_MARKER)})[-1], {STRIP_SQL}, '', 'g')
                   END AS final_answer
       FROM br)"""


@register("response_extract", f"WITH {BENCH_SQL} SELECT seq_id, response FROM br")
def q_response_extract(spark, d):
    return bench_responses(spark, d).select("seq_id", "response")


@register("response_extract_ids", f"""
WITH {BENCH_SQL},
i AS (SELECT seq_id, [length(x) FOR x IN regexp_extract_all(output_text, {TOKEN_SQL})] AS o,
             len(regexp_extract_all(request_text, {TOKEN_SQL})) AS n FROM bx)
SELECT seq_id, array_to_string(list_slice(o, n + 1, len(o)), ',') AS ids_text FROM i""")
def q_response_extract_ids(spark, d):
    """I2, id form: the covering tokens' lengths stand in for token ids."""
    ids = lambda c: F.transform(tokens(F.col(c)), lambda x: F.length(x))
    x = bench_outputs(spark, d).withColumn("output_ids", ids("output_text")).withColumn(
        "prompt_ids", ids("request_text"))
    return responses.extract_response_ids(x).select(
        "seq_id", F.array_join(F.col("response_ids").cast("array<string>"), ",").alias("ids_text"))


@register("response_parse", f"WITH {BENCH_SQL} SELECT seq_id, n_thoughts, step_closers, final_answer FROM bp")
def q_response_parse(spark, d):
    return responses.parse_responses(bench_responses(spark, d)).select(
        "seq_id", "n_thoughts", "step_closers", "final_answer")


@register("response_conformance", f"""
WITH {BENCH_SQL},
fl AS (SELECT sequence,
              n_thoughts > 0 AND strpos(response, {sql_str(K.RESPONSE_ORDER_LINE)}) > 0
                AND strpos(response, {sql_str(K.ANSWER_MARKER)}) > 0 AS format_ok,
              strpos(response, 'Wait...') > 0 OR strpos(response, 'Let me recount') > 0 AS banned,
              step_closers = completion AS steps_ok,
              coalesce(final_answer = sequence || completion, false) AS answer_ok
       FROM bp)
SELECT length(sequence)::BIGINT AS prefix_length, count(*)::BIGINT AS n,
       avg(coalesce(format_ok, false)::INTEGER)::DOUBLE AS format_rate,
       avg(coalesce(banned, false)::INTEGER)::DOUBLE AS banned_rate,
       avg(coalesce(steps_ok, false)::INTEGER)::DOUBLE AS steps_rate, avg(answer_ok::INTEGER)::DOUBLE AS answer_rate
FROM fl GROUP BY length(sequence)""")
def q_response_conformance(spark, d):
    return responses.response_conformance(bench_responses(spark, d))
