"""Registered queries: synthetic tasks (G1-G8) and the JSONL / task-record
sources and sinks (S1, S2, S4) and line cap (L1).

Tasks come from the ``orders`` table: one task per order row, task_row =
o_orderkey, seed drawn from it (G1). The oracle recomputes every draw with
DuckDB's md5 and folds attempts with ``list_reduce``, wave by wave with an
anti-join of solved tasks, so it is written differently from the Spark plan
(a per-row attempt loop in an Arrow-batched UDF, no shuffle).

The files of S1, S2, S4, G8 and L1 lie below the session's shared scratch
folder, one new folder a query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.hashing import draw_sql
from sftforge.functions.text import DEFAULT_TEMPLATE as TPL
from sftforge.functions.text import TOKEN_PATTERN, each, py_strip, sql_fmt, sql_str
from sftforge.operators import chat, synth
from sftforge.operators import brackets as B
from sftforge.operators import examples as X
from sftforge.operators.layout import spread
from sftforge.operators.lengths import cap_lines, in_sample
from sftforge.plans.chat_queries import COMPOSED_SQL, TOKEN_SQL
from sftforge.plans.registry import register
from sftforge.session import scratch_path
from sftforge.sources.conversations import (
    conversation_json, fold_turns, messages_of, parse_conversation, read_conversations, read_lines, write_conversations,
)
from sftforge.sources.tables import table
from sftforge.sources.tasks import read_tasks, task_json

CORPUS_SEED = 0
N = len(K.BRACKET_PAIRS)


#: Lines of a compressed file, which one task reads whole.
FILE_LINES = 100_000


def order_tasks(spark, d, in_order=False):
    """Tasks, ``in_order`` sorted by row: the rows are dealt in ranges and sorted
    before anything is made of them, and all that follows keeps their order."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("task_row"))
    if in_order:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(ranges, "task_row").sortWithinPartitions("task_row")
    else:
        rows = spread(rows)
    return synth.assign_task_ids(rows, "task_row", CORPUS_SEED)


# --- parameter sets ------------------------------------------------------------------------

def main_params(spark, d):
    return synth.task_parameters(order_tasks(spark, d), K.MAIN_N_TYPES, K.MAIN_TOTAL_LENGTH,
                                 K.MAIN_FILL_LENGTH, K.MAIN_NESTING_DEPTH)


def random_params(spark, d):
    return synth.task_parameters(order_tasks(spark, d), K.DEFAULT_N_TYPES, 0, 0, 0)


def mixed_params(spark, d):
    """total 20, fill 1..12 and depth 0..11 drawn per row: many infeasible."""
    t = order_tasks(spark, d)
    from sftforge.functions.hashing import draw
    fill = 1 + F.pmod(draw("fillpick", F.col("task_row")), F.lit(12))
    depth = F.pmod(draw("depthpick", F.col("task_row")), F.lit(12))
    t = t.withColumn("_fill", fill.cast("int")).withColumn("_depth", depth.cast("int"))
    return synth.task_parameters(t, K.MAIN_N_TYPES, K.MAIN_TOTAL_LENGTH, "_fill", "_depth").drop("_fill", "_depth")


TASKS_SQL = f"""
SELECT o_orderkey AS task_row, {draw_sql('task', str(CORPUS_SEED), 'o_orderkey')} % {K.MAX_TASK_ID + 1} AS seed
FROM orders"""


def params_sql(kind: str) -> str:
    if kind == "main":
        nt, tot, fill, depth = K.MAIN_N_TYPES, str(K.MAIN_TOTAL_LENGTH), str(K.MAIN_FILL_LENGTH), str(K.MAIN_NESTING_DEPTH)
        base = TASKS_SQL
        total = f"{tot}"
        fill_e = fill
    elif kind == "random":
        nt = K.DEFAULT_N_TYPES
        base = TASKS_SQL
        lo_h, hi_h = K.RANDOM_TOTAL_HALF_RANGE
        total = f"(2 * ({lo_h} + {draw_sql('total', 'seed')} % {hi_h - lo_h + 1}))"
        fill_e = None
        depth = "0"
    elif kind == "mixed":
        nt = K.MAIN_N_TYPES
        base = (f"SELECT *, 1 + {draw_sql('fillpick', 'task_row')} % 12 AS pfill, "
                f"{draw_sql('depthpick', 'task_row')} % 12 AS pdepth FROM ({TASKS_SQL})")
        total = str(K.MAIN_TOTAL_LENGTH)
        fill_e = "pfill"
        depth = "pdepth"
    else:
        raise ValueError(kind)
    t_sql = f"SELECT *, CAST({total} AS INTEGER) AS total FROM ({base})"
    if fill_e is None:
        lo = f"greatest(1, floor(total * {K.FILL_LOW_FRACTION}))"
        hi = f"least(floor(total * {K.FILL_HIGH_FRACTION}), floor(total / 2))"
        fill_e = f"({lo} + {draw_sql('fill', 'seed')} % greatest({hi} - {lo} + 1, 1))"
    return f"""
SELECT task_row, seed, {nt}::INTEGER AS n_types, {min(nt, N)}::INTEGER AS n_used, total,
       CAST({fill_e} AS INTEGER) AS fill, (total - CAST({fill_e} AS INTEGER))::INTEGER AS cut,
       CAST({depth} AS INTEGER) AS depth, CAST(NULL AS VARCHAR) AS invalid
FROM ({t_sql})"""


def _md5_part(key: str, word: int) -> str:
    return f"('0x' || substr(md5('g:' || CAST({key} AS VARCHAR) || ':' || CAST(i AS VARCHAR)), {1 + 8 * word}, 8))::BIGINT"


def fold_sql(key: str) -> str:
    pick = f"({_md5_part(key, 0)} % n_used + 1)"
    u = f"({_md5_part(key, 1)} / 4294967296.0)"
    do_open = f"(i < depth OR length(st.s) = 0 OR (cut - i) <= length(st.s) OR {u} < {K.OPEN_PROBABILITY})"
    return (f"list_reduce(range(0, greatest(cut, depth)), lambda st, i: CASE WHEN {do_open} "
            f"THEN {{'p': st.p || substr('{K.OPENERS}', {pick}, 1), 's': st.s || substr('{K.CLOSERS}', {pick}, 1)}} "
            f"ELSE {{'p': st.p || right(st.s, 1), 's': left(st.s, length(st.s) - 1)}} END, "
            f"{{'p': '', 's': ''}})")


def generate_sql(params: str, max_attempts: int = K.MAX_ATTEMPTS) -> str:
    """CTE text ending in ``gen(task_row, ..., attempt, full_sequence)``."""
    feasible = ("((2 * fill = total AND depth * 2 <= total) OR (2 * fill < total AND 2 * depth < total - fill)) "
                "AND invalid IS NULL")
    waves = [(lo, min(hi, max_attempts)) for lo, hi in synth.WAVES if lo < max_attempts]
    ctes = [f"prm AS MATERIALIZED ({params})",
            f"todo0 AS MATERIALIZED (SELECT * FROM prm WHERE {feasible})"]
    solved = []
    for j, (lo, hi) in enumerate(waves):
        ctes.append(f"""try{j} AS MATERIALIZED (
  SELECT task_row, att, st.p || reverse(st.s) AS w, length(st.p || reverse(st.s)) = total AND length(st.p) = cut AS ok
  FROM (SELECT todo{j}.*, att, {fold_sql('seed + att')} AS st FROM todo{j}, range({lo}, {hi}) r(att)))""")
        ctes.append(f"""ok{j} AS MATERIALIZED (
  SELECT task_row, min(att) AS attempt, arg_min(w, att) AS full_sequence FROM try{j} WHERE ok GROUP BY task_row)""")
        ctes.append(f"todo{j + 1} AS MATERIALIZED (SELECT * FROM todo{j} WHERE task_row NOT IN (SELECT task_row FROM ok{j}))")
        solved.append(f"SELECT * FROM ok{j}")
    ctes.append("solved AS (" + " UNION ALL ".join(solved) + ")")
    ctes.append("""gen AS (SELECT prm.*, solved.attempt::INTEGER AS attempt, solved.full_sequence
  FROM prm LEFT JOIN solved ON prm.task_row = solved.task_row)""")
    return ",\n".join(ctes)


# --- G1 / G2 ---------------------------------------------------------------------------------

@register("task_ids", f"SELECT task_row, seed FROM ({TASKS_SQL})")
def q_task_ids(spark, d):
    return order_tasks(spark, d).select("task_row", "seed")


PARAM_COLS = ["task_row", "seed", "n_types", "total", "fill", "cut", "depth", "invalid"]


@register("task_parameters", f"SELECT {', '.join(PARAM_COLS)} FROM ({params_sql('random')})")
def q_task_parameters(spark, d):
    return random_params(spark, d).select(*PARAM_COLS)


# --- G3 / G4 ---------------------------------------------------------------------------------

@register("bracket_sequence_generate", f"""
WITH {generate_sql(params_sql('random'))}
SELECT task_row, seed, attempt, full_sequence FROM gen""")
def q_bracket_sequence_generate(spark, d):
    return synth.generate_sequences(random_params(spark, d)).select("task_row", "seed", "attempt", "full_sequence")


@register("infeasible_tasks", f"""
WITH {generate_sql(params_sql('mixed'))}
SELECT task_row, seed, total, fill, depth,
       NOT ((2 * fill = total AND depth * 2 <= total) OR (2 * fill < total AND 2 * depth < total - fill))
         AS closed_form_infeasible
FROM gen WHERE full_sequence IS NULL""")
def q_infeasible_tasks(spark, d):
    g = synth.infeasible_tasks(synth.generate_sequences(mixed_params(spark, d)))
    return g.filter(~F.col("generated")).select("task_row", "seed", "total", "fill", "depth", "closed_form_infeasible")


# --- G5 / G6 / G7 ----------------------------------------------------------------------------

MAIN_GEN = generate_sql(params_sql("main"))
SPLIT_SQL = f"""
{MAIN_GEN},
sp AS (SELECT *, left(full_sequence, cut) AS q, substr(full_sequence, cut + 1) AS c
       FROM gen WHERE full_sequence IS NOT NULL)"""


def main_split(spark, d):
    g = synth.generate_sequences(main_params(spark, d)).filter(F.col("full_sequence").isNotNull())
    return synth.split_tasks(g)


def _uuid_sql(x: str) -> str:
    h = f"md5('trace:' || CAST({x} AS VARCHAR))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


@register("task_split", f"""
WITH {SPLIT_SQL}
SELECT task_row, q AS question_sequence, c AS closing_sequence, c AS answer, {_uuid_sql('seed')} AS trace_id,
       total AS total_length, fill AS fill_length, depth AS nesting_depth FROM sp""")
def q_task_split(spark, d):
    s = main_split(spark, d)
    return s.select("task_row", "question_sequence", "closing_sequence", "answer",
                    F.col("metadata.trace_id").alias("trace_id"), F.col("metadata.total_length").alias("total_length"),
                    F.col("metadata.fill_length").alias("fill_length"),
                    F.col("metadata.nesting_depth").alias("nesting_depth"))


def train_prompt_sql(x: str) -> str:
    return f"({sql_str(K.TRAIN_PROMPT_HEAD)} || {x} || {sql_str(K.TRAIN_PROMPT_TAIL)})"


@register("prompt_render_train", f"WITH {SPLIT_SQL} SELECT task_row, {train_prompt_sql('q')} AS question FROM sp")
def q_prompt_render_train(spark, d):
    return synth.render_train_prompt(main_split(spark, d)).select("task_row", "question")


def list_text_sql(st: str) -> str:
    return f"(CASE WHEN {st} = '' THEN '[]' ELSE '[''' || array_to_string(string_split({st}, ''), ''', ''') || ''']' END)"


def stack_after_sql(prefix: str) -> str:
    return (f"list_reduce(string_split({prefix}, ''), lambda st, ch: CASE "
            f"WHEN ch IN ('(', '[', '{{', '<') THEN st || translate(ch, '{K.OPENERS}', '{K.CLOSERS}') "
            f"WHEN ch IN (')', ']', '}}', '>') AND st <> '' THEN left(st, length(st) - 1) ELSE st END, '')")


def trace_sql(src: str, key: str = "task_row") -> str:
    """CTE text: trace per row of ``src(key, q, c, full_sequence)`` -- per
    position, the stack before and after (a fold over the prefix), one line,
    lines joined in position order."""
    line = (f"CASE WHEN ch IN ('(', '[', '{{', '<') THEN "
            + sql_fmt(K.TRACE_OPEN, step="j", ch="ch", closer=f"translate(ch, '{K.OPENERS}', '{K.CLOSERS}')",
                      stack=list_text_sql("sa"))
            + " WHEN ch IN (')', ']', '}', '>') AND sb <> '' AND right(sb, 1) = ch THEN "
            + sql_fmt(K.TRACE_MATCH, step="j", ch="ch", stack=list_text_sql("sa"))
            + " WHEN ch IN (')', ']', '}', '>') AND sb <> '' THEN "
            + sql_fmt(K.TRACE_MISMATCH, step="j", ch="ch", stack=list_text_sql("sa"))
            + " ELSE '' END")
    return f"""
tc AS (SELECT {key}, unnest(range(1, length(q) + 1)) AS j, unnest(string_split(q, '')) AS ch FROM {src}),
ts AS (SELECT tc.*, {stack_after_sql(f'left(s.q, j - 1)')} AS sb, {stack_after_sql('left(s.q, j)')} AS sa
       FROM tc JOIN {src} s USING ({key})),
tl AS (SELECT {key}, string_agg({line}, '' ORDER BY j) AS lines, arg_max(sa, j) AS final_stack FROM ts GROUP BY {key}),
tk AS (SELECT {key}, string_agg({sql_fmt(K.TRACE_STEP, k='k', ch='cc')}, '' ORDER BY k) AS steps
       FROM (SELECT {key}, unnest(range(1, length(c) + 1)) AS k, unnest(string_split(c, '')) AS cc FROM {src}
             WHERE length(c) > 0) GROUP BY {key}),
tr AS (SELECT s.{key}, tl.lines || {sql_fmt(K.TRACE_SUMMARY, step='length(s.q) + 1', stack=list_text_sql('tl.final_stack'))}
              || {sql_str(K.TRACE_ORDER)} || coalesce(tk.steps, '')
              || {sql_fmt(K.TRACE_CLOSING, closing='s.c')} || {sql_fmt(K.TRACE_COMPLETE, full='s.full_sequence')}
              || {sql_fmt(K.TRACE_VERIFY, full='s.full_sequence')} AS trace
       FROM {src} s JOIN tl ON s.{key} = tl.{key} LEFT JOIN tk ON s.{key} = tk.{key})"""


@register("reasoning_trace", f"WITH {SPLIT_SQL}, {trace_sql('sp')} SELECT task_row, trace FROM tr")
def q_reasoning_trace(spark, d):
    return synth.reasoning_trace(main_split(spark, d)).select("task_row", "trace")


# --- G8, S2, S1, L1, S4 ------------------------------------------------------------------------

CONV_FLAT_SQL = f"""
WITH {SPLIT_SQL}, {trace_sql('sp')}
SELECT {train_prompt_sql('sp.q')} AS user_content, sp.full_sequence AS assistant_content, tr.trace AS reasoning_content
FROM sp JOIN tr ON sp.task_row = tr.task_row"""


def synthesized(spark, d, in_order=False):
    return synth.split_rejects(synth.synthesize_tasks(order_tasks(spark, d, in_order)))[0]


@register("synthesis_rejects", f"""
WITH {generate_sql(params_sql('mixed'))}
SELECT seed, CASE WHEN (2 * fill = total AND depth * 2 <= total) OR (2 * fill < total AND 2 * depth < total - fill)
                  THEN 'attempts_used_up' ELSE 'infeasible' END AS reason
FROM gen WHERE full_sequence IS NULL""")
def q_synthesis_rejects(spark, d):
    """The tasks that no attempt solves, with the reason."""
    tasks = mixed_params(spark, d).select("seed", F.col("fill").alias("f"), F.col("depth").alias("dp"))
    made = synth.synthesize_tasks(tasks, K.MAIN_N_TYPES, K.MAIN_TOTAL_LENGTH, "f", "dp")
    return synth.split_rejects(made)[1]


@register("task_stack_states", f"""
WITH {SPLIT_SQL},
p AS (SELECT task_row, q, unnest(range(0, length(q))) AS pos FROM sp)
SELECT task_row, pos::BIGINT AS pos, {stack_after_sql('left(q, pos + 1)')} AS stack FROM p""")
def q_task_stack_states(spark, d):
    """B5 as text, over the prefixes of generated tasks."""
    s = B.stack_texts(main_split(spark, d), "task_row", "question_sequence")
    return s.select(F.col("seq_id").alias("task_row"), "pos", "stack")


def flatten_pair(conv_col):
    c = F.col(conv_col)
    return [c[0]["content"].alias("user_content"), c[1]["content"].alias("assistant_content"),
            c[1]["reasoning_content"].alias("reasoning_content")]


@register("synthetic_conversations", CONV_FLAT_SQL)
def q_synthetic_conversations(spark, d):
    """The generation job, written as JSONL (S2) and read back."""
    path = scratch_path(spark, "synthetic-conversations")
    write_conversations(synthesized(spark, d), path, compression="gzip", file_lines=FILE_LINES)
    back = read_conversations(spark, path)
    return back.select(*flatten_pair("conversation"))


FOLDED_SQL = """
WITH a AS (SELECT conv_id, turn, role, text,
                  CASE WHEN role = 'assistant' THEN coalesce(lag(text) OVER (PARTITION BY conv_id, role = 'assistant'
                       ORDER BY turn), '') ELSE '' END AS reasoning
           FROM conversations)"""


@register("conversation_jsonl_sink", FOLDED_SQL + """
SELECT string_agg(role, ',' ORDER BY turn) AS roles, md5(string_agg(text, chr(1) ORDER BY turn)) AS content_md5,
       md5(string_agg(reasoning, chr(1) ORDER BY turn)) AS reasoning_md5
FROM a GROUP BY conv_id""")
def q_conversation_jsonl_sink(spark, d):
    """Folded conversations written as JSONL; the raw lines parsed back."""
    path = scratch_path(spark, "conversations-jsonl")
    write_conversations(fold_turns(table(spark, d, "conversations"), reasoning="previous_assistant"), path)
    conv, _, _ = parse_conversation(F.col("_messages"))
    c = spark.read.text(path).withColumn("_messages", messages_of(F.col("value"))).select(conv.alias("c"))
    return c.select(
        F.array_join(F.transform("c", lambda m: m["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("c", lambda m: m["content"]), "\x01")).alias("content_md5"),
        F.md5(F.array_join(F.transform("c", lambda m: m["reasoning_content"]), "\x01")).alias("reasoning_md5"))


@register("conversation_jsonl_scan", FOLDED_SQL + """,
l AS (SELECT conv_id,
             max_by(text, turn) FILTER (WHERE role = 'user') AS "user",
             max_by(text, turn) FILTER (WHERE role = 'assistant') AS assistant,
             max_by(reasoning, turn) FILTER (WHERE role = 'assistant') AS reasoning
      FROM a GROUP BY conv_id)
SELECT "user", assistant, reasoning, false AS malformed FROM l""")
def q_conversation_jsonl_scan(spark, d):
    """JSONL read with strip / blank skip / malformed flag, then P1."""
    path = scratch_path(spark, "conversations-jsonl")
    write_conversations(fold_turns(table(spark, d, "conversations"), reasoning="previous_assistant"), path)
    back = read_conversations(spark, path).withColumn("conv_id", F.monotonically_increasing_id())
    return chat.last_messages(back).select("user", "assistant", "reasoning", "malformed")


# One bad line for each conversation, of one of four kinds by its id.
def bad_lines(lines, id_col):
    kind = F.pmod(F.col(id_col), F.lit(4))
    value = (F.when(kind == 0, F.concat("value", F.lit(" trailing")))
             .when(kind == 1, F.translate("value", '"', "'"))
             .when(kind == 2, F.lit('{"role": "user", "content": "no array"}'))
             .otherwise(F.lit("not json")))
    return lines.select(value.alias("value"))


def jsonl_with_bad_lines(spark, d):
    """Path of a JSONL file: every conversation, a bad line for each, blank lines."""
    path = scratch_path(spark, "conversations-jsonl")
    folded = fold_turns(table(spark, d, "conversations"), reasoning="previous_assistant")
    good = folded.select("conv_id", conversation_json(F.col("conversation")).alias("value"))
    blank = good.select(F.lit("   ").alias("value"))
    good.select("value").union(bad_lines(good, "conv_id")).union(blank).write.text(path)
    return path


@register("conversation_jsonl_rejects", """
WITH l AS (SELECT conv_id, bool_or(role = 'user') AS u, bool_or(role = 'assistant') AS a
           FROM conversations GROUP BY conv_id)
SELECT 'malformed' AS reason, count(*)::BIGINT AS n FROM l HAVING count(*) > 0
UNION ALL
SELECT CASE WHEN u AND a THEN 'usable' WHEN u THEN 'missing_assistant' ELSE 'missing_user' END AS reason,
       count(*)::BIGINT AS n FROM l GROUP BY 1""")
def q_conversation_jsonl_rejects(spark, d):
    """S1 + P2 over a file with malformed lines: rows for each reason."""
    back = read_conversations(spark, jsonl_with_bad_lines(spark, d), numbered=True)
    c = chat.reject_reason(chat.last_messages(back, "line_no"))
    return c.groupBy(F.coalesce("reason", F.lit("usable")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# One line for each conversation whose last assistant message is of one of four kinds by the id.
def typed_lines(rows, id_col):
    kind = F.pmod(F.col(id_col), F.lit(4))
    last = (F.when(kind == 0, F.lit('"content":5')).when(kind == 1, F.lit('"content":"first","content":["b"]'))
            .when(kind == 2, F.lit('"content":7,"content":"last"')).otherwise(F.lit('"content":null')))
    return rows.select(F.concat(F.lit('[{"role":"user","content":{"not":"needed"}},{"role":"user","content":"u"},'
                                      '{"role":"assistant",'), last, F.lit("}]")).alias("value"))


@register("conversation_type_rejects", """
WITH l AS (SELECT DISTINCT conv_id FROM conversations)
SELECT CASE conv_id % 4 WHEN 2 THEN 'usable' WHEN 3 THEN 'null_text' ELSE 'wrong_type' END AS reason,
       CASE conv_id % 4 WHEN 2 THEN 'last' END AS assistant, min(CASE conv_id % 4 WHEN 0 THEN
         '0: content is OBJECT; 2: content is BIGINT' WHEN 1 THEN '0: content is OBJECT; 2: content is ARRAY'
         ELSE '0: content is OBJECT' END) AS errors, count(*)::BIGINT AS n
FROM l GROUP BY conv_id % 4""")
def q_conversation_type_rejects(spark, d):
    """S1 + P2 over lines whose texts are numbers, lists, objects or null, or whose
    keys repeat: the reason of each kind, and the text that is used."""
    path = scratch_path(spark, "conversations-jsonl")
    typed_lines(table(spark, d, "conversations").select("conv_id").distinct(), "conv_id").write.text(path)
    c = chat.reject_reason(chat.last_messages(read_conversations(spark, path, numbered=True), "line_no"))
    return c.groupBy(F.coalesce("reason", F.lit("usable")).alias("reason"), "assistant",
                     F.array_join("errors", "; ").alias("errors")).agg(F.count(F.lit(1)).alias("n"))


def first_letter_tokenizer(token_pattern=TOKEN_PATTERN):
    """A caller's tokenizer for the query below (a closure, so it ships by
    value): the covering tokens, each with the code point of its first
    character + 10 as its id."""
    def encode(texts):
        import regex
        pattern = regex.compile(token_pattern)
        return [([ord(m[0][0]) + 10 for m in found], [m.start() for m in found])
                for found in ([*pattern.finditer(t)] for t in texts)]

    return encode


@register("sft_examples_from_jsonl", f"""
WITH t AS (SELECT {TPL.sql_full('u', 'assistant_text')} AS full_text, {TPL.sql_user('u')} AS user_text
           FROM ({COMPOSED_SQL})),
k AS (SELECT *, list_slice(regexp_extract_all(full_text, {TOKEN_SQL}), 1, {K.MAX_LENGTH_TRAIN}) AS toks FROM t),
n AS (SELECT md5(full_text) AS text_md5, [unicode(x) + 10 FOR x IN toks] AS ids,
             least(len(regexp_extract_all(user_text, {TOKEN_SQL})), len(toks)) AS st FROM k)
SELECT text_md5, len(ids)::INTEGER AS n_tokens, st::INTEGER AS n_user, array_to_string(ids, ',') AS ids_text,
       array_to_string(list_concat([{K.IGNORE_INDEX} FOR x IN range(0, st)], list_slice(ids, st + 1, len(ids))), ',')
         AS labels_text
FROM n""")
def q_sft_examples_from_jsonl(spark, d):
    """One job from a JSONL file to examples with the caller's tokenizer (S1,
    P1-P4, T9); malformed lines and unusable conversations fall away."""
    back = read_conversations(spark, jsonl_with_bad_lines(spark, d), numbered=True)
    texts, _ = chat.prepare_texts(back, "line_no")
    texts = texts.withColumn("text_md5", F.md5("full_text"))
    e = X.build_examples(texts, first_letter_tokenizer(), K.MAX_LENGTH_TRAIN,
                         id_col="line_no", keep=("text_md5",))
    real = lambda c: F.array_join(F.slice(c, 1, F.col("n_tokens")).cast("array<string>"), ",")
    return e.select("text_md5", "n_tokens", "n_user", real("input_ids").alias("ids_text"),
                    real("labels").alias("labels_text"))


@register("line_cap", f"""
WITH {SPLIT_SQL},
l AS (SELECT row_number() OVER (ORDER BY task_row) - 1 AS line_no, full_sequence FROM sp)
SELECT line_no::BIGINT AS line_no, line_no < {K.AUDIT_MAX_LINES} AS in_sample, full_sequence FROM l""")
def q_line_cap(spark, d):
    """L1: every physical line of the generated JSONL, written in the order of
    the tasks, numbered, and whether the audit's cap would read it."""
    path = scratch_path(spark, "synthetic-conversations")
    write_conversations(synthesized(spark, d, in_order=True), path, compression="gzip")
    lines = cap_lines(read_lines(spark, path))
    conv, _, _ = parse_conversation(F.col("_messages"))
    lines = lines.withColumn("_messages", messages_of(py_strip(F.col("value"))))
    return lines.select("line_no", in_sample().alias("in_sample"), conv[1]["content"].alias("full_sequence"))


@register("line_cap_head", f"""
WITH {SPLIT_SQL},
l AS (SELECT row_number() OVER (ORDER BY task_row) - 1 AS line_no, full_sequence FROM sp)
SELECT line_no::BIGINT AS line_no, full_sequence FROM l WHERE line_no < {K.AUDIT_MAX_LINES}""")
def q_line_cap_head(spark, d):
    """L1 with the audit's cap: only the files that hold the first lines are read."""
    path = scratch_path(spark, "synthetic-conversations")
    write_conversations(synthesized(spark, d, in_order=True), path, compression="gzip")
    lines = read_conversations(spark, path, max_lines=K.AUDIT_MAX_LINES)
    return lines.select("line_no", F.col("conversation")[1]["content"].alias("full_sequence"))


def task_lines(spark, d):
    """Path of task records as JSON lines, with a metadata key of the caller's
    own, and a bad line for each third task."""
    path = scratch_path(spark, "task-records")
    tasks = synth.render_train_prompt(main_split(spark, d)).withColumn(
        "metadata_json", F.to_json(F.struct("metadata.*", F.col("task_row").alias("custom"))))
    bad = F.when(F.pmod("task_row", F.lit(3)) == 0, F.lit("not json")).when(
        F.pmod("task_row", F.lit(3)) == 1, F.lit("[1,2]")).otherwise(F.lit('{"question":"q"} trailing'))
    # both lines of a task in one pass, so that tasks are made once
    lines = tasks.select(each(F.array(task_json(tasks), bad)).alias("value"))
    lines.write.option("maxRecordsPerFile", FILE_LINES).text(path, compression="gzip")
    return path


@register("task_record_codec", f"""
WITH {SPLIT_SQL}
SELECT {train_prompt_sql('q')} AS question, c AS answer, 1 AS difficulty, '' AS gpt_response,
       seed, {_uuid_sql('seed')} AS trace_id, q AS question_sequence, total AS total_length,
       CAST(task_row AS VARCHAR) AS custom
FROM sp""")
def q_task_record_codec(spark, d):
    """Task records written as JSON lines and read back with defaults."""
    t = read_tasks(spark, task_lines(spark, d)).filter(~F.col("malformed"))
    return t.select("question", "answer", "difficulty", "gpt_response", F.col("metadata.seed").alias("seed"),
                    F.col("metadata.trace_id").alias("trace_id"),
                    F.col("metadata.question_sequence").alias("question_sequence"),
                    F.col("metadata.total_length").alias("total_length"),
                    F.get_json_object("metadata_json", "$.custom").alias("custom"))


@register("task_record_rejects", f"""
WITH {SPLIT_SQL}
SELECT CASE task_row % 3 WHEN 0 THEN 'not json' WHEN 1 THEN '[1,2]' ELSE '{{"question":"q"}} trailing' END AS value,
       count(*)::BIGINT AS n
FROM sp GROUP BY 1""")
def q_task_record_rejects(spark, d):
    """The lines that are no task record, counted by their text."""
    t = read_tasks(spark, task_lines(spark, d)).filter("malformed")
    return t.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# A record for each task with one wrongly typed or repeated field, by its row number.
TYPED_FIELDS = ['"difficulty":"hard"', '"difficulty":2.5', '"metadata":{"seed":"abc","n_types":2}',
                '"difficulty":1,"difficulty":3', '"answer":["a"],"metadata":7']
TYPED_REASONS = ["difficulty is STRING", "difficulty is DECIMAL", "metadata.seed is STRING", None,
                 "answer is ARRAY; metadata is BIGINT"]


@register("task_record_reasons", f"""
WITH {SPLIT_SQL}
SELECT CASE task_row % 5 {' '.join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(TYPED_REASONS) if r)} END AS reason,
       CASE task_row % 5 WHEN 2 THEN 1 WHEN 3 THEN 3 WHEN 4 THEN 1 END AS difficulty, count(*)::BIGINT AS n
FROM sp GROUP BY task_row % 5""")
def q_task_record_reasons(spark, d):
    """Records whose fields are of another type than the table's, by reason."""
    path = scratch_path(spark, "task-records")
    kind = F.pmod("task_row", F.lit(len(TYPED_FIELDS)))
    fields = F.element_at(F.array(*map(F.lit, TYPED_FIELDS)), (kind + 1).cast("int"))
    main_split(spark, d).select(F.concat(F.lit('{"question":"q",'), fields, F.lit("}")).alias("value")).write.text(path)
    return read_tasks(spark, path).groupBy("reason", "difficulty").agg(F.count(F.lit(1)).alias("n"))
