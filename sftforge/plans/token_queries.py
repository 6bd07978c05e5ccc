"""Registered queries: tokens (T1-T4), examples (T5-T10), order and batches
(P6-P9).

T1-T3 run over whole documents. T4-T10 and P6-P9 run over the conversations:
last user + last assistant, the assistant's reasoning being the previous
assistant turn, so the answer marker is composed in (the test tables contain
no marker of their own). T4 truncates at 256 tokens because no example
reaches 768.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.hashing import draw_sql
from sftforge.functions.text import DEFAULT_TEMPLATE as TPL
from sftforge.functions.text import sql_str
from sftforge.operators import examples as X
from sftforge.operators import order as O
from sftforge.operators import tokens as TK
from sftforge.operators.layout import spread
from sftforge.plans.chat_queries import COMPOSED_SQL, TOKEN_SQL, usable_texts
from sftforge.plans.registry import register
from sftforge.sources.tables import table

TRUNC_AT = 256
BATCH = 8
MARKERS = TPL.markers
SPLIT_DRAW_SQL = draw_sql("split", str(K.SHUFFLE_SEED), "conv_id")
SPLIT_THRESHOLD = int(round(K.EVAL_FRACTION * (1 << 32)))


def _csv(col):
    return F.array_join(F.col(col).cast("array<string>"), ",")


def vocab_sql(src: str, text: str) -> str:
    reserved = [("<pad>", TK.PAD_ID), ("<unk>", TK.UNK_ID)] + [(m, 2 + i) for i, m in enumerate(MARKERS)]
    res_sql = " UNION ALL ".join(f"SELECT {sql_str(t)} AS token, {i}::INTEGER AS id" for t, i in reserved)
    markers = ", ".join(sql_str(m) for m in MARKERS)
    return f"""(
  WITH vt AS (SELECT unnest(regexp_extract_all({text}, {TOKEN_SQL})) AS token FROM {src}),
  vc AS (SELECT token, count(*) AS cnt FROM vt WHERE token NOT IN ({markers}) GROUP BY token),
  vr AS (SELECT token, row_number() OVER (ORDER BY cnt DESC, token ASC) AS r FROM vc)
  {res_sql} UNION ALL SELECT token, (r - 1 + {2 + len(MARKERS)})::INTEGER AS id FROM vr)"""


# --- T1 / T2 / T3 over documents -------------------------------------------------------------

def doc_vocab(spark, d):
    return TK.build_vocabulary(spread(table(spark, d, "documents").select("text")), text_col="text")


@register("vocabulary_build", f"SELECT token, id FROM {vocab_sql('documents', 'text')}")
def q_vocabulary_build(spark, d):
    return doc_vocab(spark, d)


@register("token_encode", f"""
WITH v AS {vocab_sql('documents', 'text')},
t AS (SELECT doc_id, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS pos
      FROM (SELECT doc_id, regexp_extract_all(text, {TOKEN_SQL}) AS toks FROM documents))
SELECT doc_id, string_agg(CAST(coalesce(v.id, {TK.UNK_ID}) AS VARCHAR), ',' ORDER BY pos) AS ids_text,
       count(*)::BIGINT AS n_tokens
FROM t LEFT JOIN v ON t.token = v.token GROUP BY doc_id
UNION ALL
SELECT doc_id, CASE WHEN text IS NOT NULL THEN '' END AS ids_text, CASE WHEN text IS NOT NULL THEN 0 END::BIGINT AS n_tokens
FROM documents WHERE coalesce(text, '') = ''""")
def q_token_encode(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    e = TK.encode(docs, doc_vocab(spark, d), None, id_col="doc_id", text_col="text")
    n = F.when(F.col("input_ids").isNotNull(), F.size("input_ids")).cast("bigint")
    return e.select("doc_id", _csv("input_ids").alias("ids_text"), n.alias("n_tokens"))


@register("token_offsets", f"""
WITH t AS (SELECT doc_id, unnest(toks) AS token, unnest(range(0, len(toks))) AS pos
           FROM (SELECT doc_id, regexp_extract_all(text, {TOKEN_SQL}) AS toks FROM documents))
SELECT doc_id, pos::BIGINT AS pos, token,
       coalesce(sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
       sum(length(token)) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)::BIGINT AS "end"
FROM t""")
def q_token_offsets(spark, d):
    return TK.token_offsets(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text").select(
        "doc_id", "pos", "token", "start", "end")


# --- conversations -> examples ---------------------------------------------------------------

def conv_texts(spark, d):
    texts, _ = usable_texts(spark, d, reasoning="previous_assistant")
    return texts


def conv_vocab(spark, d):
    return TK.build_vocabulary(conv_texts(spark, d), text_col="full_text")


TEXTS_SQL = f"""
tx AS (SELECT conv_id, {TPL.sql_full('u', 'assistant_text')} AS full_text, {TPL.sql_user('u')} AS user_text
       FROM ({COMPOSED_SQL}))"""


def examples_sql(max_length: int, mode: str = "answer") -> str:
    """CTE text ending in ``ex`` (one row per example, arrays as text) and ``tp``
    (one row per kept token)."""
    if mode == "answer":
        anchor_pos = (f"CASE WHEN strpos(substr(full_text, length(user_text) + 1), {sql_str(K.ANSWER_MARKER)}) > 0 "
                      f"THEN strpos(substr(full_text, length(user_text) + 1), {sql_str(K.ANSWER_MARKER)}) "
                      f"+ length(user_text) END")
    else:
        anchor_pos = (f"CASE WHEN strpos(full_text, {sql_str(K.ANSWER_MARKER)}) > 0 "
                      f"THEN strpos(full_text, {sql_str(K.ANSWER_MARKER)}) END")
    return f"""{TEXTS_SQL},
v AS {vocab_sql('tx', 'full_text')},
m AS (SELECT conv_id, full_text,
             least(len(regexp_extract_all(user_text, {TOKEN_SQL})), {max_length}) AS n_user,
             {anchor_pos} AS p1 FROM tx),
m2 AS (SELECT *, CASE WHEN p1 IS NOT NULL THEN len(regexp_extract_all(substr(full_text, 1, p1 - 1), {TOKEN_SQL})) END AS k
       FROM m),
tk AS (SELECT conv_id, unnest(toks) AS token, unnest(range(0, len(toks))) AS i
       FROM (SELECT conv_id, regexp_extract_all(full_text, {TOKEN_SQL}) AS toks FROM tx)),
tp AS (SELECT tk.conv_id, tk.i, coalesce(v.id, {TK.UNK_ID}) AS id
       FROM tk LEFT JOIN v ON tk.token = v.token WHERE tk.i < {max_length}),
nn AS (SELECT conv_id, count(*) AS n FROM tp GROUP BY conv_id),
h AS (SELECT m2.conv_id, nn.n, least(m2.n_user, nn.n) AS st,
             CASE WHEN m2.k IS NOT NULL AND greatest(least(m2.n_user, nn.n), m2.k) < nn.n
                  THEN greatest(least(m2.n_user, nn.n), m2.k) END AS anchor
      FROM m2 JOIN nn ON m2.conv_id = nn.conv_id),
lab AS (SELECT tp.conv_id, tp.i, tp.id,
               CASE WHEN tp.i < h.st OR tp.id = {TK.PAD_ID} THEN {K.IGNORE_INDEX} ELSE tp.id END AS label,
               h.anchor, h.n, h.st
        FROM tp JOIN h ON tp.conv_id = h.conv_id),
ex AS (SELECT conv_id, any_value(n) AS n, any_value(st) AS st, any_value(anchor) AS anchor,
              string_agg(CAST(id AS VARCHAR), ',' ORDER BY i) || repeat(',{TK.PAD_ID}', {max_length} - any_value(n)) AS ids_text,
              string_agg(CAST(label AS VARCHAR), ',' ORDER BY i) || repeat(',{K.IGNORE_INDEX}', {max_length} - any_value(n)) AS labels_text,
              string_agg(CASE WHEN anchor IS NOT NULL AND i >= anchor AND label <> {K.IGNORE_INDEX}
                              THEN '{int(K.ANSWER_LOSS_WEIGHT)}' ELSE '1' END, ',' ORDER BY i)
                || repeat(',0', {max_length} - any_value(n)) AS weights_text,
              string_agg('1', ',' ORDER BY i) || repeat(',0', {max_length} - any_value(n)) AS mask_text
       FROM lab GROUP BY conv_id)"""


def conv_examples(spark, d, max_length=K.MAX_LENGTH_TRAIN, anchor="answer"):
    return X.build_examples(conv_texts(spark, d), conv_vocab(spark, d), max_length, K.ANSWER_LOSS_WEIGHT,
                            anchor, "conv_id")


def _weights_text(col="label_weights"):
    return F.array_join(F.col(col).cast("array<int>").cast("array<string>"), ",")


@register("truncate_head", f"""
WITH {examples_sql(TRUNC_AT)},
full_n AS (SELECT conv_id, len(regexp_extract_all(full_text, {TOKEN_SQL})) AS n_full, k FROM m2)
SELECT f.conv_id, f.n_full::BIGINT AS n_tokens, greatest(f.n_full - {TRUNC_AT}, 0)::BIGINT AS n_lost,
       coalesce(f.k >= {TRUNC_AT}, false) AS lost_answer
FROM full_n f""")
def q_truncate_head(spark, d):
    from sftforge.operators.examples import answer_anchor_char
    from sftforge.functions.text import token_count, tokens
    t = conv_texts(spark, d)
    c = answer_anchor_char(F.col("full_text"), F.col("user_text"), "answer")
    t = t.select("conv_id", tokens(F.col("full_text")).alias("tokens"),
                 F.when(c.isNotNull(), token_count(F.substring(F.col("full_text"), 1, c))).alias("_k"))
    r = TK.truncate(t, TRUNC_AT, "tokens", "_k")
    return r.select("conv_id", "n_tokens", "n_lost", F.coalesce(F.col("lost_answer"), F.lit(False)).alias("lost_answer"))


@register("label_mask", f"WITH {examples_sql(K.MAX_LENGTH_TRAIN)} SELECT conv_id, st::INTEGER AS n_user, labels_text FROM ex")
def q_label_mask(spark, d):
    e = conv_examples(spark, d)
    return e.select("conv_id", F.least(F.col("n_user"), F.col("n_tokens")).cast("int").alias("n_user"),
                    _csv("labels").alias("labels_text"))


@register("answer_anchor", f"""
WITH a AS (WITH {examples_sql(K.MAX_LENGTH_TRAIN, 'answer')} SELECT conv_id, anchor FROM ex),
     f AS (WITH {examples_sql(K.MAX_LENGTH_TRAIN, 'first')} SELECT conv_id, anchor FROM ex)
SELECT a.conv_id, a.anchor::INTEGER AS anchor_answer, f.anchor::INTEGER AS anchor_first
FROM a JOIN f ON a.conv_id = f.conv_id""")
def q_answer_anchor(spark, d):
    a = X.anchors(conv_texts(spark, d), K.MAX_LENGTH_TRAIN, ("answer", "first"))
    return a.select("conv_id", "anchor_answer", "anchor_first")


@register("label_weights", f"WITH {examples_sql(K.MAX_LENGTH_TRAIN)} SELECT conv_id, weights_text FROM ex")
def q_label_weights(spark, d):
    return conv_examples(spark, d).select("conv_id", _weights_text().alias("weights_text"))


@register("pad_and_mask", f"""
WITH {examples_sql(K.MAX_LENGTH_TRAIN)}
SELECT conv_id, {K.MAX_LENGTH_TRAIN}::INTEGER AS n_ids, n::BIGINT AS attention_sum, mask_text, ids_text FROM ex""")
def q_pad_and_mask(spark, d):
    e = conv_examples(spark, d)
    return e.select("conv_id", F.size("input_ids").cast("int").alias("n_ids"),
                    F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("attention_sum"),
                    _csv("attention_mask").alias("mask_text"), _csv("input_ids").alias("ids_text"))


@register("sft_examples", f"""
WITH {examples_sql(K.MAX_LENGTH_TRAIN)}
SELECT conv_id, ids_text, labels_text, weights_text, mask_text,
       CASE WHEN {SPLIT_DRAW_SQL} < {SPLIT_THRESHOLD} THEN 'eval' ELSE 'train' END AS split
FROM ex""")
def q_sft_examples(spark, d):
    """Both branches of the split in one plan, marked by a ``split`` column."""
    texts = O.split_train_eval(conv_texts(spark, d), "conv_id", exact=False)
    e = X.build_examples(texts, conv_vocab(spark, d), K.MAX_LENGTH_TRAIN, K.ANSWER_LOSS_WEIGHT, "answer",
                         "conv_id", keep=("split",))
    return e.select("conv_id", _csv("input_ids").alias("ids_text"), _csv("labels").alias("labels_text"),
                    _weights_text().alias("weights_text"), _csv("attention_mask").alias("mask_text"), "split")


@register("example_audit", f"""
WITH {examples_sql(K.MAX_LENGTH_TRAIN)},
per AS (SELECT conv_id, n, count(*) FILTER (WHERE label <> {K.IGNORE_INDEX}) AS tr FROM lab GROUP BY conv_id, n)
SELECT count(*)::BIGINT AS "rows", sum(n)::BIGINT AS tokens, sum(tr)::BIGINT AS trainable,
       sum(n - tr)::BIGINT AS ignored, count(*) FILTER (WHERE tr = 0)::BIGINT AS rows_without_labels,
       0::BIGINT AS rows_missing
FROM per""")
def q_example_audit(spark, d):
    return X.audit_examples(conv_examples(spark, d))


# --- P6 / P7 / P8 / P9 -----------------------------------------------------------------------

KEY_SQL = f"md5('{K.SHUFFLE_SEED}:' || CAST(conv_id AS VARCHAR))"


@register("dataset_shuffle", f"""
WITH s AS (SELECT conv_id, {KEY_SQL} AS shuffle_key FROM ({COMPOSED_SQL}))
SELECT conv_id, shuffle_key, (row_number() OVER (ORDER BY shuffle_key, conv_id) - 1)::BIGINT AS position
FROM s""")
def q_dataset_shuffle(spark, d):
    s = O.shuffle_rank(conv_texts(spark, d).select("conv_id"), "conv_id")
    return s.select("conv_id", O.shuffle_key("conv_id").alias("shuffle_key"), "position")


@register("train_eval_split", f"""
WITH s AS (SELECT conv_id, {SPLIT_DRAW_SQL} AS h FROM ({COMPOSED_SQL})),
r AS (SELECT *, row_number() OVER (ORDER BY h, conv_id) AS rk, count(*) OVER () AS n FROM s)
SELECT conv_id,
       CASE WHEN h < {SPLIT_THRESHOLD} THEN 'eval' ELSE 'train' END AS split_hash,
       CASE WHEN rk <= ceil(n * {K.EVAL_FRACTION}) THEN 'eval' ELSE 'train' END AS split_exact
FROM r""")
def q_train_eval_split(spark, d):
    t = O.split_train_eval(conv_texts(spark, d).select("conv_id"), "conv_id", out="split_hash")
    return O.split_train_eval(t, "conv_id", exact=True, out="split_exact")


@register("dataset_map", "SELECT conv_id, turn, length(text)::BIGINT AS n_chars FROM conversations")
def q_dataset_map(spark, d):
    # a user function (defined here so it ships by value to the workers)
    def char_count(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"conv_id": pdf["conv_id"], "turn": pdf["turn"],
                             "n_chars": pdf["text"].str.len().astype("int64")})

    t = table(spark, d, "conversations").select("conv_id", "turn", "text")
    return O.map_examples(t, char_count, "conv_id long, turn long, n_chars long")


@register("batch_collate", f"""
WITH {examples_sql(K.MAX_LENGTH_TRAIN)},
b AS (SELECT ex.conv_id, ex.n, {KEY_SQL.replace('conv_id', 'ex.conv_id')} AS k FROM ex),
r AS (SELECT *, (row_number() OVER (ORDER BY k, conv_id) - 1) AS rk FROM b)
SELECT (rk // {BATCH})::BIGINT AS batch_no, count(*)::INTEGER AS n_examples,
       string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY rk) AS example_ids, sum(n)::BIGINT AS tokens
FROM r GROUP BY rk // {BATCH}""")
def q_batch_collate(spark, d):
    b = O.collate(conv_examples(spark, d), BATCH, "conv_id", ids=conv_texts(spark, d))
    tokens = F.aggregate(F.col("attention_mask"), F.lit(0).cast("bigint"),
                         lambda acc, m: acc + F.aggregate(m, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return b.select("batch_no", F.size("example_ids").cast("int").alias("n_examples"),
                    _csv("example_ids").alias("example_ids"), tokens.alias("tokens"))
