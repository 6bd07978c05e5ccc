"""Registered queries: bracket analytics B1-B6 over whole documents.

Input: every document's whole text mapped to brackets by a fixed character
rule (vowels a e i o -> openers, consonants s t n r -> closers, u -> the
foreign bracket ``⟨`` of the inference example), all other characters removed.
That gives long sequences (thousands of brackets) with matches, mismatches,
ignored closers and foreign characters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sftforge.operators import brackets as B
from sftforge.operators.layout import spread
from sftforge.plans.registry import register
from sftforge.sources.tables import table

MAP_FROM = "aeiostnruAEIOSTNRU"
MAP_TO = "([{<)]}>⟨([{<)]}>⟨"
KEEP_CLASS = r"[^()\[\]{}<>⟨]"


def doc_sequences(spark, d):
    # spread: the text mapping is the heavy part; a single-split file would run it on one core
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    seq = F.regexp_replace(F.translate("text", MAP_FROM, MAP_TO), KEEP_CLASS, "")
    return docs.select(F.col("doc_id").alias("seq_id"), seq.alias("seq"))


SEQ_SQL = f"""
src AS (SELECT doc_id AS seq_id,
               regexp_replace(translate(text, '{MAP_FROM}', '{MAP_TO}'), '{KEEP_CLASS}', '', 'g') AS seq
        FROM documents),
b AS (SELECT * FROM src WHERE length(seq) > 0)"""

EXPLODE_SQL = SEQ_SQL + """,
x AS (SELECT seq_id, length(seq)::BIGINT AS n, unnest(range(0, length(seq)))::BIGINT AS pos,
             unnest(string_split(seq, '')) AS ch FROM b),
k AS (SELECT *, CASE WHEN ch IN ('(', '[', '{', '<') THEN 'open'
                     WHEN ch IN (')', ']', '}', '>') THEN 'close' ELSE 'other' END AS kind FROM x)"""

DEPTH_SQL = EXPLODE_SQL + """,
s AS (SELECT *, sum(CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END)
                  OVER (PARTITION BY seq_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS rs FROM k),
m AS (SELECT *, least(0, min(rs) OVER (PARTITION BY seq_id ORDER BY pos ROWS UNBOUNDED PRECEDING)) AS rmin,
                least(0, coalesce(min(rs) OVER (PARTITION BY seq_id ORDER BY pos
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS pmin FROM s),
d AS (SELECT seq_id, n, pos, ch, kind, (rs - rmin)::BIGINT AS depth,
             (kind = 'close' AND rs < pmin) AS ignored FROM m)"""

EVENTS_SQL = DEPTH_SQL + """,
l AS (SELECT *, CASE WHEN kind = 'open' THEN depth WHEN kind = 'close' AND NOT ignored THEN depth + 1 END AS level
      FROM d),
e AS (SELECT seq_id, n, pos, ch, kind, depth, level,
             CASE WHEN kind = 'other' THEN 'other' WHEN ignored THEN 'ignored' WHEN kind = 'open' THEN 'open'
                  WHEN translate(lag(ch) OVER w, '([{<', ')]}>') = ch THEN 'match' ELSE 'mismatch' END AS event,
             (CASE WHEN kind = 'open' THEN lead(pos) OVER w WHEN level IS NOT NULL THEN lag(pos) OVER w END)::BIGINT
               AS partner_pos
      FROM l WINDOW w AS (PARTITION BY seq_id, level ORDER BY pos))"""


@register("bracket_explode", f"WITH {EXPLODE_SQL} SELECT seq_id, pos, ch, kind FROM k")
def q_bracket_explode(spark, d):
    return B.explode_brackets(doc_sequences(spark, d)).select("seq_id", "pos", "ch", "kind")


@register("bracket_depth", f"""
WITH {DEPTH_SQL}
SELECT seq_id, pos, depth, ignored, max(depth) OVER (PARTITION BY seq_id) AS max_depth FROM d""")
def q_bracket_depth(spark, d):
    return B.bracket_depth(doc_sequences(spark, d)).select("seq_id", "pos", "depth", "ignored", "max_depth")


@register("bracket_events", f"WITH {EVENTS_SQL} SELECT seq_id, pos, ch, event, partner_pos FROM e")
def q_bracket_events(spark, d):
    return B.bracket_events(doc_sequences(spark, d)).select("seq_id", "pos", "ch", "event", "partner_pos")


# Relational oracle for the fold.
@register("bracket_completion", f"""
WITH {EVENTS_SQL},
c AS (SELECT seq_id, string_agg(translate(ch, '([{{<', ')]}}>'), '' ORDER BY pos DESC) AS completion
      FROM e WHERE event = 'open' AND partner_pos IS NULL GROUP BY seq_id)
SELECT s.seq_id, CASE WHEN s.seq IS NOT NULL THEN coalesce(c.completion, '') END AS completion,
       s.seq || coalesce(c.completion, '') AS completed
FROM src s LEFT JOIN c ON s.seq_id = c.seq_id""")
def q_bracket_completion(spark, d):
    return B.complete_brackets(doc_sequences(spark, d), method="fold")


@register("bracket_stack_states", f"""
WITH {DEPTH_SQL}
SELECT seq_id, pos, depth,
       last_value(CASE WHEN kind = 'open' THEN translate(ch, '([{{<', ')]}}>') END IGNORE NULLS) OVER w AS top,
       last_value(CASE WHEN kind = 'open' THEN pos END IGNORE NULLS) OVER w AS parent_pos
FROM d WINDOW w AS (PARTITION BY seq_id, depth ORDER BY pos ROWS UNBOUNDED PRECEDING)""")
def q_bracket_stack_states(spark, d):
    return B.stack_states(doc_sequences(spark, d))


VALIDITY_MIN_DEPTH = 3


@register("bracket_validity", f"""
WITH {EVENTS_SQL},
f AS (SELECT *, CASE WHEN event IN ('mismatch', 'ignored', 'other') THEN event
                     WHEN event = 'open' AND partner_pos IS NULL THEN 'unclosed' END AS fault FROM e)
SELECT seq_id, length(seq)::BIGINT AS length, CASE WHEN seq IS NOT NULL THEN 0 END::BIGINT AS max_depth,
       CASE WHEN seq IS NOT NULL THEN true END AS balanced, NULL::BIGINT AS fault_pos, NULL AS fault,
       CASE WHEN seq IS NOT NULL THEN 0 END >= {VALIDITY_MIN_DEPTH} AS depth_ok
FROM src WHERE coalesce(length(seq), 0) = 0
UNION ALL
SELECT seq_id, max(n)::BIGINT AS length, max(depth)::BIGINT AS max_depth,
       count(fault) = 0 AS balanced,
       min(pos) FILTER (WHERE fault IS NOT NULL)::BIGINT AS fault_pos,
       arg_min(fault, pos) FILTER (WHERE fault IS NOT NULL) AS fault,
       max(depth) >= {VALIDITY_MIN_DEPTH} AS depth_ok
FROM f GROUP BY seq_id""")
def q_bracket_validity(spark, d):
    v = B.check_brackets(doc_sequences(spark, d), min_depth=VALIDITY_MIN_DEPTH)
    return v.select("seq_id", "length", "max_depth", "balanced", "fault_pos", "fault", "depth_ok")
