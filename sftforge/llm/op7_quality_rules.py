"""Operator 7, quality rules: a short-circuit cascade.

Every rule looks at one text and may reject it. The cost of a rule (seconds a
document) and its selectivity (share of documents that it rejects) are
estimated on a bounded sample; the rules then run in the order of rejections
per cost, and a document's first rejection ends its cascade. The order changes
the time only, never a verdict: a document is kept if no rule rejects it.

Defined results: a very long text is worked on whole, by the task that holds it;
a null text counts as empty; an empty text has no words and
fails ``min_words`` or ``no_words``; other columns may be null; repeated rows get equal
verdicts; an empty table gives an empty result and the rules' own order. Input
columns named like an output column are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import bounded_batches, slim, without
from sftforge.llm.textstats import TextView

#: Bound of the sample on which costs and selectivities are estimated, and its seed.
SAMPLE_ROWS = 200
SAMPLE_CHARS = 50_000
SAMPLE_SEED = 7


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextView], bool]


#: The base rules, whose limits the query's contract fixes.
BASE_RULES = (
    Rule("min_words", lambda t: t.n_words < 50),
    Rule("repeat_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: Limits published for web-text filters: symbols to words, repeated lines and
#: their share of the characters, bullets, ellipses, length of words, words
#: without letters, capitals, exclamation marks, braces, broken characters.
SHAPE_RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("exclaims", lambda t: 10 * t.n_exclaims > 3 * t.n_words),
    Rule("braces", lambda t: 10 * t.n_braces > t.n_words),
    Rule("garbled", lambda t: 100 * t.n_garbled > t.word_chars),
    Rule("capitals", lambda t: 2 * t.n_upper > t.n_letters),
    Rule("dup_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("dup_line_chars", lambda t: 2 * t.dup_line_chars > sum(map(len, t.lines))),
    Rule("bullets", lambda t: len(t.lines) > 2 and 10 * t.n_bullet_lines > 9 * len(t.lines)),
    Rule("ellipses", lambda t: 10 * t.n_ellipsis_lines > 3 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
    Rule("lettered_words", lambda t: 2 * t.n_lettered_words < t.n_words),
)
RULES = BASE_RULES + SHAPE_RULES
#: Of a corpus that is packed afterwards, shortness alone rejects no document
#: but one without words: short clean texts stay, and short junk has its shape.
CORPUS_RULES = (Rule("no_words", lambda t: not t.n_words),) + BASE_RULES[1:] + SHAPE_RULES


def estimate(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Rule name -> (seconds a document, share rejected), measured on at most
    ``sample_rows`` documents of at most ``SAMPLE_CHARS`` characters, drawn from
    the whole table: each row with one chance, of those drawn the first in a
    random order. One narrow scan; what reaches the driver is bounded."""
    bounded_batches(docs.sparkSession)
    text = docs["text"]
    n = docs.count()  # of Parquet, from the files' footers
    drawn = docs.select(text).sample(min(1.0, 2 * sample_rows / max(n, 1)), SAMPLE_SEED)
    rows = (drawn.filter(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS)
            .orderBy(F.rand(SAMPLE_SEED)).limit(sample_rows).collect())
    out = {}
    for rule in rules:
        began = time.perf_counter()
        rejected = sum(rule.rejects(TextView(x[0])) for x in rows)  # views of its own: no rule pays for another
        out[rule.name] = ((time.perf_counter() - began) / max(len(rows), 1), rejected / max(len(rows), 1))
    return out


def cascade_order(rules, measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first; ties and unmeasured rules in the given order."""
    gain = {n: r / max(s, 1e-9) for n, (s, r) in measured.items()}
    return sorted(rules, key=lambda x: -gain.get(x.name, 0.0))


def verdict(rules):
    """Column function text -> name of the rule that rejects it first, or null."""
    rules = list(rules)

    @F.arrow_udf("string")
    def first_rejection(texts):
        import pyarrow as pa
        out = []
        for text in texts.to_pylist():
            view = TextView(text)
            out.append(next((x.name for x in rules if x.rejects(view)), None))
        return pa.array(out, pa.string())

    return first_rejection


def apply_rules(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``rejected_by`` (null: kept). Which of several rejecting
    rules is named depends on the estimated order; whether one is does not."""
    order = cascade_order(rules, estimate(docs, rules, sample_rows))
    docs = without(docs, ["rejected_by"])
    return docs.withColumn("rejected_by", verdict(order)(docs["text"]))


def keep_good(docs: DataFrame, rules=CORPUS_RULES) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    order = cascade_order(rules, estimate(docs, rules))
    return docs.filter(verdict(order)(docs["text"]).isNull())


def measure_and_judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, the statistics of every text in full, ``base_failed`` and ``kept``.

    The statistics are asked for of every document; beyond them the cascade
    stops a document at its first rejection and reuses what is known of it."""
    base = {x.name for x in BASE_RULES}
    order = cascade_order([x for x in rules if x.name not in base], estimate(docs, rules))

    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, base_failed boolean, kept boolean")

    def judge(batches):
        import pyarrow as pa
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for text in b.column(1).to_pylist():
                t = TextView(text)
                failed = any(x.rejects(t) for x in BASE_RULES)
                row = (t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed,
                       not failed and not any(x.rejects(t) for x in order))
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64())] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept"])

    return slim(docs, "doc_id", "text").mapInArrow(judge, schema)
