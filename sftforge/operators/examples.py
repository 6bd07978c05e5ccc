"""SFT examples: T5 label mask, T6 answer anchor, T7 weights, T8 padding,
T9 the full job, T10 audit.

Arrays are built with codegen'd array built-ins (``slice``, ``concat``,
``array_repeat``, ``array_remove``) rather than per-element lambdas; a lambda
runs only on rows that contain the pad id (never with the built-in
vocabulary, where pad is reserved).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.functions.text import token_count
from sftforge.operators.tokens import PAD_ID, UNK_ID, encode, encode_with

IGN = K.IGNORE_INDEX


def answer_anchor_char(full_text: Column, user_text: Column, mode: str = "answer") -> Column:
    """0-based character position of ``"FINAL ANSWER: "`` (null if absent).

    ``first``: first occurrence anywhere -- the training prompt itself contains
    the marker, so this lands in the user part and every labelled token gets
    the answer weight (what the reference actually does). ``answer``: first
    occurrence inside the assistant part (the stated intent)."""
    if mode == "first":
        p = F.locate(K.ANSWER_MARKER, full_text)
    elif mode == "answer":
        p = _locate_from(full_text, user_text)
    else:
        raise ValueError(f"unknown anchor mode {mode!r}")
    return F.when(p > 0, p - 1)


def _locate_from(full_text: Column, user_text: Column) -> Column:
    """1-based position of the marker at or after the end of the user part (0 if absent)."""
    rest = F.substring(full_text, F.length(user_text) + 1, F.length(full_text))
    p = F.locate(K.ANSWER_MARKER, rest)
    return F.when(p > 0, p + F.length(user_text)).otherwise(F.lit(0))


def label_mask(ids: Column, start: Column, pad_id: int = PAD_ID) -> Column:
    """T5: -100 before the assistant start, else the id (-100 where id = pad)."""
    n = F.size(ids)
    fast = F.concat(F.array_repeat(F.lit(IGN), start), F.slice(ids, start + 1, F.greatest(n - start, F.lit(0))))
    slow = F.transform(ids, lambda x, i: F.when((i < start) | (x == pad_id), F.lit(IGN)).otherwise(x))
    return F.when(F.array_contains(ids, pad_id), slow).otherwise(fast).cast("array<int>")


def label_weights(labels: Column, anchor: Column, answer_weight: float = K.ANSWER_LOSS_WEIGHT) -> Column:
    """``answer_weight`` at labelled tokens from the anchor on, 1.0 on the
    other real tokens (user tokens included); padding is added by T8."""
    n = F.size(labels)
    a = F.least(F.coalesce(anchor, n), n)
    fast = F.concat(F.array_repeat(F.lit(1.0), a), F.array_repeat(F.lit(float(answer_weight)), n - a))
    slow = F.transform(labels, lambda x, i: F.when(anchor.isNotNull() & (x != IGN) & (i >= anchor),
                                                   F.lit(float(answer_weight))).otherwise(F.lit(1.0)))
    # The fast form differs only where a label at or after the anchor is -100 (a pad id).
    needs_slow = anchor.isNotNull() & F.array_contains(F.slice(labels, a + 1, F.greatest(n - a, F.lit(0))), IGN)
    return F.when(needs_slow, slow).otherwise(fast).cast("array<float>")


def pad(df: DataFrame, max_length: int = K.MAX_LENGTH_TRAIN, pad_id: int = PAD_ID) -> DataFrame:
    """Right-pad ids (pad), labels (-100), weights (0.0) to ``max_length``;
    attention mask 1s then 0s."""
    df = df.withColumn("_n", F.size("input_ids"))
    n = F.col("_n")
    rest = F.greatest(F.lit(max_length) - n, F.lit(0))
    return (df.withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), rest)).cast("array<int>"))
              .withColumn("labels", F.concat("labels", F.array_repeat(F.lit(IGN), rest)).cast("array<int>"))
              .withColumn("label_weights", F.concat("label_weights", F.array_repeat(F.lit(0.0), rest))
                          .cast("array<float>"))
              .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), rest))
                          .cast("array<int>"))
              .drop("_n"))


def anchors(texts: DataFrame, max_length: int = K.MAX_LENGTH_TRAIN, modes: tuple = ("answer",)) -> DataFrame:
    """T6 on token counts alone, no ids needed: adds ``n_user`` and, for each
    mode, ``anchor_<mode>`` (null: no marker, or cut away)."""
    full, user = F.col("full_text"), F.col("user_text")
    n = F.least(token_count(full), F.lit(max_length))
    out = texts.withColumn("n_user", F.least(token_count(user), n).cast("int"))
    for mode in modes:
        c = answer_anchor_char(full, user, mode)
        at = F.greatest(F.col("n_user"), token_count(F.substring(full, 1, c)))
        out = out.withColumn(f"anchor_{mode}", F.when(c.isNotNull() & (at < n), at).cast("int"))
    return out


def build_examples(texts: DataFrame, vocab: DataFrame | Callable, max_length: int = K.MAX_LENGTH_TRAIN,
                   answer_weight: float = K.ANSWER_LOSS_WEIGHT, anchor: str = "answer",
                   id_col: str = "conv_id", pad_id: int = PAD_ID, unk_id: int = UNK_ID,
                   keep: tuple = ()) -> DataFrame:
    """Texts (``full_text``, ``user_text`` from P4) -> one row per example
    with ``input_ids``, ``labels``, ``attention_mask``, ``label_weights`` (all
    ``max_length`` long) plus ``n_tokens``, ``n_user``, ``anchor``.

    ``vocab`` is a vocabulary table (T1) or the caller's tokenizer, a function
    as :func:`sftforge.operators.tokens.encode_with` takes. With a table, the
    user-token count and the anchor are token counts of the texts' heads; with
    a function, they are counted from the tokens' first characters."""
    if callable(vocab):
        c = answer_anchor_char(F.col("full_text"), F.col("user_text"), anchor)
        at = texts.select(id_col, "full_text", *keep, F.length("user_text").alias("_u"), c.alias("_c"))
        enc = encode_with(at, vocab, max_length, "full_text")
        before = lambda col: F.size(F.filter("token_starts", lambda s: s < F.col(col)))
        enc = enc.withColumn("n_user", before("_u").cast("int")).withColumn(
            "_k", F.when(F.col("_c").isNotNull(), before("_c")).cast("int"))
    else:
        a = anchors(texts, max_length, (anchor,))
        pre = a.select(id_col, "full_text", *keep, "n_user", F.col(f"anchor_{anchor}").alias("_k"))
        enc = encode(pre, vocab, max_length, id_col=id_col, text_col="full_text", unk_id=unk_id,
                     carry=["n_user", "_k", *keep])
    n = F.size("input_ids")
    start = F.least(F.col("n_user"), n)
    anc = F.greatest(start, F.col("_k"))
    ex = (enc.withColumn("n_tokens", n.cast("int"))
             .withColumn("anchor", F.when(F.col("_k").isNotNull() & (anc < n), anc).cast("int"))
             .withColumn("labels", label_mask(F.col("input_ids"), start, pad_id)))
    ex = ex.withColumn("label_weights", label_weights(F.col("labels"), F.col("anchor"), answer_weight))
    ex = pad(ex, max_length, pad_id)
    return ex.select(id_col, *keep, "n_user", "n_tokens", "anchor", "input_ids", "labels", "attention_mask",
                     "label_weights")


def audit_examples(ex: DataFrame) -> DataFrame:
    """Checks over all rows: rows, total tokens, trainable labels,
    ignored labels (real tokens with label -100), rows without trainable
    labels, rows missing ids or labels."""
    real = F.size(F.array_remove("attention_mask", 0))
    n_train = F.size(F.array_remove("labels", IGN))
    return ex.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(real).cast("bigint").alias("tokens"),
        F.sum(n_train).cast("bigint").alias("trainable"),
        F.sum(real - n_train).cast("bigint").alias("ignored"),
        F.count_if(n_train == 0).cast("bigint").alias("rows_without_labels"),
        F.count_if(F.col("input_ids").isNull() | F.col("labels").isNull()).cast("bigint").alias("rows_missing"))
