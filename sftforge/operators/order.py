"""Order, split, user functions and batches: P6 shuffle, P7 train/eval split,
P8 map_examples, P9 batch collation.

Every order is a function of (seed, id) hashes, never of partitioning, so
results are the same under any partition count, retry or executor loss.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.functions import constants as K
from sftforge.functions.hashing import draw
from sftforge.operators.layout import hash_rank

def shuffle_key(id_col: str, seed: int = K.SHUFFLE_SEED):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def shuffle(df: DataFrame, id_col: str, seed: int = K.SHUFFLE_SEED) -> DataFrame:
    """Deterministic order given a seed: sorted by md5(seed:id), then id.
    A range-partitioned distributed sort; the key also serves P7 and P9."""
    return df.withColumn("shuffle_key", shuffle_key(id_col, seed)).orderBy("shuffle_key", id_col)


def shuffle_rank(df: DataFrame, id_col: str, seed: int = K.SHUFFLE_SEED, out: str = "position") -> DataFrame:
    """P6 as a column: each row's place in :func:`shuffle`'s order (0-based),
    without sorting the rows."""
    return hash_rank(df, shuffle_key(id_col, seed), id_col, out=out)


def split_train_eval(df: DataFrame, id_col: str, eval_fraction: float = K.EVAL_FRACTION,
                     seed: int = K.SHUFFLE_SEED, exact: bool = False, out: str = "split") -> DataFrame:
    """Add ``out`` in {'train', 'eval'}; disjoint and complete.

    Approximate (default): eval iff a 32-bit hash of (seed, id) falls below
    ``eval_fraction`` -- one pass, no shuffle. Exact: eval = the
    ``ceil(eval_fraction * n)`` smallest hashes (ties by id): ranks inside
    65,536 hash buckets plus a bounded table of bucket totals."""
    h = draw("split", seed, F.col(id_col))
    if not exact:
        thr = int(round(eval_fraction * (1 << 32)))
        return df.withColumn(out, F.when(h < thr, "eval").otherwise("train"))
    hexed = F.lower(F.lpad(F.hex(h), 8, "0"))
    ranked = hash_rank(df, hexed, id_col, out="_rank")
    buckets = df.groupBy(F.substring(hexed, 1, 4)).agg(F.count(F.lit(1)).alias("n"))
    need = buckets.agg(F.ceil(F.sum("n") * F.lit(eval_fraction)).alias("_need"))
    return (ranked.crossJoin(F.broadcast(need))  # one row
            .withColumn(out, F.when(F.col("_rank") < F.col("_need"), "eval").otherwise("train"))
            .drop("_rank", "_need"))


def map_examples(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """Apply a user function ``pandas.DataFrame -> pandas.DataFrame`` per
    Arrow batch (e.g. a subword tokenizer); input columns are dropped unless the
    function returns them. Parallelism = partitions. The function must be
    importable on the workers or defined locally (closures ship by value)."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def map_examples_safely(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """P8 with an error for each row that fails: :func:`map_examples` with two more
    columns, ``error`` (null for good rows) and ``failed_row`` (the input row as
    JSON). A batch on which ``fn`` raises is cut in halves until the failing rows
    stand alone, so the others' results are kept, and one bad row costs the
    logarithm of a batch in further calls. ``fn`` must treat rows on their own."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = schema.names

    def attempt(pdf):
        import pandas as pd
        try:
            yield fn(pdf.copy())[names].assign(error=None, failed_row=None)
        except Exception as e:  # any error of the caller's function is its row's
            if len(pdf) == 1:
                row = pdf.to_json(orient="records", date_format="iso", default_handler=str)[1:-1]
                yield pd.DataFrame([{**dict.fromkeys(names), "error": f"{type(e).__name__}: {e}", "failed_row": row}])
            else:
                half = len(pdf) // 2
                yield from attempt(pdf.iloc[:half])
                yield from attempt(pdf.iloc[half:])

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield from attempt(pdf)

    out = T.StructType([*schema.fields, T.StructField("error", T.StringType()),
                        T.StructField("failed_row", T.StringType())])
    for field in out.fields:
        field.nullable = True
    return df.mapInPandas(run, out)


def batch_numbers(ids: DataFrame, batch_size: int, id_col: str = "conv_id",
                  seed: int = K.SHUFFLE_SEED) -> DataFrame:
    """(id, position, batch_no): places in P6's order, cut into batches of
    ``batch_size``. Only ids are ranked and moved."""
    x = shuffle_rank(ids.select(id_col), id_col, seed)
    return x.withColumn("batch_no", F.floor(F.col("position") / batch_size).cast("bigint"))


def collate(ex: DataFrame, batch_size: int, id_col: str = "conv_id", seed: int = K.SHUFFLE_SEED,
            ids: DataFrame | None = None) -> DataFrame:
    """Group examples into batches of ``batch_size`` in P6's order -> one
    row per batch with stacked arrays; only the last batch may be smaller. Each
    example gets its place on its own row (no join on the id), so rows that
    repeat an id, or have none, are batched each; they are ordered by their
    contents. ``ids`` is a table with the examples' ids (as often as there),
    which saves computing the examples twice, for the counts. Weights are padded
    (0.0) or cut to the batch width (longest ``input_ids``); missing weights
    count as 1.0."""
    contents = F.xxhash64("input_ids", "labels")
    ex = hash_rank(ex, shuffle_key(id_col, seed), id_col, contents, out="_rank",
                   counted=None if ids is None else ids.select(id_col))
    ex = ex.withColumn("batch_no", F.floor(F.col("_rank") / batch_size).cast("bigint"))
    has_w = "label_weights" in ex.columns
    item = F.struct(F.col("_rank"), F.col(id_col).alias("id"), "input_ids", "labels", "attention_mask",
                    (F.col("label_weights") if has_w else F.lit(None).cast("array<float>")).alias("w"))
    g = ex.groupBy("batch_no").agg(F.sort_array(F.collect_list(item)).alias("_items"))
    width = F.aggregate(F.col("_items"), F.lit(0), lambda acc, x: F.greatest(acc, F.size(x["input_ids"])))
    g = g.withColumn("_width", width)

    def fit(x):
        w = F.coalesce(x["w"], F.array_repeat(F.lit(1.0).cast("float"), F.size(x["input_ids"])))
        return F.when(F.size(w) < F.col("_width"),
                      F.concat(w, F.array_repeat(F.lit(0.0).cast("float"), F.col("_width") - F.size(w)))) \
                .otherwise(F.slice(w, 1, F.col("_width")))

    return g.select(
        "batch_no",
        F.transform("_items", lambda x: x["id"]).alias("example_ids"),
        F.transform("_items", lambda x: x["input_ids"]).alias("input_ids"),
        F.transform("_items", lambda x: x["labels"]).alias("labels"),
        F.transform("_items", lambda x: x["attention_mask"]).alias("attention_mask"),
        F.transform("_items", fit).alias("label_weights"))
