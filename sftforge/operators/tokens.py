"""Tokens: T1 vocabulary, T2 encode, T3 offsets, T4 head truncation.

Tokens are the matches of the covering pattern ``functions.text.TOKEN_PATTERN``
(chat markers, whitespace runs, letter runs, digit runs, any other code
point). They cover the text, so offsets are prefix sums of token lengths, and
the number of tokens *starting* before character ``c`` equals the token count
of the first ``c`` characters whenever ``c`` starts a letter/marker-free
boundary (used by the answer anchor).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.functions.text import DEFAULT_TEMPLATE, ChatTemplate, each, tokens

PAD_ID, UNK_ID = 0, 1
#: Tokens of one count are ranked in groups by so many leading characters.
RANK_PREFIX = 3


def build_vocabulary(df: DataFrame, size: int | None = None, text_col: str = "text",
                     template: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Corpus -> (token, id). Reserved ids: pad 0, unk 1, then the
    template's markers, then every token (or the ``size`` most frequent) by
    (count desc, token asc).

    Counting is a partial aggregation. A token's rank is the sum of what stands
    before it at four levels, each counted from the one below: doublings of the
    count (64 at most, the only window over a whole table), counts of one
    doubling, leading characters of one count, tokens of those. So no task orders
    a table that grows with the vocabulary. Store the result and pass it on when
    several jobs encode with it."""
    markers = template.markers
    toks = df.select(each(tokens(F.col(text_col))).alias("token")).filter("token is not null")
    if markers:
        toks = toks.filter(~F.col("token").isin(*markers))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    if size is not None:
        counts = counts.orderBy(F.desc("cnt"), F.asc("token")).limit(size)
    levels = [["doubling"], ["doubling", "cnt"], ["doubling", "cnt", "lead"]]
    counts = counts.withColumn("lead", F.substring("token", 1, RANK_PREFIX)).withColumn(
        "doubling", F.floor(F.log2("cnt")).cast("int"))
    # what the joins below would infer, said to every branch, so that all reuse one exchange of counts
    counts = counts.filter("lead is not null and doubling is not null")
    sizes = [counts.groupBy(*levels[2]).agg(F.count(F.lit(1)).alias("n"))]
    for level in (levels[1], levels[0]):
        sizes.insert(0, sizes[0].groupBy(*level).agg(F.sum("n").alias("n")))
    base = None
    for level, rows in zip(levels, sizes):
        order = Window.partitionBy(*level[:-1]).orderBy(F.asc("lead") if level[-1] == "lead" else F.desc(level[-1]))
        inside = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rows = rows.select(*level, inside.alias("inside"))
        base = (rows.withColumnRenamed("inside", "base") if base is None else
                rows.join(base, level[:-1]).select(*level, (F.col("base") + F.col("inside")).alias("base")))
    inside = F.row_number().over(Window.partitionBy(*levels[2]).orderBy("token")) - 1
    ranked = (counts.withColumn("inside", inside).join(base, levels[2])
              .select("token", (F.col("base") + F.col("inside") + 2 + len(markers)).cast("int").alias("id")))
    spark = df.sparkSession
    reserved = spark.createDataFrame(
        [("<pad>", PAD_ID), ("<unk>", UNK_ID)] + [(m, 2 + i) for i, m in enumerate(markers)],
        "token string, id int")
    return reserved.unionByName(ranked)


def encode(df: DataFrame, vocab: DataFrame, max_length: int | None = None, id_col: str = "id",
           text_col: str = "text", out: str = "input_ids", unk_id: int = UNK_ID,
           carry: list | tuple = (), blocks: int | None = None) -> DataFrame:
    """Rows -> ``input_ids`` (unknown tokens -> unk), truncated to
    ``max_length`` before the lookup; ``carry`` columns pass through. A null
    text has null ids, an empty one an empty array.

    Dictionary encoding: rows are dealt into ``blocks`` (default: eight for each
    shuffle partition) by a hash of id and text, compact. A block's different
    tokens go to the vocabulary once each (Spark broadcasts it if its size allows,
    else both sides are shuffled) and their ids come back to the block, where an
    Arrow kernel looks all occurrences up at once; occurrences never move. Rows
    are never taken apart and a block depends on contents alone, so ids may
    repeat and a task that runs again finds the same block."""
    kept = [id_col, *carry]
    n = blocks or 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = tokens(F.col("_text"))
    t = F.slice(t, 1, max_length) if max_length is not None else t
    block = F.pmod(F.xxhash64(id_col, text_col), F.lit(n)).cast("int")
    rows = df.select(*kept, F.col(text_col).alias("_text"), block.alias("_block")).repartition("_block")
    rows = rows.select(*kept, "_block", t.alias("_tokens"))
    seen = rows.select("_block", each(F.col("_tokens")).alias("token")).filter("token is not null").distinct()
    known = seen.join(vocab.select("token", F.col("id").cast("int").alias("_vid")), "token").select(
        F.col("_block").alias("_of"), "token", "_vid")
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField(out, T.ArrayType(T.IntegerType()))])

    def look_up(left, right):
        import pyarrow as pa
        import pyarrow.compute as pc
        lists = left["_tokens"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):  # no rows
            lists = pa.array([], lists.type)
        at = pc.index_in(lists.flatten(), value_set=right["token"].combine_chunks())
        ids = pc.fill_null(right["_vid"].combine_chunks().take(at).cast(pa.int32()), unk_id)
        edges = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0))
        edges = pa.concat_arrays([pa.array([0], pa.int32()), edges.cast(pa.int32())])
        found = pa.ListArray.from_arrays(edges, ids, mask=lists.is_null())
        return pa.table([*[left[c] for c in kept], found], names=[*kept, out])

    return (rows.groupBy("_block").cogroup(known.groupBy("_of"))
            .applyInArrow(look_up, schema))


def encode_with(df: DataFrame, fn: Callable, max_length: int | None = None, text_col: str = "text",
                out: str = "input_ids", starts: str = "token_starts") -> DataFrame:
    """T2 with the caller's tokenizer: ``fn`` maps a list of texts to a list of
    (ids, first characters) pairs. Runs on Arrow batches, narrow; all columns
    stay. A null text has null ids. ``fn`` is shipped by value if it is a closure."""
    @F.arrow_udf("struct<ids: array<int>, starts: array<int>>")
    def run(texts):
        import pyarrow as pa
        some = [(i, t) for i, t in enumerate(texts.to_pylist()) if t is not None]
        rows: list = [None] * len(texts)
        for (i, _), (ids, at) in zip(some, fn([t for _, t in some])):
            rows[i] = {"ids": list(ids)[:max_length], "starts": list(at)[:max_length]}
        return pa.array(rows, pa.struct([("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32()))]))

    return (df.withColumn("_e", run(F.col(text_col))).withColumn(out, F.col("_e.ids"))
            .withColumn(starts, F.col("_e.starts")).drop("_e"))


def token_offsets(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, pos, token, start, end) with code-point offsets. Narrow: the
    starts of a row's tokens are running sums inside its own array, taken for all
    arrays of an Arrow batch at once, so rows may repeat an id or have none and
    nothing moves."""
    @F.arrow_udf("array<int>")
    def starts(lengths):
        import pyarrow as pa
        import pyarrow.compute as pc
        values = lengths.flatten()
        ends = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(values.cast(pa.int64()))])
        sizes = pc.fill_null(pc.list_value_length(lengths), 0).cast(pa.int64())
        edges = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes)])
        first = ends.take(edges.slice(0, len(lengths)))  # characters before each row
        row = pc.list_parent_indices(lengths)
        inside = pc.subtract(ends.slice(0, len(values)), first.take(row)).cast(pa.int32())
        return pa.ListArray.from_arrays(edges.cast(pa.int32()), inside, mask=lengths.is_null())

    t = df.select(id_col, tokens(F.col(text_col)).alias("_tokens"))
    t = t.withColumn("_starts", starts(F.transform("_tokens", F.length)))
    x = t.select(id_col, F.posexplode_outer(F.arrays_zip("_tokens", "_starts")).alias("pos", "_t")).filter(
        "pos is not null")  # as functions.text.each
    start = F.col("_t._starts").cast("bigint")
    return x.select(id_col, F.col("pos").cast("bigint").alias("pos"), F.col("_t._tokens").alias("token"),
                    start.alias("start"), (start + F.length("_t._tokens")).cast("bigint").alias("end"))


def truncate(df: DataFrame, max_length: int, tokens_col: str = "tokens",
             answer_token_col: str | None = None) -> DataFrame:
    """T4: keep the first ``max_length`` tokens; ``n_lost`` tokens cut, and
    ``lost_answer`` when the answer's first token falls past the cut (the head
    is kept, so an over-long example loses its answer first)."""
    t = F.col(tokens_col)
    out = (df.withColumn("n_tokens", F.size(t).cast("bigint"))
             .withColumn(tokens_col, F.slice(t, 1, max_length))
             .withColumn("n_lost", F.greatest(F.col("n_tokens") - max_length, F.lit(0)).cast("bigint")))
    if answer_token_col:
        out = out.withColumn("lost_answer", F.col(answer_token_col) >= max_length)
    return out


def truncation_totals(df: DataFrame) -> DataFrame:
    """T4 totals: rows, rows losing tokens, tokens lost, rows losing the answer."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("n_lost") > 0).alias("rows_truncated"),
            F.sum("n_lost").alias("tokens_lost")]
    if "lost_answer" in df.columns:
        aggs.append(F.count_if(F.col("lost_answer")).alias("rows_lost_answer"))
    return df.agg(*aggs)
