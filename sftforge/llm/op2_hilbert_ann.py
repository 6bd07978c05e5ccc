"""Operator 2, approximate nearest neighbours on shifted Hilbert curves.

Each of ``CURVES`` orderings projects the vectors to ``DIMS`` random orthogonal
directions, spreads every coordinate evenly over a grid, shifts the grid, and
orders the vectors along the grid's Hilbert curve. Spark range-partitions and
sorts every ordering, which gives each vector its rank; ranks cut a curve into
blocks of ``BLOCK`` to ``MAX_BLOCK`` vectors. A query meets the blocks within its key window
(``WINDOW_SHARE`` of the ordering, ``WINDOW_ROWS`` vectors at least, around its
rank); a block's candidates are reranked by the exact inner product in double
precision, and the best of all windows are merged.

Equal vectors are one point with its smallest ids, so a vector that a third of
all rows share is one candidate, and ranks part near-equal vectors evenly.
Groups that meet in a task are one block and at most ``QUERY_CHUNK`` queries.
On vectors without any structure, as in tests, only wide windows find most
neighbours; on clustered ones a smaller ``window_share`` does.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows without id; rows
that repeat an id with an equal vector count once, and of different vectors of
one id that with the least digest stands for it; ties go to the smaller id;
with fewer than ``k`` candidates all are returned; other columns are dropped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftforge.llm.common import shuffle_width, stage

K = 20
CURVES, DIMS, BITS = 8, 4, 12
WINDOW_SHARE = 0.2
WINDOW_ROWS = 2048
#: Vectors of a block: half a window, within these bounds, so that a query meets
#: few blocks and a task holds a bounded one.
BLOCK, MAX_BLOCK = 1024, 8192
QUERY_CHUNK = 4096
#: Queries of a fast product, and pairs that are scored again at once.
STEP, CELLS = 256, 1 << 14
SEED = 77


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of grid cells (``bits`` bits a
    coordinate): the cell's coordinates are turned into the curve's frame level
    by level, and their bits interleaved in Gray-code order."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> level & 1
    return key


class Curves:
    """The orderings: directions and shifts from a seed, centre and spread of
    the projections from all vectors."""

    def __init__(self, size: int, curves: int = CURVES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.curves, self.dims = curves, min(DIMS, size)
        self.directions = np.hstack([np.linalg.qr(rng.normal(size=(size, self.dims)))[0] for _ in range(curves)])
        self.shift = rng.uniform(size=curves * self.dims)
        self.centre, self.spread = np.zeros(curves * self.dims), np.ones(curves * self.dims)

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.directions

    def keys(self, x: np.ndarray) -> np.ndarray:
        """A key for each vector and curve."""
        even = 1 / (1 + np.exp(-1.702 * (self.project(x) - self.centre) / self.spread))  # near the normal distribution
        cells = np.minimum((even + self.shift) / 2 * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
        return np.stack([hilbert_keys(c, BITS) for c in np.split(cells, self.curves, axis=1)], axis=1)


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def best_of(x: np.ndarray, y: np.ndarray, low: np.ndarray, keep: int):
    """(row of x, row of y, score) of the ``keep`` best rows of ``y`` for each of
    ``x``, by score, then by smaller ``low``. Fast products, of any order of
    summing, choose: whoever is within their rounding bound of the keep-th best
    is scored again, always in one order of summing, so ties are ties."""
    rough = x @ y.T
    m = min(keep, len(y))
    edge = -np.partition(-rough, m - 1, axis=1)[:, m - 1]
    longest = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1).max())
    slack = 4 * (x.shape[1] + 2) * np.finfo(np.float64).eps * longest
    row, at = np.nonzero(rough >= (edge - slack)[:, None])
    score = np.concatenate([np.zeros(0), *((x[row[i:i + CELLS]] * y[at[i:i + CELLS]]).sum(axis=1)
                                           for i in range(0, len(row), CELLS))])
    order = np.lexsort((low[at], -score, row))
    row, at, score = row[order], at[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    kept = place < keep
    return row[kept], at[kept], score[kept]


def points(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           keep: int = K + 1) -> tuple[DataFrame, DataFrame, int]:
    """(rows, points, length): rows have id and key, points have key, point, vector and the
    ``keep`` smallest ids of each different vector."""
    rows = vectors.select(vectors[vec_id].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.filter(~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0))
    rows = rows.withColumn("size", F.size("vector"))
    sizes = rows.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    size = sizes[0]["size"] if sizes else 1
    rows = rows.filter(F.col("size") == size).drop("size").withColumn(
        "key", F.md5(F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string")))))
    # one vector an id: of different ones that of the least key
    rows = rows.groupBy("id").agg(F.min(F.struct("key", "vector")).alias("x")).select("id", "x.key", "x.vector")
    least = Window.partitionBy("key").orderBy("id")
    few = (rows.dropDuplicates(["key", "id"]).withColumn("n", F.row_number().over(least)).filter(F.col("n") <= keep)
           .groupBy("key").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("id")).alias("ids")))
    found = stage(few.withColumn("point", F.monotonically_increasing_id()), "op2-points")
    return rows.select("id", "key"), found, size


def ordered(found: DataFrame, size: int) -> tuple[DataFrame, int]:
    """curve, rank, point, low (smallest id) and vector: every point's rank on every curve."""
    curves = Curves(size)
    spark = found.sparkSession

    def sums(batches):
        import pyarrow as pa
        total = np.zeros((3, curves.curves * curves.dims))
        for b in batches:
            y = curves.project(_matrix(b.column(0)))
            total += np.stack([np.full(y.shape[1], len(y)), y.sum(axis=0), (y * y).sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"j": np.arange(total.shape[1]), "n": total[0], "s": total[1], "q": total[2]})

    stats = {x["j"]: x for x in found.select("vector").mapInArrow(sums, "j long, n double, s double, q double")
             .groupBy("j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()}
    n = int(stats[0]["n"]) if stats else 0
    if n:
        s, q = (np.array([stats[j][c] for j in range(len(stats))]) / n for c in "sq")
        curves.centre, curves.spread = s, np.sqrt(np.maximum(q - s * s, 1e-18))

    def place(batches):
        import pyarrow as pa
        for b in batches:
            m = b.num_rows
            keys = curves.keys(_matrix(b.column(2))) if m else np.zeros((0, curves.curves), np.int64)
            again = pa.array(np.tile(np.arange(m), curves.curves))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(curves.curves), m)), pa.array(keys.T.ravel()),
                 *(c.take(again) for c in b.columns)], names=["curve", "key", "point", "low", "vector"])

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            curve = b.column(0).to_numpy()
            local = np.zeros(len(curve), np.int64)
            for c in np.unique(curve):
                here = curve == c
                local[here] = seen.get(c, 0) + np.arange(here.sum())
                seen[c] = seen.get(c, 0) + int(here.sum())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(curve), part)), pa.array(local)],
                names=["curve", "key", "point", "low", "vector", "part", "local"])

    kinds = "curve long, key long, point long, low long, vector array<double>"
    lines = found.select("point", F.col("ids")[0].alias("low"), "vector").mapInArrow(place, kinds)
    lines = (lines.repartitionByRange(shuffle_width(spark), "curve", "key", "point")
             .sortWithinPartitions("curve", "key", "point").mapInArrow(number, kinds + ", part long, local long"))
    lines = stage(lines, "op2-lines")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (lines.groupBy("curve", "part").agg(F.count("*").alias("n"))  # a row for each curve and partition
            .select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    out = lines.join(base, ["curve", "part"]).select(
        "curve", (F.col("base") + F.col("local")).alias("rank"), "point", "low", "vector")
    return out, n


def nearest_points(lines: DataFrame, n: int, asked: DataFrame, keep: int = K + 1,
                   window_share: float = WINDOW_SHARE) -> DataFrame:
    """query, point, score: the best ``keep`` points within the key windows of
    each point of ``asked`` (itself among them)."""
    width = min(n, max(WINDOW_ROWS, int(window_share * n)))
    n_asked = asked.count()
    size = min(MAX_BLOCK, max(BLOCK, width // 2))
    per_block = n_asked * (width / size + 1) / max(n / size, 1)
    chunks = max(1, int(np.ceil(per_block / QUERY_CHUNK)))
    first = F.least(F.greatest(F.col("rank") - width // 2, F.lit(0)), F.lit(max(n - width, 0)))
    queries = lines.join(asked, "point").withColumn("first", first).select(
        "curve", F.explode(F.sequence(F.floor(F.col("first") / size), F.floor((F.col("first") + width) / size)))
        .alias("block"), F.pmod(F.xxhash64("point"), F.lit(chunks)).alias("chunk"), "point", "vector")
    blocks = lines.select("curve", F.floor(F.col("rank") / size).alias("block"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
                          "point", "low", "vector")

    def rerank(q, c):
        import pyarrow as pa
        kinds = pa.schema([("query", pa.int64()), ("point", pa.int64()), ("low", pa.int64()), ("score", pa.float64())])
        if not q.num_rows or not c.num_rows:
            return kinds.empty_table()
        x, y = _matrix(q["vector"]), _matrix(c["vector"])
        ids, point, low = (t.to_numpy() for t in (q["point"], c["point"], c["low"]))
        out = [best_of(x[at:at + STEP], y, low, keep) for at in range(0, len(x), STEP)]
        row, at, score = (np.concatenate(parts) for parts in zip(
            *[(r + i * STEP, a, s) for i, (r, a, s) in enumerate(out)]))
        return pa.table([ids[row], point[at], low[at], score], schema=kinds)

    group = ["curve", "block", "chunk"]
    queries, blocks = (x.toDF(*x.columns) for x in (queries, blocks))  # no column is of both
    met = queries.groupBy(*group).cogroup(blocks.groupBy(*group)).applyInArrow(
        rerank, "query long, point long, low long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "low")
    return (met.groupBy("query", "point").agg(F.min("low").alias("low"), F.max("score").alias("score"))
            .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= keep).select("query", "point", "score"))


def search(vectors: DataFrame, is_query, k: int = K, window_share: float = WINDOW_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose
    id satisfies ``is_query`` (a function of the id column)."""
    rows, found, size = points(vectors, keep=k + 1)
    asked_rows = rows.filter(is_query(F.col("id"))).distinct().join(found.select("key", "point"), "key")
    asked_rows = stage(asked_rows.select(F.col("id").alias("query_id"), "point"), "op2-queries")
    lines, n = ordered(found, size)
    near = nearest_points(lines, n, asked_rows.select("point").distinct(), k + 1, window_share)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ids = (near.join(found.select("point", F.explode("ids").alias("vec_id")), "point")
           .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
           .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asked_rows.join(ids, asked_rows["point"] == ids["query"])
            .select("query_id", F.posexplode(others).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", "x.score"))
