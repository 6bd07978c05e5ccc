"""Operator 5, near-duplicates by ProbMinHash.

Each text is a set of shingles of five words, all of weight 1 however often
they occur, as links are defined on sets. Every shingle sends arrivals of a
Poisson process of its weight's rate to random registers; a register keeps the
shingle that arrives first, and a shingle stops as soon as its next arrival is
later than every register's. Two texts agree in a register with the probability
Jaccard similarity, which at equal weights is the Jaccard similarity of the
sets. Registers form bands; texts that share a band are candidates, and a
candidate pair is a link if the Jaccard similarity of the exact shingle sets is
at least ``THRESHOLD``. :func:`band_rows` takes the widest bands that such a
pair shares with probability ``RECALL`` (at 0.8: 25 bands of 5, 0.99995).

Classes are connected components. Equal texts are one node from the start. In
each bucket the nodes are held against one hub, which joins groups of copies
without all their pairs; in later rounds the hub is a random node of the
bucket's largest component, and only nodes outside of it are held against it.
Pairs of a bucket whose nodes are then still in different components are tried
too, so no link between classes that share a bucket is lost; inside a component
no pair is needed. Buckets of up to ``SMALL`` nodes try all their pairs. Larger
ones hold a node to the differences between its set and the set of one node for
all buckets that hang together (:func:`far_links`): two sets are near exactly if
their differences share enough, so pairs come from a join on the rarest of the
differences, and a group of near copies gives pairs as it has links, not as the
square of its size.

Before its sets are fetched, a pair must agree in :func:`min_agree` registers,
of which a few bits each are compared inside the join. A pair at the threshold
has fewer with probability ``1 - RECALL`` at most, one above it more rarely.

Defined results: a very long text is worked on whole, by the task that holds it;
texts without words (null, empty, white space) are alike to
nothing, each is a class of its own; fewer than five words make one shingle;
repeated rows share a class; rows without doc_id get the class of their text;
a class in which no row has a doc_id gets a negative number of its own from its
least text, as do all but one of the classes whose least doc_id is the same (a
doc_id on different texts): a text without words keeps the doc_id, else the
class of the least text; an empty table gives no rows; other columns are
dropped or carried unchanged.
"""

from __future__ import annotations

from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftforge.llm.common import WHITE, held, release, slim, stage, text_or_empty
from sftforge.llm.components import components
from sftforge.llm.wordhash import Words, chunks, mix, shingles

SHINGLE = 5
THRESHOLD = 0.8
REGISTERS = 125
#: A pair at the threshold shares a band, and agrees in enough registers, with this probability each.
RECALL = 0.9999
#: Rounds with hubs before the remaining pairs are tried.
HUB_ROUNDS = 1
#: Nodes of a bucket that tries all its remaining pairs.
SMALL = 8
CODE_LONGS = 8
HAS_WORD = f"[^{WHITE}]"
#: Bounds are compared with this much to spare, far below the step from one whole number to the next.
EPS = 1e-6


def band_rows(threshold: float) -> int:
    """The most registers a band may have so that a pair at the threshold
    shares one with probability ``RECALL``; one at least."""
    fits = [r for r in range(1, 26) if 1 - (1 - threshold ** r) ** (REGISTERS // r) >= RECALL]
    return max(fits, default=1)


def min_agree(threshold: float) -> int:
    """The registers whose last four bits must agree: a pair at the threshold
    has fewer with probability 1 - ``RECALL`` at most. Registers agree
    independently with the similarity, and one in 16 of the others by chance."""
    p, below, least = threshold + (1 - threshold) / 16, 0.0, 0
    while least < REGISTERS:
        below += comb(REGISTERS, least) * p ** least * (1 - p) ** (REGISTERS - least)
        if below > 1 - RECALL:
            break
        least += 1
    return least


def shingle_sets(w: Words, width: int = SHINGLE):
    """(shingle, document) of the distinct shingles of each document."""
    shingle, doc = shingles(w, width)
    key = mix(shingle + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(key, return_index=True)
    return shingle[at], doc[at]


def prob_minhash(shingle: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """n_docs x m registers, each the shingle of the first arrival."""
    first = np.full(n_docs * m, np.inf)
    kept = np.zeros(n_docs * m, np.uint64)
    time, turn = np.zeros(len(shingle)), 0
    while len(shingle):
        turn += 1
        draw = mix(shingle + np.uint64(turn * 0xA0761D6478BD642F % (1 << 64)))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        alive = time < first.reshape(n_docs, m).max(axis=1)[doc]
        shingle, doc, weight, time, draw = (x[alive] for x in (shingle, doc, weight, time, draw))
        at = doc * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        kept[at[won]] = shingle[won]
    return kept.reshape(n_docs, m)


SKETCH = "struct<bands: array<long>, code: array<long>, n: int>"


def _sketch_of(texts, rows: int = band_rows(THRESHOLD)):
    """Arrow struct of each text: keys of its bands of ``rows`` registers, four
    bits of each register, and the number of different shingles; null without words."""
    import pyarrow as pa
    n_bands = REGISTERS // rows
    bands = np.zeros((len(texts), n_bands), np.int64)
    code = np.zeros((len(texts), CODE_LONGS), np.int64)
    size = np.zeros(len(texts), np.int32)
    salt = np.arange(n_bands, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    shift = (np.arange(16) * 4).astype(np.uint64)
    for at, n, w in chunks(texts):
        shingle, doc = shingle_sets(w)
        kept = prob_minhash(shingle, doc, np.ones(len(shingle)), n, REGISTERS)
        key = np.broadcast_to(salt, (n, n_bands)).copy()
        for j in range(rows):
            key = mix(key + kept[:, :n_bands * rows].reshape(n, n_bands, rows)[:, :, j])
        bands[at:at + n] = key.view(np.int64)
        bits = np.zeros((n, CODE_LONGS * 16), np.uint64)
        bits[:, :REGISTERS] = mix(kept) & np.uint64(15)
        code[at:at + n] = (bits.reshape(n, CODE_LONGS, 16) << shift).sum(axis=2, dtype=np.uint64).view(np.int64)
        size[at:at + n] = np.bincount(doc, minlength=n)
    none = pa.array(size == 0)

    def lists(rows):
        edge = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
        return pa.ListArray.from_arrays(pa.array(edge), pa.array(rows.ravel()))

    return pa.StructArray.from_arrays([lists(bands), lists(code), pa.array(size)], ["bands", "code", "n"], mask=none)


def agreement(x, y):
    """Number of registers whose four bits agree, of two arrays of code longs."""
    total = F.lit(-(CODE_LONGS * 16 - REGISTERS))  # the unused ones always agree
    for i in range(CODE_LONGS):
        z = x[i].bitwiseXOR(y[i])
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        total = total + 16 - F.bit_count(z.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _sets_of(texts):
    """Arrow binary: the sorted 64-bit shingle hashes of each text."""
    import pyarrow as pa
    out = []
    for _, n, w in chunks(texts):
        shingle, doc = shingle_sets(w)
        order = np.lexsort((shingle, doc))
        shingle, edge = shingle[order], np.searchsorted(doc[order], np.arange(n + 1))
        out += [shingle[edge[i]:edge[i + 1]].tobytes() for i in range(n)]
    return pa.array(out, pa.binary())


def sketch(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node (the text's digest), bands, code and n of every row."""
    text, width = text_or_empty(docs["text"]), band_rows(threshold)

    @F.arrow_udf(SKETCH)
    def sketch_of(texts):
        return _sketch_of(texts, width)

    rows = docs.select(docs["doc_id"], F.md5(text).alias("node"), sketch_of(text).alias("s"))
    return rows.select("doc_id", "node", "s.*")


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(len(x) + len(y) - both, 1)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b), those whose exact sets are similar enough."""
    @F.arrow_udf("boolean")
    def similar(x, y):
        import pyarrow as pa
        return pa.array([jaccard(a, b) >= threshold for a, b in zip(x.to_pylist(), y.to_pylist())], pa.bool_())

    x = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    return pairs.join(x, "a").join(y, "b").filter(similar("x", "y")).select("a", "b")


def likely(x: str, y: str, threshold: float):
    """Join condition on two bucket rows: sizes and registers allow a link."""
    small, large = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    return (small >= threshold * large) & (agreement(F.col(f"{x}.code"), F.col(f"{y}.code")) >= min_agree(threshold))


def _difference(x, y):
    """Arrow lists: the symmetric difference of two sets of shingles."""
    import pyarrow as pa
    parts = [np.setxor1d(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), assume_unique=True)
             for a, b in zip(x.to_pylist(), y.to_pylist())]
    edge = np.cumsum([0] + [len(p) for p in parts])
    return pa.LargeListArray.from_arrays(pa.array(edge), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))).cast(
        pa.list_(pa.int64()))


def far_links(buckets: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join all nodes of ``buckets`` (band, node, comp) which
    are near each other, where comp is not the same already.

    Buckets that share nodes form a family; its least node is the pivot. Let D(x)
    be the symmetric difference of the sets of x and the pivot, so that x and y
    differ in D(x) xor D(y). They are near iff that has at most
    r * (|x| + |y|) elements, r = (1 - t) / (1 + t), that is iff D(x) and D(y)
    share at least o = (|D(x)| + |D(y)| - r * (|x| + |y|)) / 2. One test a node
    tells who is near the pivot. A pair that is still open has one node, x, that
    is not; for it o is above 0, so of the differences in order of rarity the
    first |D(x)| - o + 1 and |D(y)| - o + 1 share one, and the join on these finds
    every pair. What edited copies lost of a common text is shared by many but
    comes after what each has gained, which is rare."""
    ratio = (1 - threshold) / (1 + threshold)
    first = buckets.groupBy("band").agg(F.min("node").alias("a"))
    family = components(buckets.select("band", F.col("node").alias("b")).join(first, "band").select("a", "b"))
    nodes = family.select("node", F.col("comp").alias("pivot")).join(
        buckets.groupBy("node").agg(F.first("comp").alias("comp")), "node")
    with_sets = nodes.join(sets.select("node", F.col("set").alias("x")), "node").join(
        sets.select(F.col("node").alias("pivot"), F.col("set").alias("y")), "pivot")
    n = (F.octet_length("x") / 8).cast("long")
    n_pivot = (F.octet_length("y") / 8).cast("long")
    apart = stage(with_sets.select(
        "pivot", "node", "comp", n.alias("n"), n_pivot.alias("n_pivot"),
        F.arrow_udf(_difference, "array<long>")("x", "y").alias("other")).withColumn("d", F.size("other")).withColumn(
        "far", F.col("d") > ratio * (F.col("n") + F.col("n_pivot")) + EPS), "op5-apart")
    near_pivot = apart.filter("not far and node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    # only families with a far node have open pairs; their least far difference bounds what the others need
    least = apart.filter("far").groupBy("pivot").agg(F.min("d").alias("least"))
    each = apart.join(least, "pivot").select("pivot", "node", "comp", "n", "d", "far", "least",
                                             F.explode("other").alias("shingle"))
    often = each.groupBy("pivot", "shingle").agg(F.count("*").alias("often"))
    rare = Window.partitionBy("pivot", "node").orderBy("often", "shingle")
    most = F.col("n") * (1 - threshold) / threshold  # r * (|x| + |y|) for the longest y that can be near
    needed = F.when(F.col("far"), F.least(most, F.col("d"))).otherwise((F.col("d") - F.col("least") + most) / 2)
    each = (each.join(often, ["pivot", "shingle"]).withColumn("place", F.row_number().over(rare) - 1)
            .filter(F.col("place") <= needed + EPS))
    each = stage(each.select("pivot", "shingle", "node", "comp", "n", "d", "far", "place"), "op5-rare")
    limit = ratio * (F.col("x.n") + F.col("y.n")) + EPS
    more = F.col("x.d") - F.col("y.d")
    x, y = each.filter("far").alias("x"), each.alias("y")
    pairs = x.join(y, (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.shingle") == F.col("y.shingle"))
                   & (F.col("x.comp") != F.col("y.comp")) & (~F.col("y.far") | (F.col("x.node") < F.col("y.node")))
                   & (F.col("x.place") <= (limit + more) / 2) & (F.col("y.place") <= (limit - more) / 2))
    pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    links = stage(near_pivot.union(verified(pairs, sets, threshold)), "op5-links", compact=True)
    release(apart, each, family)
    return links


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, node, class_id, comp of every row: the least doc_id among all
    rows whose texts are linked with the row's own (or, if there is none or it
    names another class, :func:`own_id`), and the least node of these texts,
    which tells classes apart whatever their ids; null without words."""
    docs = slim(docs, "doc_id", "text")
    rows = stage(sketch(docs, threshold), "op5-sketch")
    nodes = stage(rows.filter("bands is not null").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("bands", "code", "n")]), "op5-nodes")
    keys = nodes.select("node", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.count("*").alias("m")).filter("m > 1").select("band")
    buckets = stage(keys.join(shared, "band").join(nodes.select("node", "code", "n"), "node"), "op5-buckets")
    wanted = stage(buckets.select("node").distinct(), "op5-wanted", compact=True)
    # one row a node before the shuffle, so copies of a text do not meet in a task
    texts = (docs.groupBy(F.md5(text_or_empty(F.col("text"))).alias("node")).agg(F.first("text").alias("text"))
             .join(wanted, "node"))
    sets = stage(texts.select("node", F.arrow_udf(_sets_of, "binary")("text").alias("set")), "op5-sets")
    release(wanted)
    tried = labels = None

    def pairs_of(left: DataFrame, right: DataFrame, more) -> DataFrame:
        """(a, b), a < b, of likely pairs of ``left`` and ``right`` in a band, not tried yet."""
        joined = left.alias("x").join(right.alias("y"), (F.col("x.band") == F.col("y.band")) & more
                                      & likely("x", "y", threshold))
        pairs = joined.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        pairs = pairs.distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        return stage(pairs, "op5-pairs", compact=True)

    def linked(links: DataFrame) -> None:
        """Take new links into the components."""
        nonlocal labels
        if links.limit(1).count():
            before, labels = labels, components(links, labels)
            release(before)
        release(links)

    for turn in range(HUB_ROUNDS + 1):
        now = buckets.withColumn("comp", F.col("node"))
        if labels is not None:
            now = buckets.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        now = stage(now, "op5-now", compact=True)
        parts = now.groupBy("band", "comp").agg(
            F.count("*").alias("m"), F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "code", "n")).alias("hub"))
        hubs = parts.groupBy("band").agg(F.max(F.struct("m", F.xxhash64("comp", F.lit(turn)), "comp", "hub")).alias("top"),
                                         F.count("*").alias("parts"), F.sum("m").alias("size"))
        hubs = stage(hubs.filter("parts > 1").select("band", "size", "top.comp", "top.hub.*"), "op5-hubs", compact=True)
        if turn < HUB_ROUNDS:
            # nodes outside of their bucket's largest component
            rest = now.join(hubs.select("band", F.col("comp").alias("major")), "band").filter("comp != major")
            pairs = pairs_of(rest, hubs, F.lit(True))
        else:
            small = now.join(hubs.filter(F.col("size") <= SMALL).select("band"), "band")
            pairs = pairs_of(small, small, (F.col("x.comp") != F.col("y.comp")) & (F.col("x.node") < F.col("y.node")))
        linked(stage(verified(pairs, sets, threshold), "op5-links", compact=True))
        if turn == HUB_ROUNDS:
            large = now.join(hubs.filter(F.col("size") > SMALL).select("band"), "band").select("band", "node", "comp")
            large = stage(large, "op5-large", compact=True)
            if large.limit(1).count():
                linked(far_links(large, sets, threshold))
            release(large)
        tried = pairs if tried is None else tried.union(pairs)
        release(now, hubs)
    if labels is None:
        labels = nodes.select("node", F.col("node").alias("comp")).limit(0)

    named = (nodes.select("node", "first_id").join(labels, "node", "left")
             .select("node", "first_id", F.coalesce("comp", "node").alias("comp")))
    named = stage(named, "op5-named")
    # who may be called by a doc_id: the row without words that has it, else the least component of that least doc_id
    least = named.groupBy("comp").agg(F.min("first_id").alias("class_id")).filter("class_id is not null")
    asked = least.select("class_id", "comp").union(
        rows.filter("n is null and doc_id is not null").select("doc_id", F.lit("")))
    owners = asked.groupBy("class_id").agg(F.min("comp").alias("comp"))
    named = named.join(owners, "comp", "left").select(
        "node", "comp", F.coalesce("class_id", own_id(F.col("comp"))).alias("class_id"))
    return (rows.select("doc_id", "node", F.col("n").isNull().alias("empty")).join(named, "node", "left")
            .select("doc_id", "node", F.when(F.col("empty"), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"), "comp"))


def own_id(comp) -> Column:
    """A negative number of 63 bits of the component's digest."""
    return F.xxhash64(comp).bitwiseOR(F.lit(-1 << 63))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each component (that of the least doc_id, rows without one
    last, then of the least node), and every row whose text has no words, with
    their own columns."""
    found = stage(classes(docs, threshold), "op5-classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("first")
    keep = (found.filter("comp is not null").groupBy("comp").agg(first)
            .select(F.col("first.node").alias("_node"), F.col("first.doc_id").alias("_id")))
    text = F.col("row.text")
    rows = held(docs).withColumn("some", text_or_empty(text).rlike(HAS_WORD))
    kept = (rows.filter("some").withColumn("_node", F.md5(text_or_empty(text))).join(keep, "_node")
            .filter(F.col("row.doc_id").eqNullSafe(F.col("_id"))).dropDuplicates(["_node"]))
    return kept.select("row.*").union(rows.filter("not some").select("row.*"))
