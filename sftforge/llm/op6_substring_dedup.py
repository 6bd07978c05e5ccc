"""Operator 6, substring removal with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words of one document. A window whose word
sequence starts at another place of the corpus too is repeated, and every word
under a repeated window goes; spans of repeated windows are maximal.

The reference is the corpus itself, which no broadcast may carry, so it is cut
into shards that Spark deals out, and each document's passages go to the shards
that can hold their repeats:

1. Every window has one anchor, its least run of ``ANCHOR`` words by hash (the
   leftmost of equals), so equal windows have equal anchors. Counting anchors
   (one of about ten words is one) tells which occur at one place only; their
   windows cannot repeat.
2. Around the other anchors a passage is cut: the windows of that anchor. Equal
   passages are combined before the shuffle. All passages of an anchor meet in
   one shard, whose suffix automaton is built; then they are streamed through
   it for their matching statistics: where the match is as long as a window and
   the automaton has two places for it, the window is repeated.
3. An anchor with more than ``SHARD_PASSAGES`` different passages is not
   gathered: each of its windows is a passage of its own, and counting equal
   ones answers exactly, with partial sums.

Equal texts are one node throughout (its places count once, and a text that two
rows hold is repeated as a whole), so groups of copies do not grow any of this.
For a reference of bounded size, :func:`remove_reference_spans` broadcasts the
automata of its shards and streams all documents past them.

Defined results: a very long text is worked on whole, by the task that holds it;
a null text has no words; texts shorter than a window lose
nothing; repeated rows are copies of each other; an empty table gives no rows;
other columns are dropped or carried unchanged.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.automaton import SuffixAutomaton
from sftforge.llm.common import held, release, slim, stage, text_or_empty, words
from sftforge.llm.wordhash import Words, chunks, mix, windows

WINDOW = 35
ANCHOR = 16
#: Different passages of one anchor that may meet in a shard, and a shard's passages.
SHARD_PASSAGES = 1000
#: Rows that a task holds before it hands them on.
OUT_ROWS = 5000
SHARD_SIZE = 1000
#: Words of a reference that may be broadcast, and of one broadcast automaton.
MAX_REFERENCE_WORDS = 2_000_000
REFERENCE_SHARD_WORDS = 100_000


def anchors(w: Words, width: int = WINDOW, k: int = ANCHOR):
    """(document, anchor hash, word, first window, last window) of the anchors
    of a chunk; positions count from the document's first word."""
    n = len(w.hash)
    if n < width:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64)) + (np.zeros(0, np.int64),) * 3
    grams = windows(w.hash, k, salt=11)[:n - k + 1]
    span = width - k + 1
    least, at = mix(grams), np.arange(len(grams))  # by a second hash, so that none is favoured
    done = 1
    while done < span:  # leftmost least of growing ranges
        step = min(done, span - done)
        right = least[step:] < least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.where(right, least[step:], least[:-step])
        done += step
    start = np.arange(len(at))
    whole = w.doc[start] == w.doc[start + width - 1]
    start, at = start[whole], at[whole]
    if not len(start):
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64)) + (np.zeros(0, np.int64),) * 3
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
    last = np.r_[new[1:], len(start)] - 1
    doc, at = w.doc[start[new]], at[new]
    zero = w.first[doc]
    return doc, grams[at], at - zero, start[new] - zero, start[last] - zero


def _anchor_rows(batches):
    """(node, text) -> node, anchor, first, last."""
    import pyarrow as pa
    for b in batches:
        for at, _, w in chunks(b.column(1)):
            doc, key, _, first, last = anchors(w)
            if len(doc):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc + at)), pa.array(key.view(np.int64)),
                     pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    names=["node", "anchor", "first", "last"])


def _passage_rows(batches):
    """(node, text, list of (anchor, first, last window)) -> node, first and
    last word, anchor, digest, passage."""
    kinds = "binary", "int32", "int32", "int64", "binary", "string"
    names = ["node", "first", "last", "anchor", "digest", "passage"]
    rows = []
    for b in batches:
        for node, text, spots in zip(*b.columns):
            node, w = node.as_py(), words(text.as_py())
            for x in spots.as_py():
                passage = b" ".join(w[x["first"]:x["last"] + WINDOW])
                rows.append((node, x["first"], x["last"] + WINDOW - 1, x["anchor"],
                             hashlib.md5(passage).digest(), passage.decode()))
            if len(rows) >= OUT_ROWS:
                yield _batch(rows, names, kinds)
                rows = []
    if rows:
        yield _batch(rows, names, kinds)


def _window_rows(batches):
    """(node, first, passage) -> node, first, digest: each window as a passage of its own."""
    kinds, names = ("binary", "int32", "binary"), ["node", "first", "digest"]
    rows = []
    for b in batches:
        for node, first, passage in zip(*(c.to_pylist() for c in b.columns)):
            w = words(passage)
            rows += [(node, first + i, hashlib.md5(b" ".join(w[i:i + WINDOW])).digest())
                     for i in range(len(w) - WINDOW + 1)]
            if len(rows) >= OUT_ROWS:
                yield _batch(rows, names, kinds)
                rows = []
    if rows:
        yield _batch(rows, names, kinds)


def _batch(rows, names, kinds):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _shard_spans(batches):
    """Sorted (anchor, passage, node, first, several) -> node, first, last of
    maximal runs of repeated windows of passages that occur once."""
    import pyarrow as pa

    def spans(shard):
        auto = SuffixAutomaton()
        for passage, node, first, several in shard:
            w = words(passage)
            auto.add(w, [(node, first + i) for i in range(len(w))])
            if several:  # another place that no row of the shard shows
                auto.add(w, [(b"", first + i) for i in range(len(w))])
        auto.close()
        nodes, firsts, lasts = [], [], []
        for passage, node, first, several in shard:
            if several:
                continue
            open_at = before = None
            for i in auto.repeated_windows(words(passage), WINDOW):
                if before is not None and i != before + 1:
                    nodes.append(node), firsts.append(open_at), lasts.append(first + before)
                    open_at = None
                open_at = first + i - WINDOW + 1 if open_at is None else open_at
                before = i
            if before is not None:
                nodes.append(node), firsts.append(open_at), lasts.append(first + before)
        return pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.binary()),
                                           "first": pa.array(firsts, pa.int32()),
                                           "last": pa.array(lasts, pa.int32())})

    shard, anchor = [], None
    for b in batches:
        for key, *row in zip(*(c.to_pylist() for c in b.columns)):
            if key != anchor and len(shard) >= SHARD_SIZE:
                yield spans(shard)
                shard = []
            anchor = key
            shard.append(row)
    if shard:
        yield spans(shard)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """node, first, last (words, both inclusive) of the spans of repeated
    windows of each different text; spans may overlap."""
    texts = docs.select(node_of(docs["text"]).alias("node"), text_or_empty(docs["text"]).alias("text"))
    spots = stage(texts.mapInArrow(_anchor_rows, "node binary, anchor long, first int, last int"), "op6-anchors")
    place = F.xxhash64("node", "first")
    often = spots.groupBy("anchor").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo != hi")
    # a set, as copies of a text repeat its anchors; bounded by the text
    listed = spots.join(often.select("anchor"), "anchor").groupBy("node").agg(
        F.collect_set(F.struct("anchor", "first", "last")).alias("spots"))
    once = texts.groupBy("node").agg(F.first("text").alias("text")).join(listed, "node")
    cut = stage(once.select("node", "text", "spots").mapInArrow(
        _passage_rows, "node binary, first int, last int, anchor long, digest binary, passage string"), "op6-passages")
    release(spots)

    # Equal passages, counted by digest; node and first show one place of each.
    kinds = stage(cut.groupBy("anchor", "digest").agg(
        F.min(F.struct("node", "first")).alias("one"), F.count("*").alias("n")), "op6-kinds")
    known = kinds.filter("n > 1").select("anchor", "digest")
    equal = cut.select("node", "first", "last", "anchor", "digest").join(known, ["anchor", "digest"]).select(
        "node", "first", "last")

    per_anchor = stage(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "op6-counts",
                       compact=True)
    # only these passages' words move: one of each kind, where kinds differ
    ones = (kinds.join(per_anchor.filter(F.col("kinds") <= SHARD_PASSAGES).select("anchor"), "anchor")
            .select("anchor", "one.node", "one.first", (F.col("n") > 1).alias("several")))
    few = ones.join(cut.select("anchor", "node", "first", "passage"), ["anchor", "node", "first"]).select(
        "anchor", "passage", "node", "first", "several")
    matched = (few.repartition("anchor").sortWithinPartitions("anchor")
               .mapInArrow(_shard_spans, "node binary, first int, last int"))

    many = per_anchor.filter(F.col("kinds") > SHARD_PASSAGES).select("anchor")
    single = stage(cut.join(many, "anchor").select("node", "first", "passage").mapInArrow(
        _window_rows, "node binary, first int, digest binary"), "op6-windows")
    twice = (single.groupBy("digest").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
             .filter("lo != hi").select("digest"))
    counted = single.join(twice, "digest").select("node", "first", (F.col("first") + WINDOW - 1).alias("last"))
    return equal.union(matched).union(counted)


def node_of(text):
    """A text's digest, 16 bytes."""
    return F.unhex(F.md5(text_or_empty(text)))


def marked(rows: DataFrame, text) -> DataFrame:
    """``rows`` with ``copied`` (another row has the same ``text``) and ``spans``
    (of repeated windows; null if none)."""
    node = node_of(text)
    spans = (repeated_spans(rows.select(text.alias("text"))).groupBy("node")
             .agg(F.collect_set(F.struct("first", "last")).alias("spans")))  # bounded by the text
    copied = rows.select(node.alias("node")).groupBy("node").agg((F.count("*") > 1).alias("copied"))
    facts = stage(copied.join(spans, "node", "left").filter("copied or spans is not null"), "op6-facts")
    return rows.withColumn("node", node).join(facts, "node", "left").withColumn(
        "copied", F.coalesce("copied", F.lit(False)))


def kept_words(text: str | None, copied: bool, spans) -> tuple[list[bytes], int]:
    """The words that stay, and how many the text had."""
    w = words(text)
    if copied and len(w) >= WINDOW:
        return [], len(w)
    if not spans:
        return w, len(w)
    out, at = [], 0
    for first, last in sorted((x["first"], x["last"]) for x in spans):
        if first > at:
            out += w[at:first]
        at = max(at, last + 1)
    return out + w[at:], len(w)


KEPT = "struct<n_words: long, n_removed: long, kept: string>"


def _kept_of(text, copied, spans):
    import pyarrow as pa
    size, gone, out = [], [], []
    for x in zip(text, copied, spans):
        w, n = kept_words(*(v.as_py() for v in x))
        size.append(n)
        gone.append(n - len(w))
        out.append(b" ".join(w).decode())
    return pa.StructArray.from_arrays([pa.array(size, pa.int64()), pa.array(gone, pa.int64()),
                                       pa.array(out, pa.string())], ["n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the kept words, one space between)."""
    kept = F.arrow_udf(_kept_of, KEPT)
    rows = marked(slim(docs, "doc_id", "text"), F.col("text"))
    return rows.select("doc_id", kept("text", "copied", "spans").alias("k")).select("doc_id", "k.*")


def keep_unrepeated(docs: DataFrame) -> DataFrame:
    """``docs`` whose texts have lost their repeated words (and ``n_chars``, if
    there, follows); a text that loses nothing stays as it is, white space
    included. No row goes."""
    kept = F.arrow_udf(_kept_of, KEPT)
    rows = marked(held(docs), F.col("row.text")).select("row", kept("row.text", "copied", "spans").alias("k"))
    changed = F.col("k.n_removed") > 0
    new = {"text": F.col("k.kept"), "n_chars": F.length("k.kept").cast("long")}
    return rows.select(*[
        (F.when(changed, new[c.lower()]).otherwise(F.col(f"row.`{c}`")) if c.lower() in new
         else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def remove_reference_spans(docs: DataFrame, reference: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept: without the spans of at least ``width``
    words that a text of ``reference`` holds. The reference's size is checked
    (:data:`MAX_REFERENCE_WORDS`); its shards are broadcast as texts, and each
    task builds their automata once and streams its documents past them."""
    spark = docs.sparkSession
    text = text_or_empty(reference["text"])
    size = reference.agg(F.sum(F.size(F.split(text, r"[\x20\x09-\x0D]+")))).first()[0] or 0
    if size > MAX_REFERENCE_WORDS:
        raise ValueError(f"the reference has {size} words; at most {MAX_REFERENCE_WORDS} are broadcast")
    shards: list[list[str]] = [[]]
    room = REFERENCE_SHARD_WORDS
    for (passage,) in reference.select(text).collect():  # bounded by the check above
        if room < 0:
            shards.append([])
            room = REFERENCE_SHARD_WORDS
        shards[-1].append(passage)
        room -= len(words(passage))
    sent = spark.sparkContext.broadcast(shards)

    def stream(batches):
        import pyarrow as pa
        built = []
        for shard in sent.value:
            built.append(SuffixAutomaton())
            for passage in shard:
                w = words(passage)
                built[-1].add(w, range(len(w)))
        for b in batches:
            rows = []
            for passage in b.column(1).to_pylist():
                w = words(passage)
                spans = [{"first": i - n + 1, "last": i} for a in built
                         for i, (_, n) in enumerate(a.matches(w)) if n >= width]
                rows.append(kept_words(passage, False, spans))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array([n for _, n in rows], pa.int64()),
                 pa.array([n - len(w) for w, n in rows], pa.int64()),
                 pa.array([b" ".join(w).decode() for w, _ in rows], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])

    return slim(docs, "doc_id", "text").mapInArrow(stream, "doc_id long, n_words long, n_removed long, kept string")
