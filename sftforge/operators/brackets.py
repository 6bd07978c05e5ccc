"""Bracket analytics over a sequence table (seq_id, seq): B1-B6.

Semantics are the lenient ones of the reasoning trace: an opening bracket
pushes its closer; a closer on a non-empty stack pops (a *match* if it equals
the top, a *mismatch* otherwise -- it pops anyway); a closer on an empty stack
is *ignored*; any other character is *other* and changes nothing.

Physical plan. A sequence of up to ``SEGMENT`` characters is walked where it
lies: an Arrow kernel takes the sequences of a batch in slices of up to ``SLICE``
characters (running sums, running minima and sorts in numpy, no loop over
characters) and gives a row a character, a batch a slice, so its memory does not
follow the number or length of rows. Nothing moves, so rows may repeat an id.

A longer sequence is cut into segments that Spark deals out. A segment reduces
to a pair (closers that reach before it, openers left open behind it); these
pairs compose associatively, so running sums and minima over them (one row a
segment) give the stack's height where each segment starts, and every segment is
walked on its own from there. What it leaves open (one opening bracket and one
closer a level at most) meets the others' by (sequence, level). So no task holds
more than a segment, however long the sequence. Equal long rows are walked once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.functions import constants as K

OPEN, CLOSE, OTHER = "open", "close", "other"
#: Characters that one task walks in a row.
SEGMENT = 1 << 16
#: Characters that a kernel holds at a time (or one text, of up to ``SEGMENT``).
SLICE = 1 << 17


def closer_of(ch: Column) -> Column:
    return F.translate(ch, K.OPENERS, K.CLOSERS)


def _base(df: DataFrame, id_col: str, seq_col: str, keep=()) -> DataFrame:
    """Every sequence, the empty and null ones too."""
    return df.select(F.col(id_col).alias("seq_id"), F.col(seq_col).alias("seq"), *keep)


def explode_brackets(df: DataFrame, id_col: str = "seq_id", seq_col: str = "seq", keep=()) -> DataFrame:
    """B1: (seq_id, pos, ch, kind) with 0-based ``pos``; the trace's step is
    pos + 1. Empty sequences give no rows. ``n`` = sequence length."""
    b = _base(df, id_col, seq_col, keep).filter(F.length("seq") > 0)
    x = b.select("seq_id", F.length("seq").cast("bigint").alias("n"), *keep,
                 F.posexplode_outer(F.split("seq", "")).alias("pos", "ch"))  # as functions.text.each
    return x.withColumn("pos", F.col("pos").cast("bigint")).withColumn("kind", kind_of(F.col("ch")))


def kind_of(ch: Column) -> Column:
    return (F.when(ch.isin(*K.OPENERS), F.lit(OPEN)).when(ch.isin(*K.CLOSERS), F.lit(CLOSE)).otherwise(F.lit(OTHER)))


EVENTS = ["other", "ignored", "open", "match", "mismatch", None]
FAULTS = [*EVENTS[:5], "unclosed", None]


def _walker(parts: tuple):
    """``(walk, slices)`` for kernels. ``walk`` takes texts and the height at
    which each starts to flat arrays with a value a character, of which ``parts``
    (``event``, ``top``) are made: depth, ignored, event and fault (places in
    ``EVENTS`` and ``FAULTS``), partner, top (the bracket's kind) and parent (-1:
    none). Positions count from the text's start. A closer whose opening bracket
    lies before the text has neither event nor partner; a top that lies before
    it has no parent. ``slices`` cuts texts into runs of up to ``SLICE``
    characters, so that memory does not follow the number of texts in a batch."""
    openers, closers, most = K.OPENERS, K.CLOSERS, SLICE

    def slices(sizes):
        lo, total = 0, 0
        for i, size in enumerate(sizes):
            if i > lo and total + size > most:
                yield lo, i
                lo, total = i, 0
            total += size
        if lo < len(sizes):
            yield lo, len(sizes)

    def walk(rows, start):
        size = np.array([len(t) for t in rows], np.int64)
        edge = np.concatenate([[0], np.cumsum(size)])
        total, n = int(edge[-1]), len(rows)
        code = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32)
        kind = np.full(total, -1, np.int64)  # 0 to 3: the opening bracket, 4 to 7: the closer
        for k, c in enumerate(openers + closers):
            kind[code == ord(c)] = k
        is_open, is_close = (kind >= 0) & (kind < 4), kind >= 4
        row = np.repeat(np.arange(n), size)
        # one line for all rows, each far below the one before, with its start height in front
        step = is_open.astype(np.int64) - is_close
        far = int(start.max(initial=0) + size.max(initial=0) + 1) * 2
        line = np.zeros(total + n, np.int64)
        at = np.arange(total) + row + 1
        line[at] = step
        height = np.cumsum(line)
        first = edge[:-1] + np.arange(n)
        height += np.repeat(start - height[first], size + 1)
        low = np.minimum.accumulate(np.minimum(height, 0) - np.repeat(np.arange(n), size + 1) * far)
        low += np.repeat(np.arange(n), size + 1) * far
        depth = (height - low)[at]
        ignored = is_close & (low[at] < low[at - 1])
        out = {"size": size, "row": row, "code": code, "place": np.arange(total) - edge[row], "depth": depth, "ignored": ignored}
        if "event" in parts:
            effective = is_close & ~ignored
            level = np.where(is_open, depth, np.where(effective, depth + 1, -1))
            some = np.flatnonzero(level >= 0)
            order = some[np.lexsort((some, level[some], row[some]))]  # opening brackets and closers of a level alternate
            same = (row[order][1:] == row[order][:-1]) & (level[order][1:] == level[order][:-1]) & is_open[order][:-1]
            partner = np.full(total, -1, np.int64)
            partner[order[:-1][same]], partner[order[1:][same]] = order[1:][same], order[:-1][same]
            event = np.where(is_open, 2, np.where(ignored, 1, 0))
            met = effective & (partner >= 0)
            event[effective] = 5
            event[met] = np.where(kind[met] - 4 == kind[partner[met]], 3, 4)
            unclosed = is_open & (partner < 0)
            out["event"], out["partner"] = event, np.where(partner >= 0, partner - edge[row], -1)
            out["fault"] = np.where(unclosed, 5, np.where((event == 2) | (event == 3) | (event == 5), 6, event))
        if "top" in parts:
            order = np.lexsort((np.arange(total), depth, row))
            last = np.maximum.accumulate(np.where(is_open[order], np.arange(total), -1))
            new = np.concatenate([[True], (row[order][1:] != row[order][:-1]) | (depth[order][1:] != depth[order][:-1])])[:total]
            group = np.maximum.accumulate(np.where(new, np.arange(total), 0))
            top = np.full(total, -1, np.int64)
            found = (last >= group) & (depth[order] > 0)
            top[order[found]] = order[last[found]]
            out["top"], out["parent"] = np.where(top < 0, -1, kind[top]), np.where(top < 0, -1, top - edge[row])
        return out

    return walk, slices


def _reduce_kernel():
    """Arrow kernel: closers that reach before each text, openers that it leaves
    open, its highest height over the start, and its greatest depth on an empty stack."""
    openers, closers = [ord(c) for c in K.OPENERS], [ord(c) for c in K.CLOSERS]

    def run(texts):
        import pyarrow as pa
        out = []
        for t in texts:
            code = np.frombuffer(t.as_py().encode("utf-32-le"), np.uint32)
            height = np.cumsum(np.isin(code, openers).astype(np.int64) - np.isin(code, closers))
            low = np.minimum.accumulate(np.minimum(height, 0))
            down = -int(low[-1]) if len(low) else 0
            out.append((down, int(height[-1]) + down if len(height) else 0, int(height.max(initial=0)),
                        int((height - low).max(initial=0))))
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 4,
                                          ["down", "up", "high", "peak"])

    return run


def _characters(rows: DataFrame, cols, parts: tuple) -> DataFrame:
    """``rows`` with ``seq`` (none null) -> ``cols`` and a row a character: pos,
    ch, depth, ignored, what ``parts`` ask for, kind. Of segments, ``_height`` is
    the height and ``_start`` the position at which they start, and ``max_depth``
    is among their columns. Batches come out as they are walked, a slice each."""
    whole = "_height" not in rows.columns
    given = [c for c in cols if not (whole and c == "max_depth")]
    rows = rows.select(*given, "seq", *([] if whole else ["_height", "_start"]))
    walk, slices = _walker(parts)
    events, faults, closers = EVENTS, FAULTS, K.CLOSERS
    fields = [*rows.select(*given).schema.fields, *([T.StructField("max_depth", T.LongType())] if whole else [])]
    text, number = T.StringType(), T.LongType()
    made = [("pos", number), ("ch", text), ("depth", number), ("ignored", T.BooleanType())]
    made += [("event", text), ("partner", number), ("fault", text)] if "event" in parts else []
    made += [("top", text), ("parent", number)] if "top" in parts else []
    schema = T.StructType(fields + [T.StructField(c, t) for c, t in made])
    names = schema.names

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def texts(values, at):
            return pa.array(values, pa.string()).take(pa.array(at, mask=at < 0))

        for batch in batches:
            for lo, hi in slices(pc.utf8_length(batch.column("seq")).to_pylist()):
                b = batch.slice(lo, hi - lo)
                rows = b.column("seq").to_pylist()
                height, start = (np.zeros(hi - lo, np.int64) if whole else b.column(c).to_numpy(zero_copy_only=False)
                                 for c in ("_height", "_start"))
                w = walk(rows, height)
                row, code, pos = w["row"], w["code"], w["place"] + start[w["row"]]
                ends = np.zeros(len(code) + 1, np.int32)
                np.cumsum(1 + (code >= 1 << 7).astype(np.int32) + (code >= 1 << 11) + (code >= 1 << 16), out=ends[1:])
                out = {c: b.column(c).take(pa.array(row)) for c in given}
                if whole:
                    edge = np.cumsum(w["size"]) - w["size"]
                    out["max_depth"] = pa.array(np.maximum.reduceat(w["depth"], edge)[row], pa.int64())
                out |= {"pos": pa.array(pos, pa.int64()), "depth": pa.array(w["depth"], pa.int64()),
                        "ch": pa.StringArray.from_buffers(len(code), pa.py_buffer(ends), pa.py_buffer("".join(rows).encode())),
                        "ignored": pa.array(w["ignored"])}
                for c in ("partner", "parent"):
                    if c in w:
                        out[c] = pa.array(w[c] + start[row], pa.int64(), mask=w[c] < 0)
                for c, values in (("event", events), ("fault", faults), ("top", list(closers))):
                    if c in w:
                        out[c] = texts(values, w[c])
                yield pa.RecordBatch.from_arrays([out[c] for c in names], names)

    return rows.mapInArrow(run, schema).withColumn("kind", kind_of(F.col("ch")))


CHECKED = "struct<max_depth: bigint, pos: bigint, fault: string, dcut: bigint>"


def _check_kernel(cut: int):
    """Arrow kernel: texts, none empty -> :data:`CHECKED`: greatest depth, position and reason
    of the first fault (null: none), and the depth after ``cut`` characters (0: shorter texts)."""
    walk, slices = _walker(("event",))
    faults = FAULTS

    def run(texts):
        import pyarrow as pa
        import pyarrow.compute as pc
        out = []
        for lo, hi in slices(pc.utf8_length(texts).fill_null(0).to_pylist()):
            w = walk([t or "" for t in texts.slice(lo, hi - lo).to_pylist()], np.zeros(hi - lo, np.int64))
            edge = np.cumsum(w["size"]) - w["size"]
            bad = np.flatnonzero(w["fault"] < 6)
            at, first = np.unique(w["row"][bad], return_index=True)
            where = dict(zip(at.tolist(), bad[first].tolist()))
            for i, (e, size) in enumerate(zip(edge.tolist(), w["size"].tolist())):
                f = where.get(i)
                out.append({"max_depth": int(w["depth"][e:e + size].max(initial=0)),
                            "pos": None if f is None else f - e, "fault": None if f is None else faults[w["fault"][f]],
                            "dcut": int(w["depth"][e + cut - 1]) if 0 < cut <= size else 0})
        return pa.array(out, pa.struct([("max_depth", pa.int64()), ("pos", pa.int64()), ("fault", pa.string()),
                                        ("dcut", pa.int64())]))

    return run


def _long_segments(b: DataFrame, keep) -> DataFrame:
    """Segments of the long sequences of ``b``: _key (of each different row),
    _copies, seg, seq, and the height at which each starts."""
    size = SEGMENT

    @F.arrow_udf("array<string>")
    def cut(texts):
        import pyarrow as pa
        return pa.array([[t[i:i + size] for i in range(0, len(t), size)] for t in texts.to_pylist()],
                        pa.list_(pa.string()))

    rows = b.filter(F.length("seq") > SEGMENT).groupBy("seq_id", "seq", *keep).agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.withColumn("_key", F.sha2(F.to_json(F.struct("seq_id", "seq", *keep)), 256))
    segs = rows.select("_key", "seq_id", *keep, "_copies", F.length("seq").cast("bigint").alias("n"),
                       F.posexplode(cut("seq")).alias("seg", "seq"))
    segs = segs.repartition("_key", "seg")
    pairs = segs.select("_key", "seg", F.arrow_udf(
        _reduce_kernel(), "struct<down: bigint, up: bigint, high: bigint, peak: bigint>")("seq").alias("r"))
    w = Window.partitionBy("_key").orderBy("seg")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    pairs = pairs.select("_key", "seg", "r.*").withColumn(
        "_sum", F.coalesce(F.sum(F.col("up") - F.col("down")).over(before), F.lit(0)))
    pairs = pairs.withColumn("_low", F.least(F.lit(0), F.coalesce(F.min(F.col("_sum") - F.col("down")).over(before), F.lit(0))))
    pairs = pairs.withColumn("_height", F.col("_sum") - F.col("_low"))
    most = F.max(F.greatest(F.col("_height") + F.col("high"), F.col("peak"))).over(Window.partitionBy("_key"))
    return segs.join(pairs.select("_key", "seg", "_height", most.alias("max_depth")), ["_key", "seg"])


def _walk(df: DataFrame, id_col: str, seq_col: str, keep, parts: tuple) -> DataFrame:
    """A row for each character with n, kind, depth, ignored, max_depth and what
    ``parts`` (``event``, ``top``) ask for: event, partner, fault; top, parent."""
    b = _base(df, id_col, seq_col, keep).filter(F.length("seq") > 0)
    cols = ["seq_id", "n", *keep, "max_depth"]
    short = b.filter(F.length("seq") <= SEGMENT).withColumn("n", F.length("seq").cast("bigint"))
    short = _characters(short, cols, parts)
    return short.unionByName(_walk_long(b, keep, parts, cols).select(*short.columns))


def _walk_long(b: DataFrame, keep, parts: tuple, cols) -> DataFrame:
    segs = _long_segments(b, keep).withColumn("_start", F.col("seg").cast("bigint") * SEGMENT)
    x = _characters(segs, ["_key", "_copies", "seg", *cols], parts)
    is_open = F.col("kind") == OPEN
    if "event" in parts:
        # what segments leave open, one bracket and one closer a level each at most
        level = F.when(is_open, F.col("depth")).otherwise(F.col("depth") + 1)
        left = x.filter((is_open | ((F.col("kind") == CLOSE) & ~F.col("ignored"))) & F.col("partner").isNull())
        wl = Window.partitionBy("_key", "level").orderBy("pos")
        left = left.select("_key", "pos", "ch", "kind", level.alias("level"))
        other = lambda c: F.when(is_open, F.lead(c).over(wl)).otherwise(F.lag(c).over(wl))
        left = left.withColumn("_partner", other("pos")).withColumn("_ch", other("ch"))
        matched = F.when(closer_of(F.col("_ch")) == F.col("ch"), F.lit("match")).otherwise(F.lit("mismatch"))
        left = left.select("_key", "pos", "_partner", F.when(~is_open, matched).alias("_event"))
        x = x.join(left, ["_key", "pos"], "left")
        x = x.withColumn("event", F.coalesce("event", "_event")).withColumn("partner", F.coalesce("partner", "_partner"))
        fault = (F.when(F.col("event").isin("mismatch", "ignored", "other"), F.col("event"))
                 .when(is_open & F.col("partner").isNull(), F.lit("unclosed")))
        x = x.withColumn("fault", fault).drop("_partner", "_event")
    if "top" in parts:
        # the bracket on top where a segment starts, or under what it closes: the last one of that level before it
        last = x.filter(is_open).groupBy("_key", "seg", F.col("depth").alias("level")).agg(
            F.max_by(closer_of(F.col("ch")), "pos").alias("_top"), F.max("pos").alias("_parent"))
        asked = x.filter(F.col("parent").isNull() & (F.col("depth") > 0)).select(
            "_key", "seg", F.col("depth").alias("level")).distinct()
        both = last.select("_key", "seg", "level", F.struct("_parent", "_top").alias("o")).unionByName(
            asked.select("_key", "seg", "level", F.lit(None).cast("struct<_parent: bigint, _top: string>").alias("o")))
        wl = Window.partitionBy("_key", "level").orderBy("seg").rangeBetween(Window.unboundedPreceding, -1)
        both = both.withColumn("b", F.max("o").over(wl)).filter("o is null").select(
            "_key", "seg", F.col("level").alias("depth"), F.col("b._top").alias("_top"), F.col("b._parent").alias("_parent"))
        x = x.join(both, ["_key", "seg", "depth"], "left")
        x = (x.withColumn("top", F.coalesce("top", "_top"))
             .withColumn("parent", F.coalesce("parent", "_parent")).drop("_top", "_parent"))
    # one row for each of the equal rows
    return x.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_copy")


def bracket_depth(df: DataFrame, id_col: str = "seq_id", seq_col: str = "seq", keep=()) -> DataFrame:
    """B2: depth after each character, whether a closer was ignored, and the
    sequence's ``max_depth``.

    Depth is a *reflected* running sum: with S the running sum of +1/-1 and M
    the running minimum of min(0, S), depth = S - M. A closer is ignored iff it
    lowers that minimum (the stack was empty)."""
    return _walk(df, id_col, seq_col, keep, ()).select(
        "seq_id", "n", *keep, "pos", "ch", "kind", "depth", "ignored", "max_depth")


def bracket_events(df: DataFrame, id_col: str = "seq_id", seq_col: str = "seq", keep=()) -> DataFrame:
    """Event per character (open / match / mismatch / ignored / other), the
    partner position, and ``fault`` (mismatch, ignored, other, unclosed).

    Level = depth after an open, depth before an effective close. Opens and
    closes of a level alternate by position, so an open's partner is the next
    character of its level and a close's partner the previous."""
    return _walk(df, id_col, seq_col, keep, ("event",)).select(
        "seq_id", "n", *keep, "pos", "ch", "kind", "depth", "ignored", "max_depth", "event",
        F.col("partner").alias("partner_pos"), "fault")


def closers_needed(seq: Column) -> Column:
    """The closers that complete a sequence, as an expression on one row. Read
    from the right, an opening bracket is closed iff a closer is still unused;
    the others' closers, in that order, are the completion. The state is a
    counter and the completion so far, so a step copies no stack."""
    def step(acc, c):
        is_open, free = c.isin(*K.OPENERS), acc["free"]
        return F.struct(
            F.when(c.isin(*K.CLOSERS), free + 1).when(is_open & (free > 0), free - 1).otherwise(free).alias("free"),
            F.when(is_open & (free == 0), F.concat(acc["need"], closer_of(c))).otherwise(acc["need"]).alias("need"))

    start = F.struct(F.lit(0).alias("free"), F.lit("").alias("need"))
    return F.aggregate(F.reverse(F.split(seq, "")), start, step)["need"]


def complete_brackets(df: DataFrame, id_col: str = "seq_id", seq_col: str = "seq",
                      method: str = "fold") -> DataFrame:
    """Minimal closers for a prefix (closers of the unpartnered opens, last
    first) and the completed word. The empty sequence needs none; null stays null.

    ``fold``: :func:`closers_needed` on each row, narrow. ``relational``: from
    :func:`bracket_events`, opens without partner collected per sequence, for
    sequences too long to fold in one expression."""
    b = _base(df, id_col, seq_col)
    if method == "fold":
        need = closers_needed(F.col("seq"))
        return b.select("seq_id", need.alias("completion"), F.concat("seq", need).alias("completed"))
    if method != "relational":
        raise ValueError(f"unknown method {method!r}")
    # equal rows are completed once, as rows are told apart by id and text
    rows = b.groupBy("seq_id", "seq").agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.withColumn("_of", F.sha2(F.to_json(F.struct("seq_id", "seq")), 256))
    e = bracket_events(rows, "seq_id", "seq", keep=("_of",))
    g = e.filter("fault = 'unclosed'").groupBy("_of").agg(
        F.sort_array(F.collect_list(F.struct("pos", closer_of(F.col("ch")).alias("c"))), asc=False).alias("_u"))
    need = F.coalesce(F.array_join(F.transform("_u", lambda x: x["c"]), ""), F.when(F.col("seq").isNotNull(), ""))
    return (rows.join(g, "_of", "left").withColumn("completion", need)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
            .select("seq_id", "completion", F.concat("seq", "completion").alias("completed")))


def stack_states(df: DataFrame, id_col: str = "seq_id", seq_col: str = "seq") -> DataFrame:
    """The stack after each step, as a linked list: its ``depth``, the
    closer on ``top`` and ``parent_pos``, the position of that closer's opening
    bracket (null on the empty stack). The stack below the top is the state just
    before ``parent_pos``, so any whole stack can be followed down, and the
    output is linear in the input. For the stack as text on short sequences, see
    :func:`stack_texts`."""
    return _walk(df, id_col, seq_col, (), ("top",)).select(
        "seq_id", "pos", "depth", "top", F.col("parent").alias("parent_pos"))


def stack_texts(df: DataFrame, id_col: str = "seq_id", seq_col: str = "seq") -> DataFrame:
    """B5 as text (closers, bottom first) after each step, for short sequences
    such as task prefixes: the text of all states grows with length x depth."""
    def step(acc, c):
        st = acc["st"]
        nst = (F.when(c.isin(*K.OPENERS), F.concat(st, closer_of(c)))
                .when(c.isin(*K.CLOSERS) & (F.length(st) > 0), F.left(st, F.length(st) - 1))
                .otherwise(st))
        return F.struct(nst.alias("st"), F.concat(acc["states"], F.array(nst)).alias("states"))

    init = F.struct(F.lit("").alias("st"), F.array().cast("array<string>").alias("states"))
    b = _base(df, id_col, seq_col).filter(F.length("seq") > 0)
    states = F.aggregate(F.split("seq", ""), init, step)["states"]
    return (b.select("seq_id", F.posexplode(states).alias("pos", "stack"))
             .withColumn("pos", F.col("pos").cast("bigint")))


def check_brackets(df: DataFrame, id_col: str = "seq_id", seq_col: str = "seq",
                   length: int | None = None, cut: int | None = None, min_depth: int = 0) -> DataFrame:
    """Per sequence: balanced?, first fault (position and reason), and the
    generator's accept flags: length == ``length``, stack size at the cut ==
    characters after it (``cut``), max depth >= ``min_depth``.

    Faults: mismatch, ignored, other, unclosed (an open without partner). The
    empty sequence is balanced; a null one gives nulls."""
    b = _base(df, id_col, seq_col).filter(F.length("seq") > 0)
    parts = ["seq_id", "length", "max_depth", "_first", "_dcut"]
    short = b.filter(F.length("seq") <= SEGMENT).withColumn("w", F.arrow_udf(_check_kernel(cut or 0), CHECKED)("seq"))
    first = F.when(F.col("w.fault").isNotNull(), F.struct(F.col("w.pos").alias("pos"), F.col("w.fault").alias("f")))
    short = short.select("seq_id", F.length("seq").cast("bigint").alias("length"), F.col("w.max_depth").alias("max_depth"),
                         first.alias("_first"), F.col("w.dcut").alias("_dcut"))
    e = _walk_long(b, (), ("event",), ["seq_id", "n", "max_depth"])
    # each copy of a row gives every character once
    long = e.groupBy("_key").agg(
        F.first("seq_id").alias("seq_id"), F.max("n").alias("length"), F.max("max_depth").alias("max_depth"),
        F.min(F.when(F.col("fault").isNotNull(), F.struct(F.col("pos"), F.col("fault").alias("f")))).alias("_first"),
        F.coalesce(F.max(F.when(F.col("pos") == (cut or 0) - 1, F.col("depth"))), F.lit(0)).alias("_dcut"),
        F.max("_copies").alias("_copies"))
    long = long.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    g = short.select(*parts).unionByName(long.select(*parts))
    out = g.select(
        "seq_id", "length", "max_depth",
        F.col("_first").isNull().alias("balanced"),
        F.col("_first")["pos"].alias("fault_pos"), F.col("_first")["f"].alias("fault"),
        (F.col("length") == length).alias("length_ok") if length is not None else F.lit(None).cast("boolean").alias("length_ok"),
        ((F.col("length") >= cut) & (F.col("_dcut") == F.col("length") - cut)).alias("cut_ok")
        if cut is not None else F.lit(None).cast("boolean").alias("cut_ok"),
        (F.col("max_depth") >= min_depth).alias("depth_ok"))
    none, zero = F.lit(None), F.when(F.col("seq").isNotNull(), F.lit(0).cast("bigint"))
    rest = _base(df, id_col, seq_col).filter(F.coalesce(F.length("seq"), F.lit(0)) == 0).select(
        "seq_id", zero.alias("length"), zero.alias("max_depth"), (zero == 0).alias("balanced"),
        none.cast("bigint").alias("fault_pos"), none.cast("string").alias("fault"),
        ((zero == length) if length is not None else none.cast("boolean")).alias("length_ok"),
        ((zero >= cut) if cut is not None else none.cast("boolean")).alias("cut_ok"),
        (zero >= min_depth).alias("depth_ok"))
    return out.union(rest)
