"""Small tables with every hard case: nulls, empty and long texts, ties,
repeated rows, extra columns whose names clash with the operators' own."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, node string, kept string, shard string, bands string, `offset` string, rejected_by string, "
          "row_number string, length string, file_path string")


def words(text):
    return (text or "").encode().split()


def table(spark, rows, partitions=3):
    """A documents table of (doc_id, text) rows, with clashing extra columns."""
    data = [(i, t, None, "src0", len(t) if t is not None else None, *["x"] * 10) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(partitions)


def prose(rng, n, vocabulary=400):
    return " ".join(rng.choice("the of and to".split()) if rng.random() < 0.2 else f"w{rng.randrange(vocabulary)}"
                    for _ in range(n))


def hard_rows(seed=1):
    """(doc_id, text): near copies, shared passages, copies, periodic and odd texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(12)]
    passage = prose(rng, 60)
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(12, 30):  # near copies of two texts
        w = base[i % 2].split()
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    for i in range(30, 36):  # one passage in different texts
        rows.append((i, prose(rng, 50) + "\n" + passage + "  " + prose(rng, 40)))
    rows += [(36, base[3]), (37, base[3]), (37, base[3])]  # copies, a repeated row
    rows += [(38, "again " * 120), (39, "again " * 90), (40, "a b c " * 70)]  # periodic
    rows += [(41, None), (42, ""), (43, " \n\t "), (None, base[4]), (None, None), (44, "one two"), (45, "one two"),
             (46, "tiny"), (47, "é ü\x85ß\x1c日本 \x0bx"), (48, prose(rng, 20_000)), (49, "!! " * 80), (50, "x### " * 60)]
    return rows
