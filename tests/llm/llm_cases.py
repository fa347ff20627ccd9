"""Rows that every operator has to take: nulls, empty and long texts, ties,
repeated rows, and extra columns named like those operators use inside."""

from __future__ import annotations

import random

EXTRA = "key string, h string, size long, rank int, `line` string"


def frame(spark, rows, id_name="doc_id", text_name="text", more=""):
    """(id, text, source) rows with clashing extra columns."""
    data = [(i, t, s, "k", None, 7, None, "x") for i, t, s in rows]
    return spark.createDataFrame(data, f"{id_name} long, {text_name} string, source string, {EXTRA}").repartition(3)


def words(rnd, n, vocabulary=60):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def documents(seed=1, n=60):
    """Random documents, copies, near copies and the odd rows."""
    rnd = random.Random(seed)
    base = [words(rnd, rnd.choice([6, 15, 40, 90])) for _ in range(8)]
    rows = []
    for i in range(n):
        text = rnd.choice(base).split() if rnd.random() < 0.6 else words(rnd, rnd.randrange(1, 60)).split()
        for _ in range(rnd.choice([0, 0, 1, 2])):
            text[rnd.randrange(len(text))] = f"v{rnd.randrange(99)}"
        rows.append((i * 2, rnd.choice([" ", "\n", " \t "]).join(text), rnd.choice(["a", "b", "Ä", None])))
    rows += [(1001, None, "a"), (1003, "", None), (1005, " \n\t ", "b"), (None, rows[0][1], "a"), (None, None, None),
             (1007, base[2] + " " + words(rnd, 4000), "b"), rows[3], rows[3]]
    rnd.shuffle(rows)
    return rows


def null_last(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))
