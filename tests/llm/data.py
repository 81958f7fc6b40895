"""Small frames of documents with the columns of the table and extra ones that clash."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "kept string, row string, size string, h string, id string, rid string, spans string, n string")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def documents(spark, rows):
    """``rows`` of (doc_id, text, source); the other columns are filled in."""
    full = [(i, t, "en", s, None if t is None else len(t), *["x"] * 8) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentences(seed: int, n: int, vocabulary: int = 200) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def edge_rows():
    """Nulls in every place, empty and blank texts, repeats, ties, a long text."""
    long = sentences(5, 30_000, 5_000)
    base = sentences(1, 120)
    return [
        (1, base, "a"), (2, base + "\n", "b"), (3, base.replace(" ", "  "), None), (4, None, "a"), (5, "", "a"), (6, " \t\n", None),
        (7, long, "b"), (8, long, "b"), (None, base, "a"), (None, "only null id", None), (9, sentences(2, 50), "c"),
        (9, sentences(2, 50), "c"), (10, sentences(3, 400), "c"), (11, "é" * 300 + " ü", "a"), (12, "word", "a"), (13, "Word", "a"),
    ]
