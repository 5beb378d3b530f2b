"""Small documents with everything that operators must bear."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, label int, `odd.name` string"


def docs(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) as documents with extra columns that clash with working names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), "r", "i", 1, "o") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, words=None):
    return " ".join(rng.choice(words or [f"w{i}" for i in range(400)]) for _ in range(n))


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows and a very long text."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    return [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "a  b"), (5, "a  b"), (6, long, None, None), (7, long + " end"), (None, "no id here"), (8, "déjà vu ▁ 漢字 \U0001f600"), (9, "A\x00B\x0b c")]
