"""Small documents with the cases that every operator must take."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string, epoch string, fp string, h string"


def docs(spark, rows):
    """rows: (doc_id, text, lang, source); the other columns are extra ones with clashing names."""
    full = [(i, t, la, so, None if t is None else len(t), "x", "x", "x", "x", "x") for i, t, la, so in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed: int, n: int, words=("the", "of", "stone", "river", "tall", "and", "house", "under", "seven", "ships", "glass", "wind")) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "", ",", "."]) for _ in range(n))


EDGE = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, "   \n\t ", "en", "a"),
    (4, prose(1, 60), "en", "a"),
    (4, prose(1, 60), "en", "a"),
    (5, prose(1, 60), None, "b"),
    (None, prose(2, 30), "de", None),
    (6, "w" * 50_000, "de", "b"),
    (7, prose(3, 20_000), "en", "b"),
    (8, "Ünïcödé ☃ " * 30, "fr", "c"),
]
