"""Small inputs that every operator has to stand."""

import random
import string

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, cls string, score string, words int, start int"


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 1, "k", "c", "s", 2, 3)


def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and
    ids, ties, and columns whose names operators use inside."""
    rows = [row(1, None), row(2, ""), row(3, " \t\n"), row(4, "one"), row(5, "two words"), row(6, "12 34 !!"),
            row(7, LONG, None, None), row(8, "the same text of some words here"), row(9, "the same text of some words here"),
            row(9, "the same text of some words here"), row(9, "another text under one id, that is all"),
            row(None, "a text without an id", None, "b"), row(None, None, None, None), row(10, "Ünï çødé 日本語 текст", "xx", "b")]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(rng, n, vocabulary=400):
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def rng(seed=5):
    return random.Random(seed)
