"""Rows that every operator must bear, and readers of results."""

import random

AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, row long"


def awkward_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, columns with clashing names."""
    rng = random.Random(5)
    long_text = " ".join(rng.choice(["ab", "çd", "漢字", "x.", "🚨", "Foo", "b7"]) for _ in range(30_000))
    texts = [None, "", " \t\n", "word", "two words", "a b c", long_text, "x" * 50_000, "no end\n\n\nlines", "🚨 漢字 é", "1 2 3 ...", "same text here again", "same text here again"]
    rows = [(i, t, "en", "s1", 1, 0.5, 3, 4) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (3, "other text of the id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (None, "word", None, "s2", None, None, None, None)]
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), AWKWARD)


def by_id(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}
