"""Small hand-made documents with the awkward cases every operator must take."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, h int"


def document(doc_id, text, source="src0", lang="en"):
    """More columns than the operators ask for, some named like their own."""
    return (doc_id, text, lang, source, None if text is None else len(text), "x", "y", 1)


def documents(spark, rows):
    return spark.createDataFrame([document(*r) for r in rows], COLUMNS)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def awkward(seed=1, n=60):
    """Nulls, empties, white space, repeated rows, one very long text, one hot source, plain texts."""
    rng = random.Random(seed)
    rows = [(k, " ".join(words(rng, rng.randrange(1, 90))), f"src{k % 4 if k % 3 else 0}") for k in range(n)]
    rows += [(1000, None, "src1"), (1001, "", None), (1002, " \t\n ", "src2"), (None, "null id here", "src1")]
    rows += [(1003, "same row twice", "src3")] * 2 + [(1004, rows[3][1], "src0"), (1005, rows[3][1], "src0")]
    rows += [(2**62 + 1, " ".join(words(rng, 20_000)), None), (1006, "ünïcode ÉCOLE 日本 😀", "src1")]
    return rows
