"""Rows that every operator must handle: NULLs, empty and very long texts, repeated rows, and columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, node long, root long, key string, member long, bucket int, a long, b long, _gone int, _other long, grade int, h long, seed int, bits int, start int"
EXTRA = (7, 7, 7, "x", 7, 7, 7, 7, 7, 7, 7, 7, 7, 7, 7)


def words(n, seed, size=5000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def frame(spark, rows):
    """A table of (doc_id, text) rows with the columns of documents and others."""
    full = [(i, t, None if t is None else "en", "s", None if t is None else len(t), *EXTRA) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
