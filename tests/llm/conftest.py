import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text) or (doc_id, text, lang, source) tuples."""
    def make(rows, parts=3):
        full = []
        for r in rows:
            r = (*r, *("en", "src0")[len(r) - 2:]) if len(r) < 4 else r
            full.append((*r, len(r[1] or "")))
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def words():
    """words(seed, n): n invented words."""
    def make(seed, n):
        rng = random.Random(str(seed))
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))
    return make


@pytest.fixture(scope="session")
def edge_rows(words):
    """Nulls, empty, blank, very long and repeated texts, ties, repeated and missing ids."""
    long = words(1, 60_000)
    near = words(2, 80)
    return [
        (0, None), (1, ""), (2, " \t\n\x0b\x0c\r "), (3, "a"), (4, " a"), (4, " a"), (5, "a\n"),
        (6, long), (7, long + " end"), (8, "   é 😀 ퟿"), (9, near), (10, near + " more"), (11, near.upper()),
        (12, near + "\n" + near), (None, near), (None, None), (13, words(3, 200)), (14, words(3, 200)[:700]),
        (15, "x" * 3000), (16, "x" * 2999), (15, words(4, 30)), (17, "word"), (18, "WORD"),
    ]
