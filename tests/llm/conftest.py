import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the", "und", "der", "xyz", "Éa"]) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, very long, tied and repeated rows, near copies, nulls in any column."""
    rng = random.Random(5)
    rows = [(0, None, "en", "s0", None), (1, "", None, "s1", 0), (2, " \t\n\x0b ", "en", None, 4), (3, "one", "en", "s0", 3),
            (4, "one two", "de", "s0", 7), (None, "a null id has this text of its own", "de", "s1", 9), (5, "x" * 5000 + " end", "en", "s1", 5004)]
    base = words(rng, 120)
    for i in range(10, 20):
        rows.append((i, base, "en", "s0", len(base)))                     # copies
    for i in range(20, 30):
        t = base.split()
        t[(i * 7) % 120] = f"edit{i}"
        t = " ".join(t)
        rows.append((i, t, "de", "s1", len(t)))                            # near copies
    for i in range(30, 70):
        t = words(rng, rng.randrange(1, 200)) + ("\n" + "same line here\n" * 3 if i % 5 == 0 else "") + (" idiot###" * 4 if i % 4 == 0 else "")
        rows.append((i, t, rng.choice(["en", "de", None]), f"s{i % 3}", len(t)))
    t = words(rng, 30000)
    rows += [(70, t, "en", "s0", len(t)), (71, "Ünïcode naïve — 漢字 🙂 <|endoftext|> é", "fr", "s0", 30), rows[-1], rows[-1]]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, DOCS)
    clash = ["id", "n", "fp", "kept", "score", "size", "shard", "tokens", "weight", "rule", "n_words", "value", "label", "ids", "start"]
    return docs.withColumns({c: F.lit("clash") for c in clash}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_labels(spark, odd_rows):
    rows = [(r[0], int("###" not in (r[1] or "")), int("idiot" in (r[1] or ""))) for r in odd_rows]
    rows += [(999, None, None), (None, 1, 0), (30, None, 1), (31, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
