"""Fixtures shared by the operator tests: small tables with every awkward case."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, kept int, score string, root string, start string"
WORDS = "the of and to in river stone light walking under heavy window paper garden letter morning quiet yellow street dream".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", str(rng.randint(0, 99))]) for _ in range(n))


def awkward(spark, texts=()):
    """Null and empty texts, null ids, repeated rows, ties, one very long text, and columns with clashing names."""
    base = [(1, None), (2, ""), (3, " \n\t "), (4, prose(4, 120)), (4, prose(4, 120)), (5, prose(4, 120)), (6, prose(6, 30_000)), (None, prose(7, 80)), (None, None), (8, "é"), (9, "x" * 5000)]
    rows = [(i, t, "en", None, None, "r", 1, "s", "q", "z") for i, t in [*base, *texts]]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
