"""Inputs and plain versions that the tests of this folder share."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

SF0001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table from (doc_id, text) rows."""
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], SCHEMA)


ODD_ROWS = [(1, None), (2, ""), (3, "   \n"), (4, "one"), (4, "one"), (None, "one two three four five six"),
            (5, "x" * 30_000), (6, "word " * 8_000), (9, "long text, " * 7_000), (7, "Ünï çødé 漢字 😀 !?"), (8, "one two three four five six")]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and a column named like the operators' own."""
    from pyspark.sql import functions as F
    df = documents(spark, ODD_ROWS)
    for name in ("toxicity", "fp", "key", "secrets", "rid", "n", "t", "u", "v", "node", "root", "y", "doc", "new", "__key",
                 "__text", "__doc", "a.b", "c`d"):
        df = df.withColumn(name, F.lit("own"))
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])


def components_of(nodes, edges):
    """node -> smallest node of its component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
