import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

DATA = "/root/testdata/sf0.001"
WORDS = "the of and ationre thhe ingen shre ndha tiou blenth erwhst onaned".split()
LONG = " ".join(WORDS[i % 11] + str(i % 977) for i in range(40_000))

#: Nulls, empty and blank texts, a very long one, repeated rows, a repeated id and a missing one.
EDGE_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t  \n"),
    (4, LONG),
    (5, "one two three four five six\nseven eight nine ten eleven twelve"),
    (5, "one two three four five six\nseven eight nine ten eleven twelve"),
    (5, "another text under the same id with nothing else in common here"),
    (None, "one two three four five six\nwithout an id of its own this time"),
    (None, None),
    (6, "Ünïcödé 中文 😀 <|endoftext|> \x00 it's 1234 ²Ⅷ\x1c\x85　end"),
    (7, "one two three four five six\nthe last of them has other words on it"),
]
CLASHING = ["ids", "key", "line", "set", "n", "word", "fp", "score", "kept", "length", "raw", "url", "features", "tie"]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge cases with columns whose names the operators use themselves."""
    columns = ", ".join(f"{c} string" for c in CLASHING)
    rows = [(*r, *("x" for _ in CLASHING)) for r in EDGE_TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, {columns}")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")
