from __future__ import annotations

import random

import pytest

WORDS = ("the of and river stone Light über été niño 42 token secret x7 alpha beta gamma delta "
         "the the of house tree").split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",\n", "!"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs():
    """Rows with nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split(" ")
    rows = [(1, base), (2, base.upper()), (3, base), (3, base), (4, None), (5, ""), (6, " \n\t"),
            (7, "one two"), (8, "ONE two"), (9, prose(rng, 20_000)), (10, "é" * 3_000),
            (None, base), (None, None), (11, "word " * 400), (12, "word " * 401)]
    for i in range(20, 40):
        words = list(near)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randrange(99))
        rows.append((i, " ".join(words)))
    rows += [(i, prose(rng, rng.randrange(1, 60))) for i in range(50, 90)]
    return rows


SCHEMA = "doc_id long, text string, n_words int, score string, _text int, token string, node int"


@pytest.fixture(scope="session")
def docs_frame(spark, odd_docs):
    """``odd_docs`` with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 7, "s", 1, None, 2) for i, t in odd_docs], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()),
                  key=lambda r: tuple((x is not None, x) for x in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
