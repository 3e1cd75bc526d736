import random

import pytest

#: Columns that share names with what the operators use inside.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, size int, `key` string, "
    "row string, label string, rank int, id int, node bigint, ids string, chunk int, start int, mix int, held string"
)


def sentence(rng, n, stock="abcdefgh"):
    return " ".join("".join(rng.choice(stock) for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Documents with nulls in any column, blank, short and very long texts, copies, near copies and repeated rows."""
    rng = random.Random(7)
    base = sentence(rng, 120)
    near = base.replace(base.split()[60], "changed", 1)
    long = sentence(rng, 30_000)
    texts = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n\x0b ", "de", "b"),
        (4, "One", "en", "a"),
        (5, "one two", "fr", "b"),
        (6, "ONE Two", None, None),
        (7, base, "en", "a"),
        (8, near, "en", "b"),
        (9, base.upper(), "en", None),
        (10, long, "de", "a"),
        (11, sentence(rng, 40) + "\nAll rights reserved.\nCC BY\n" + "same line\n" * 5, "es", "c"),
        (11, sentence(rng, 30), "es", "c"),
        (None, sentence(rng, 25), "en", "c"),
        (None, None, None, None),
        (12, "the of and " * 40, "en", "é"),
        (13, "x" * 5000, "en", "a"),
        (14, "1 2 3 !! ..", "en", "a"),
    ]
    rows = [(d, t, l, s, None, "w", 1, "k", "r", "l", 2, 3, 4, "i", 5, 6, 7, "h") for d, t, l, s in texts]
    return [*rows, rows[6], rows[6], rows[12]]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])
