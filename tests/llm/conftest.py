import random

import pytest

from tidemark.session import ship

#: Columns of documents, and more that share the names of working columns.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "row string, h bigint, size int, words string, node bigint, kept boolean, label string, normal string, block int"
)


def extra(i):
    return (f"row{i}", i, i, "w", i, False, "l", "n", i)


def prose(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows, near copies."""
    rng = random.Random(5)
    base = [prose(rng, 80) for _ in range(6)]
    near = base[0].split()
    near[40] = "changed"
    rows = [
        (1, base[0], "en", "a"),
        (2, base[0].upper(), "en", "a"),
        (3, " ".join(near), "en", "b"),
        (4, None, "en", "a"),
        (5, "", "en", "a"),
        (6, " \t\n\x0b\f\r ", "en", None),
        (7, "one", None, "a"),
        (8, "one two", None, None),
        (9, "ÄÖ é ǅ 日本 🙂 " + base[1], "de", "ä"),
        (10, base[1].replace(" ", "\n"), "de", "Z"),
        (11, prose(rng, 60_000), "en", "a"),
        (12, "x" * 300_000, "en", "b"),
        (13, "same words again and over \n" * 40, "en", "b"),
        (14, base[2] + "\n" + base[2], "en", None),
        (15, base[3], "en", "a"),
        (15, base[3], "en", "a"),
        (16, base[3], "en", "a"),
        (None, base[4], "en", "a"),
        (17, base[4], "en", "a"),
        (None, None, None, None),
        (18, 'password: "hunter22" AKIA' + "Z" * 16 + " " + "0a" * 20 + " it's 'tis <|endoftext|> | ##", "en", "c"),
        (19, " no break\u0085 here\x1c and\x00 null " + base[5], "fr", "c"),
    ]
    return [(d, t, g, s, None if t is None else len(t), *extra(i)) for i, (d, t, g, s) in enumerate(rows)]


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(shipped):
    return shipped.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(shipped):
    return shipped.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(shipped):
    """Documents from (id, text) or (id, text, lang, source)."""

    def rows(pairs):
        full = [(*p, *(None, None)[len(p) - 2 :]) if len(p) < 4 else p for p in pairs]
        return shipped.createDataFrame(full, "doc_id bigint, text string, lang string, source string").repartition(3)

    return rows
