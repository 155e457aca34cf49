import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, ties, repeated rows, copies, a long text, characters of several bytes."""
    rng = random.Random(4)
    base = words(rng, 120)
    passage = words(rng, 60)
    rows = [(1, base, "xx", "a", 1), (2, base, "xx", "a", 1), (3, base.replace(" ", "  ", 5), "xx", "b", 1), (4, None, None, None, None), (5, "", "xx", "", 0)]
    rows += [(6, "one two", None, "a", 7), (7, "ONE two", "yy", "a", 7), (8, "1 2 3 4 5 6", "yy", "b", 11), (9, "é" * 150 + " ñandú ß 日本語 " + "é" * 150, "yy", "c", 1)]
    rows += [(10 + i, words(rng, 40) + "\n" + passage + ". " + words(rng, 30), "xx", rng.choice("abc"), 1) for i in range(12)]
    edited = base.split()
    for i in range(22, 34):
        e = list(edited)
        e[rng.randrange(len(e))] = "edit%d" % i
        rows.append((i, " ".join(e), "xx", "a", 1))
    rows.append((40, words(rng, 9000), "yy", "c", 1))
    rows += [(41, "la " * 400, "yy", None, 1), (42, "x" * 5000, "yy", None, 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
