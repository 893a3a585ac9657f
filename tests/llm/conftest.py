import random

import pytest

#: Word list for small corpora.
VOCAB = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "ki", "lo", "mu", "ne") for b in ("r", "st", "l", "nd", "x", "m", "")]


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, other columns with clashing names."""
    r = random.Random(11)
    words = lambda n: " ".join(r.choice(VOCAB) for _ in range(n))
    line = words(30)
    long = "\n".join(words(20) for _ in range(400))
    near = words(60)
    rows = [(1, line + "\n" + words(12), "aa"), (1, line + "\n" + words(9), "aa"), (2, "", "bb"), (3, None, None), (4, long, "aa"),
            (4, long, "aa"), (5, near, None), (6, near.rsplit(" ", 1)[0] + " zzz", "aa"), (None, line, "bb"), (7, "!!! ???", "bb"),
            (8, "Ünï Ñandú 日本語 " + line.upper(), "bb"), (9, " \n\t\n", None), (10, "it's <|endoftext|> we'll\r\n  x", "cc")]
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), 1, 2, 3.0, "x") for i, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score int, row int, id double, block string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")
