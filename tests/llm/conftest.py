import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, copy int, fp string, root int, "
    "_id int, _copy string, _score int, _doc int, _places int, _removed int, _leaks int, key string, place int, line string"
)
EXTRA = ("x", 1, "f", 2, 3, "c", 4, 5, 6, 7, 8, "k", 9, "l")


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append("w" + "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 7))) + str(rng.randrange(vocabulary) % 7))
        if i % 12 == 11:
            out.append("\n")
    return " ".join(out).replace(" \n ", "\n")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long_text = prose(1, 60_000)
    texts = [
        (1, prose(2, 80), "en", "a"),
        (1, prose(2, 80), "en", "a"),
        (2, prose(2, 80), "en", "b"),
        (3, "", "en", "a"),
        (4, " \t\n ", "de", "a"),
        (5, None, "de", None),
        (None, prose(3, 60), None, "a"),
        (None, None, None, None),
        (6, long_text, "en", "b"),
        (1, prose(4, 70), "en", "a"),
        (7, "é ü \x0b x\x85y", "fr", "é"),
    ]
    return [(i, t, g, s, None if t is None else len(t), *EXTRA) for i, t, g, s in texts]


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
