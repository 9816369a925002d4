import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, ids string, n_words int, score double, kept string"


def prose(seed, n, words=None):
    r = random.Random(seed)
    words = words or [
        "the",
        "river",
        "stone",
        "walks",
        "over",
        "quiet",
        "hill",
        "and",
        "sings",
        "with",
        "green",
        "light",
        "before",
        "morning",
        "comes",
        "again",
    ]
    return " ".join(r.choice(words) for _ in range(n)) + "."


@pytest.fixture(scope="session")
def docs(spark):
    """Null, empty, blank, odd and very long texts, repeats of rows and ids, columns named like results."""
    base = prose(1, 120)
    rows = [
        (1, base),
        (2, base),
        (3, base + " end"),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, "ab"),
        (8, prose(2, 5000)),
        (9, "漢字 かな 😀 ▁ mark"),
        (10, "x" * 60000),
        (11, prose(3, 80)),
        (11, prose(3, 80)),
        (None, prose(4, 70)),
        (12, "of%%% the*** and### " * 40),
        (13, prose(5, 90) + "\n" + prose(5, 90)),
        (14, "a  b\tc\n\nd   e <|endoftext|>"),
        (15, "Line one\nLine one\n\nLine one\nline one"),
    ]
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", 1, 0.5, "z") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
