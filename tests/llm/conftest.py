import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # names that the operators could have chosen themselves
    "doc string, row bigint, key string, size bigint, draw bigint, token string, block int, identity int, n int, _text string"
)
EXTRA = ("x", 1, "k", 2, 3, "t", 4, 5, 6, "u")
WORDS = "the of and stone river light under winter garden letter paper morning window silver answer quiet".split()


def sentence(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(words))


def edge_rows():
    """NULLs in every column, empty, blank and very long texts, ties, repeated rows, near copies, odd characters."""
    base = sentence(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        (1, base, "en", "a"),
        (2, base, "en", None),
        (2, base, "en", None),
        (3, " ".join(near), "en", "a"),
        (4, base.upper(), "de", "b"),
        (5, "", "de", "b"),
        (6, None, None, None),
        (None, None, None, "c"),
        (None, base, None, "c"),
        (7, "one two three", "en", "a"),
        (8, "ONE two three", "en", "a"),
        (9, "   \t\n ", None, "a"),
        (10, "12345 !!", "en", "c"),
        (11, "Straße Σίσυφος İ ﬁ 中文 🙂 it's <|endoftext|> we'll", "de", "d"),
        (12, sentence(2, 30000), "en", "a"),
        (13, "tick " * 400, "en", "a"),
        (14, sentence(3, 60) + " " + sentence(4, 80), "fr", "b"),
        (15, sentence(5, 70) + " " + sentence(4, 80), "fr", "b"),
        (16, "x" * 450, "fr", "d"),
    ]
    return [(i, t, lang, source, None if t is None else len(t), *EXTRA) for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
