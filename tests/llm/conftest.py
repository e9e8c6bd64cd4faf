import random

import pytest

WORDS = "the of eaner thnt on in ouble rest ing a and thion erly wh heon stea".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, n_tokens long, digest string, score double, domain string, grp string, value string"
)


def prose(seed, n):
    """``n`` words in sentences and lines."""
    chance = random.Random(seed)
    words = [chance.choice(WORDS) + chance.choice(["", "", "", "n", "ed", "es"]) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") + ("\n" if i % 40 == 39 else "") for i, w in enumerate(words))


def row(key, text, lang="en", source="src1"):
    return (key, text, lang, source, None if text is None else len(text), 1, 2, "d", 0.5, "x", "g", "v")


@pytest.fixture(scope="session")
def edge_rows():
    """NULL in every column, empty and long texts, ties, repeated rows, names that operators use themselves."""
    long_text = prose(1, 12_000)
    return [
        row(1, None, None, None),
        row(2, ""),
        row(3, " \n\t "),
        row(4, "word"),
        row(5, prose(5, 80)),
        row(5, prose(5, 80)),
        row(6, prose(5, 80)),
        row(7, long_text),
        row(8, long_text + " tail"),
        row(9, "x" * 5000),
        row(10, prose(10, 120).upper().replace(" ", "!! ")),
        row(11, "naïve café ŒUVRE Straße 中文 😀 <|endoftext|> it's 12 3  4\x00"),
        (None, prose(12, 60), None, "src2", None, None, None, None, None, None, None, None),
        *[row(20 + i, prose(100 + i, 60 + i), "de" if i % 3 else "fr", f"src{i % 4}") for i in range(12)],
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
