import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from ferrylane.llm.common import prepare  # noqa: E402

WORDS = "the quick brown fox jumps over a lazy dog while rain falls on old roofs and nobody minds at all".split()
LONG = " ".join(f"{w}{i % 97}" for i in range(3000) for w in WORDS[:2])

#: Nulls in every column, empty and very long texts, ties, repeated rows and ids, odd white space.
MESSY = [
    (1, " ".join(WORDS), "en", "a"),
    (2, " ".join(WORDS).upper(), "en", "a"),
    (3, " ".join(WORDS[:-1] + ["each"]), "en", "b"),
    (4, "", "en", None),
    (5, None, None, "b"),
    (6, " \t\n ", "fr", "a"),
    (7, LONG, "en", "b"),
    (8, LONG + " end", "en", "b"),
    (9, "three words only", "en", "c"),
    (10, "Three  words\tonly", "en", "c"),
    (11, "éÉ ▁ 🙂 \u0000 İstanbul ſ K", "tr", "c"),
    (12, "x" * 5000, "en", "a"),
    (13, "<|endoftext|> a  b <|startoftext|>", "en", "a"),
    (14, "line one\n\nline two  \n", "en", "a"),
    (9, "three words only", "en", "c"),
    (1, "another text under a known id", "en", "a"),
    (None, "no id at all but enough words here", "en", "a"),
    (None, None, None, None),
    (-3, "negative ids are ids as well", "de", "a"),
]


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def messy(llm):
    """The rows above, with columns that the operators would like to use themselves."""
    df = llm.createDataFrame(MESSY, "doc_id long, text string, lang string, source string")
    return df.withColumns({name: F.lit("mine") for name in (
        "digest", "maybe", "copy", "Shuffle_Key", "secrets", "pieces", "score", "offending", "keep_id", "drop_id", "n", "content", "rate")})


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def path_of():
    return public_tokenizers.path


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=repr)


@pytest.fixture(scope="session")
def rows_of():
    return rows
