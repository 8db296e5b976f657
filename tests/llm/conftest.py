"""Documents with every oddity, and words to write random ones with."""

import random

import pytest

ODD_TEXTS = [None, "", "   \n\t", "a", "A a", "one two three four", "x" * 40_000, "w " * 30_000, "line\n" * 30, "é你😀 \x00 ﬁ",
             "same words here for all of them to see", "same words here for all of them to see", "a.b@c.d @ 1.2.3.4.5 +49",
             " no break ", "▁ ▁▁x", "0" * 5_000, "end."]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts, NULL and repeated rows, and extra columns named like what operators add."""
    rows = [(i, text, "en" if i % 3 else None, "s", 1.5, "x", [1], i) for i, text in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[10], (None, "no id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    clashing = ("id", "n", "n_words", "base", "label", "key", "component", "features", "held")
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, score double, kept string, ids array<int>, n_chars int"
    ).selectExpr("*", *[f"source AS {name}" for name in clashing])


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def texts():
    """Random texts of few words, some with punctuation and some repeated."""
    rng = random.Random(7)
    words = ["the", "of", "And", "river", "stone", "blue", "a", "to", "walk,", "end.", "Über", "x1", "re-do", "A", "sky"]
    out = []
    for i in range(120):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))
        out.append(text if i % 5 else text.replace(" ", "\n", 3))
    for i in range(0, 60, 3):
        parts = out[i].split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        out.append(" ".join(parts))
    return out + [out[5], out[7], out[7]]


@pytest.fixture(scope="session")
def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr(
        "*", "if(doc_id % 2 = 0, 'en', 'de') AS lang", "'s' AS source", "length(text) AS n_chars")
