import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, count string"


def _words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="session")
def rows_of_docs():
    """Small documents: copies, near copies, a shared passage, nulls, empty and very long texts, repeated rows."""
    r = random.Random(7)
    texts = [_words(r, r.randint(60, 120)) for _ in range(30)]
    near = texts[3].split(" ")
    near[10] = "other"
    passage = _words(r, 55)
    texts += [texts[0], texts[0], " ".join(near), " ".join([*near[:-1], "end"])]
    texts += [f"{_words(r, 20)} {passage}\n{_words(r, 30)}", f"{_words(r, 35)}\t{passage}", f"{passage} {passage}"]
    texts += [None, "", "  \n ", "few words", "Few  WORDS", "few", " é " * 40, _words(r, 40_000), "x" * 300_000, "a b c " * 200]
    sources, langs = ["web", "web", "book", None], ["en", None, "de"]
    rows = [(i, t, langs[i % 3], sources[i % 4], len(t) if t else None, None, "c") for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[-1], (None, texts[5], "en", "web", None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows_of_docs):
    return spark.createDataFrame(rows_of_docs, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
