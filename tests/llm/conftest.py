import re

import pytest

from playback_qos.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, id string, block int, row long, path long, n_words string, kept string, term string, shard int, rest string"
)


def words(text):
    return re.findall(r"[^ \t-\r]+", text or "")


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="session")
def rows(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows and ties; columns with names the operators use."""
    base = " ".join(f"word{i}" for i in range(60))
    long = " ".join(f"w{i % 977}" for i in range(30_000)) + " " + "x" * 20_000
    texts = [
        (1, base), (1, base), (2, base), (None, base), (3, None), (4, ""), (5, " \n\t "), (6, "###"), (7, long),
        (8, "one two"), (9, "one two"), (None, None), (10, base + " tail"), (11, "a@b.co +1 234 567 890 1.2.3.4 4111 1111 1111 1111"),
        (12, "äöü ▁ \x00 ß x 日本"), (13, "same\nsame\n\nsame"),
    ]
    data = [(i, t, "en" if k % 3 else None, "s" if k % 4 else None, None, "k", None, 1, None, 2, "n", "t", None, 3, "r")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
