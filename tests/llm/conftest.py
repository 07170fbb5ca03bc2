import random

import pytest
from pyspark.sql import types as T

#: Documents as every operator may meet them: nulls in any column, empty, repeated, one very long.
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that clash with columns the operators make
    T.StructField("id", T.StringType()), T.StructField("h", T.LongType()), T.StructField("key", T.LongType()), T.StructField("score", T.StringType()),
])


def sentence(k: int, words: int = 30) -> str:
    dice = random.Random(k)
    stems = "ba ce di fo gu ha je ki lo mu na pe qi ro su ta ve wi xo yu".split()
    return " ".join("".join(dice.choices(stems, k=3)) for _ in range(words)) + "."


@pytest.fixture(scope="session")
def odd_documents(spark):
    long = "\n".join(sentence(1000 + k, 40) for k in range(900))
    rows = [
        (1, None, None, None), (2, "", "xx", "a"), (3, " \n\t ", "xx", "a"), (4, sentence(1), "xx", "a"), (4, sentence(1), "xx", "a"),
        (None, sentence(2), "yy", None), (None, None, None, "b"), (5, long, "yy", "b"), (6, "é" * 500, "yy", "b"), (7, "12 % 34", None, "b"),
        (2**60 + 1, "Straße 'tis o'clock 北京 😀 ²³ İ", "yy", "b"), (8, "a " * 3000, "xx", "a"), (4, "other text under a used id", "xx", "a"),
    ]
    full = [(i, t, lang, s, None if t is None else len(t), "x", 1, 2, "y") for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (4, 1, 1), (4, 0, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (7, 1, 0), (99, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality bigint, toxic bigint")
