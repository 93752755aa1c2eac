import random

import pytest

#: Rows that every operator on documents has to take: nulls, empty and blank texts, ties, repeated rows,
#: a long text, columns with names that operators use themselves.
HARD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, start long, rank int, row long, score double"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def hard_rows():
    rng = random.Random(11)
    base = " ".join(words(rng, 60, 5000))
    texts = [None, "", " ", "\n\n", "one", "one", "one two three", base, base, base + " end", "é́ 日本  x",
             "<|endoftext|> </s> <s>", "\n".join(" ".join(words(rng, 9)) for _ in range(30)), " ".join(words(rng, 20000))]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(texts)]
    rows += [(7, base, "en", "s1"), (7, base, "en", "s1"), (None, base, "en", "s1"), (None, None, None, None), (2, "other words", "en", "s2")]
    return [(*r, 1, 2, 3, 4, 5, 0.5) for r in rows]


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), HARD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], HARD_SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
