import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, _id string, size string, "
          "spans string, score string, block string, key string, sig string, `flag` string")


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows, repeated ids."""
    long = " ".join(words(1, 20_000, 5000))
    base = " ".join(words(2, 60))
    near = base.replace(base.split()[30], "changed")
    passage = " ".join(words(3, 30))
    texts = [
        (0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one two  three\nfour"), (5, base), (6, base), (7, near),
        (8, "start of it " + passage + " and an end"), (9, "other start " + passage), (10, long), (11, "x"),
        (12, passage + " " + passage), (13, "é ß 中文 \x85   <|endoftext|> 😀"), (5, base), (5, "another text of five"),
        (None, "no id but words " + passage), (None, None), (14, "i d i o t . - ! ?"), (15, "a" * 5000),
    ]
    return [(i, t, "en" if (i or 0) % 2 else None, None if (i or 1) % 5 == 0 else f"s{(i or 0) % 3}", None if t is None else len(t),
             "a", None, "b", "c", "d", "e", "f", "g", "h") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):  # noqa: F811
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):  # noqa: F811
    return spark.createDataFrame([], SCHEMA)
