import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, unit int, bucket string, row long"
VOCABULARY = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows,
    ids that do not start at 0, and columns named like the operators' own."""
    rng = random.Random(5)
    texts = [None, "", " \t\r\n", "one", "One two", "one two three", "é ñ 漢字  x", "a\nb\n\nc", prose(rng, 4000)]
    long = prose(rng, 120)
    texts += [long, long, long.replace(" ", "\n", 7), long + " tail", prose(rng, 30) + " " + long[:300] + " " + prose(rng, 30)]
    base = prose(rng, 90).split()
    for k in range(12):
        some = list(base)
        for _ in range(k // 3):
            some[rng.randrange(len(some))] = "changed"
        texts.append(" ".join(some))
    texts += ["\n".join(prose(rng, 3) for _ in range(30)) for _ in range(6)]
    texts += [texts[-1] + "\n" + texts[-2], "x" * 5000, "<|im_start|> </s> \\<s> [INST]"]
    out = [(10 + 3 * i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None, None, "b", 1) for i, t in enumerate(texts)]
    return out + [out[9], out[9], (None, long, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table(spark, sf):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
