import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, key string, mix string, n_words long"


def make(seed=5, n=120):
    """Rows with copies, near copies, shared passages, repeats, nulls, empties, one long text, repeated
    rows, and extra columns whose names operators use themselves."""
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "Pe", "ra", "so") for b in ("ta", "ve", "wi", "xo", "yu", "za", "é", "")]
    passage = [rng.choice(vocab) for _ in range(60)]
    line = "All rights reserved by the owner"
    texts = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 20, 80, 200]))]
        if i % 9 == 1:
            at = rng.randrange(len(w))
            w[at:at] = passage
        if i % 13 == 2:
            w = w[:12] * 6
        text = ""
        for j, x in enumerate(w):
            text += x + ("\n" if j % 11 == 10 else "  " if j % 17 == 3 else " ")
        texts.append(text + (f"\n{line}\n" if i % 4 == 0 else ""))
    texts[10] = texts[11] = texts[12]
    texts[20] = texts[19].replace("ka", "KA", 1)
    texts[30:34] = [None, "", " \t\n\x0b\x0c\r", "One"]
    texts[40] = " ".join(rng.choice(vocab) for _ in range(30_000))
    texts[41] = "same " * 300
    rows = [(i, t, None if i % 10 == 3 else "en", None if i % 15 == 4 else f"s{min(i % 6, 3)}", len(t or ""), i, "k", "m", 1) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def odd(spark, rows, tmp_path_factory):
    """The rows again, one twice and two without an id."""
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    more = [rows[5], (None, *rows[7][1:]), (None, *rows[12][1:])]
    spark.createDataFrame([*rows, *more], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
