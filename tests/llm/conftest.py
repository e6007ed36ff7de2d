import random

import pytest
from pyspark.sql import types as T

#: Names that the operators use inside, as columns of the input.
CLASHING = "id salt key at n h1 h2 row range side term token size target taken keep kept digest norm bucket starts lines group copy info carried _size _key"

WORDS = "the of and to in is that for was on with as by at from this have not are but had his they she which you one we all were her would there been their".split()


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text, lang, source) rows, with clashing columns."""

    def build(rows, clash=True):
        schema = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string").add("source", "string").add("n_chars", "long")
        full = [(*row, *[None] * (4 - len(row)), None if row[1] is None else len(row[1])) for row in rows]
        df = spark.createDataFrame(full, schema)
        if clash:
            df = df.selectExpr("*", *[f"cast(7 as int) as {name}" for name in CLASHING.split()])
        return df.repartition(3)

    return build


@pytest.fixture(scope="session")
def prose():
    """Texts of random words, with passages, copies and near copies among them."""

    def build(seed=0, n=60, words=120):
        rng = random.Random(seed)
        vocabulary = WORDS + [f"{a}{b}" for a in WORDS for b in WORDS]
        passages = [[rng.choice(vocabulary) for _ in range(rng.choice((49, 50, 51, 80)))] for _ in range(4)]
        texts = []
        for i in range(n):
            text = [rng.choice(vocabulary) for _ in range(rng.randint(1, words))]
            if i % 3 == 0:
                at = rng.randint(0, len(text))
                text[at:at] = rng.choice(passages)
            if i % 7 == 6:
                text = list(rng.choice(texts))
                if i % 2 and text:
                    text[rng.randrange(len(text))] = "changed"
            texts.append(text)
        seps = (" ", "\n", "  ", " \t")
        return ["".join(w + rng.choice(seps) for w in t) for t in texts]

    return build


MESSY = [
    (5, None),
    (6, ""),
    (7, " \t\n "),
    (None, "a text without an id, and some words more to make it long enough " * 9),
    (None, "a text without an id, and some words more to make it long enough " * 9),
    (8, "same row twice same row twice " * 20),
    (8, "same row twice same row twice " * 20),
    (9, "one id two texts " * 30),
    (9, "another text with that id " * 30),
    (10, "Ünïcode   ÀÉ 漢字 😀 words " * 25),
    (11, "x" * 300_000 + " " + "long words and many of them " * 20_000),
    (3, "same row twice same row twice " * 20),
    (-4, "one id two texts " * 30 + "tail"),
    (12, "<|endoftext|> 123 http://x.y/z?q=1#f"),
]


@pytest.fixture(scope="session")
def messy():
    return MESSY
