import random

import pytest

WORDS = "the of and stone river light under green water house tree wind night walk open hill field road bird song".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed", "er", "ly", "an", "or"]) for _ in range(n))


@pytest.fixture(scope="session")
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, shared passages, short, empty and null ones, by id."""
    r = random.Random(3)
    shared = prose(r, 40)
    texts: list[str | None] = [None, "", "   ", "one two", "one two", "x", "the the the the the the the the the"]
    for _ in range(25):
        t = prose(r, r.randint(20, 120))
        texts.append(t)
        if r.random() < 0.5:
            texts.append(t)
        for _ in range(r.randint(0, 4)):
            w = t.split()
            for _ in range(r.randint(1, 6)):
                w[r.randrange(len(w))] = r.choice(["zig", "zag", "zog"])
            texts.append(" ".join(w))
        if r.random() < 0.4:
            texts.append(prose(r, r.randint(5, 30)) + " " + shared + " " + prose(r, r.randint(5, 30)))
    texts += ["ab" * 200, "é" * 120 + "xyz", "ab" * 130 + "c", prose(r, 4000)]
    return {3 * i + 1: t for i, t in enumerate(texts)}


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), "extra") for i, t in corpus.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, z string").repartition(3)
