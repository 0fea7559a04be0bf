import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    def build(texts, schema=DOCUMENT, **more):
        """Documents from texts, or from (doc_id, text, source) rows."""
        rows = [t if isinstance(t, tuple) else (i, t, f"s{i % 4}") for i, t in enumerate(texts)]
        rows = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
        return spark.createDataFrame(rows, schema).repartition(5)
    return build


def prose(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, repeats, nulls, blanks and a long document."""
    rng = random.Random(7)
    lines = [" ".join(prose(rng, rng.choice([9, 14, 60]))) for _ in range(12)]
    texts = []
    for _ in range(60):
        body = [" ".join(prose(rng, rng.randrange(3, 70))) for _ in range(rng.randrange(1, 7))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = lines[(k := rng.randrange(len(lines))):k + rng.randrange(1, 5)]
        texts.append("\n".join(body))
    for k in range(0, 40, 2):
        words = texts[k].split(" ")
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = "Edited"
        texts.append(" ".join(words))
    family = prose(rng, 120)
    for _ in range(80):
        copy = list(family)
        for _ in range(rng.randrange(1, 5)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10 ** 6)}"
        texts.append(" ".join(copy))
    texts += texts[:7] + [texts[3]] * 9
    texts += ["", None, " \t\n", "one", "one", "ONE", "a b c d", "A b C d", "\n\nx\n", None,
              "\n".join(["same line of words here"] * 40), " ".join(prose(rng, 30000, 50000)),
              "é à ü ß " * 20, "x" * 50_000]
    return texts
