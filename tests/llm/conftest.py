import random

import pytest

# Names that operators use inside must not clash with columns that come with the documents.
EXTRA = "row string, sha string, copy int, batch int, block int, part int, component string, digest string, score double"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows ``(doc_id, text)`` as documents with further columns of clashing names."""

    def make(rows):
        values = [(i, t, None, "x", 7, None, 3, 1, "c", None, 0.5) for i, t in rows]
        return spark.createDataFrame(values, f"doc_id bigint, text string, {EXTRA}")

    return make


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows with absent ids and texts, empty, very short and very long texts, copies, near copies and repeats."""
    rng = random.Random(3)
    base = [sentence(rng, n) for n in (60, 60, 80, 120, 7, 4, 3)]
    rows = list(enumerate(base))
    rows += [(10, base[0]), (11, base[0].upper()), (12, base[0]), (12, base[0])]  # copies and a repeated row
    for i in range(20, 26):  # near copies: one word of 120 changed
        words = base[3].split(" ")
        words[rng.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(words)))
    rows += [(30, " ".join(base[3].split(" ")[:100])), (31, base[5] + "\n"), (32, base[5].replace(" ", "\t"))]
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, "é ü \U0001f600 日本"), (44, " a b"), (44, "other text of one id")]
    rows += [(None, base[1]), (None, None), (None, "no id here"), (50, sentence(rng, 30_000, 5_000))]
    return rows
