import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHING = ("mark", "row", "node", "group", "bucket", "slot", "shard", "core", "words", "found", "_id", "_mark", "g", "kept")


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents frame of (doc_id, text[, lang, source]) rows, with columns whose names clash."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "src")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])

    return make


def sentence(rng, n, words=None):
    words = words or [a + b for a in "bcdfglmnprst" for b in ("a", "en", "ir", "ost", "ung", "é")]
    return " ".join(rng.choice(words) + rng.choice(["", "", "", "an", "ers"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts of all kinds: plain, copies, near copies, shared passages, short, empty, null, repeated rows, one very long."""
    rng = random.Random(11)
    passage = sentence(rng, 90)
    rows = [(i, sentence(rng, rng.randint(60, 160)), rng.choice(["en", "de"]), rng.choice(["a", "b", None])) for i in range(40)]
    for i in range(40, 52):  # near copies with more and more edits, so that links form chains
        words = rows[3][1].split()
        for _ in range((i - 39) // 2):
            words[rng.randrange(len(words))] = "edit" + str(rng.randrange(99))
        rows.append((i, " ".join(words), "en", "a"))
    for i in range(52, 60):
        rows.append((i, sentence(rng, 20) + " " + passage + " " + sentence(rng, rng.randint(1, 30)), "de", "b"))
    rows += [(60, rows[5][1], "en", "a"), (61, rows[5][1], "en", "b"), (61, rows[5][1], "en", "b")]
    rows += [(62, "two words", "en", "a"), (63, "two words", "en", "a"), (64, "one", None, None), (65, "", "en", "a"), (66, None, "en", None)]
    rows += [(None, sentence(rng, 70), "en", "a"), (None, None, None, None), (67, " \t\n\x0b ", "en", "a"), (68, "ß ÉÈ 日本 \U0001f600 " * 60, "xx", "a")]
    rows += [(69, sentence(rng, 12_000), "en", "a"), (70, "a" * 3000, "en", "a"), (71, "a" * 2000, "en", "a"), (72, sentence(rng, 80) + "\n" + sentence(rng, 3), "en", "a")]
    return rows


@pytest.fixture(scope="session")
def make_sentence():
    return sentence
