import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)).capitalize() + "."


def text(rng, sentences):
    return " ".join(sentence(rng, rng.randrange(4, 14)) for _ in range(sentences))


def edge_rows():
    """Nulls in every column, empty, blank, short and very long texts, copies, repeated rows."""
    rng = random.Random(5)
    base = text(rng, 20)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    passage = text(rng, 9)
    long = "\n".join(text(rng, 10) for _ in range(400))
    return [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "en", "a", 1), (4, text(rng, 15), "de", "b", 1), (5, None, "en", "b", None), (6, "", "en", None, 0),
        (7, " \t\n", None, "b", 3), (8, "one two three", "en", "b", 1), (9, "one two three", "en", "b", 1), (10, long, "fr", "c", 1), (11, text(rng, 3) + "\n" + passage + "\n" + text(rng, 4), "fr", "c", 1),
        (12, text(rng, 6) + "\n" + passage, "fr", "c", 1), (None, base, "en", "a", 1), (None, None, None, None, None), (4, None, "de", "b", 1), (13, "é ü 日本語 \U0001f600 <|endoftext|> it's", "es", "d", 1),
        (13, "é ü 日本語 \U0001f600 <|endoftext|> it's", "es", "d", 1), (14, "x" * 5000, "es", "d", 1),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(edges):
    """The edge rows with further columns whose names operators use inside."""
    from pyspark.sql import functions as F

    names = ["id", "h", "k", "row", "cell", "_row", "_text", "_id", "text_id", "n_tokens", "ids", "score", "kept", "_leak", "g0", "n_removed", "size", "shard", "a b"]
    return edges.select("*", *[F.lit(7).alias(n) for n in names])


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
