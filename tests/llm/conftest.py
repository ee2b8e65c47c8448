import random

import pytest

SYLLABLES = "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture()
def make_text():
    """Texts of so many words, in lines of at most ten, the same for a seed."""
    def build(seed, n):
        made = words(random.Random(seed), n)
        return "\n".join(" ".join(made[k:k + 10]) + "." for k in range(0, n, 10))

    return build


@pytest.fixture()
def edge_docs(spark, make_text):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    long = make_text(99, 40_000) + " " + "x" * 60_000
    rows = [
        (1, make_text(1, 120), "a", "p", 1), (2, None, "b", None, None), (3, "", None, "q", 3), (None, make_text(4, 60), "c", "r", 4),
        (5, make_text(5, 80), "d", "s", 5), (5, make_text(5, 80), "d", "s", 5), (6, long, None, None, 6), (7, " \n \t\x0b ", "e", "t", 7),
        (8, "é 日本語 🎉 <|endoftext|> a  b c\n\n", "f", "u", 8),
    ]
    schema = "doc_id bigint, text string, Score string, ids string, n_words bigint"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture()
def no_docs(edge_docs):
    return edge_docs.where("false")
