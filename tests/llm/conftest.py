import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, source) rows."""
    return lambda rows: _frame(spark, rows)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties, copies and repeated rows."""
    deal = random.Random(5)
    words = [f"w{i}é" for i in range(60)]
    passage = " ".join(deal.choices(words, k=55))
    text = lambda n: " ".join(deal.choices(words, k=n))
    rows = [
        (None, None, None), (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, "one", "b"),
        (6, "x " * 5000, "b"), (7, text(20000), "c"), (8, passage, "a"), (9, f"{text(30)}\n{passage}\n{text(30)}", "a"),
        (10, f"{passage}\n{text(5)}", None), (11, passage, "c"), (12, "same line\nnext line\nlast", "a"),
        (13, "head\nsame line\nnext line\n\nlast", "a"), (13, "head\nsame line\nnext line\n\nlast", "a"),
        (15, "ÄÖ   wide \U0001f984 end", "b"), (16, "y" * 50000, "b"), (-3, passage + " tail", "d"),
    ]
    near = text(400).split()
    for k in range(6):
        near[k * 7] = "changed"
        rows.append((100 + k, " ".join(near), "hot"))
    return rows + [(200 + k, passage, "hot") for k in range(40)]


@pytest.fixture(scope="session")
def odd(frame, odd_rows):
    return frame(odd_rows)


@pytest.fixture(scope="session")
def clash(odd):
    """The same rows with columns that carry the names used inside the operators."""
    from pyspark.sql import functions as F

    names = "d t h q s size position copies label x print component node hi lo _id _key _doc _gone _size _n copy n_lines bucket"
    return odd.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names.split())])
