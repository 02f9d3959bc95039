from __future__ import annotations

import random

import pytest

CLASHING = ("id th tk row w h k s sn q at size target source_size copies spans words line j template item item_id place seed "
            "node root rule host path verdict lang_pred score kept again first drop lines cleaned").split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int = 8) -> str:
    return " ".join("".join(rng.choice("abdegilmnorst") for _ in range(4)) for _ in range(n)).capitalize() + "."


def prose(rng: random.Random, n: int = 12) -> str:
    return " ".join(sentence(rng, rng.randrange(4, 14)) for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(3)
    copied, passage = prose(rng, 12), prose(rng, 9)
    rows = [(1, copied, "en", "b", 10), (2, copied, "en", None, None), (2, copied, "en", None, None), (3, None, None, None, None),
            (4, "", "en", "a", 0), (5, " \n\t ", "de", "a", 3), (6, "12 34 !", "en", "", 7), (None, prose(rng), "en", "b", 1),
            (None, None, None, "c", None), (7, "word", "en", "b", 4), (8, "one two three", None, "c", 13),
            (9, prose(rng, 3000), "en", "a", 9), (10, "x" * 40_000, "en", "a", 1), (11, "ab" * 300 + " ende", "de", "b", 1),
            (12, passage + "\n" + prose(rng), "en", "b", 1), (13, prose(rng) + "\n" + passage, "en", "a", 1),
            (12, prose(rng), "en", "b", 1), (14, "Grüße aus Köln: größer, schöner.\n" + prose(rng), "de", "ü", 1)]
    near = copied.split()
    near[20] = "changed"
    return [*rows, (15, " ".join(near), "en", "b", 1)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def edge_clashing(edge):
    """The same rows with more columns, named as the operators name theirs."""
    from pyspark.sql import functions as F

    return edge.select("*", *[F.lit(f"<{c}>").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def ordered():
    def rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return rows
