import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and river stone window carries quiet morning letter garden seven bright table under because house paper".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (".\n" if r.random() < 0.08 else "") for _ in range(n))


def edge_rows():
    """Nulls, empty and very long texts, repeated rows and ids, near copies; columns with clashing names."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "src1"), (2, base, "en", "src0"), (3, base + " tail", "en", None), (4, None, "en", "src0"), (5, "", None, "src7"),
        (6, "one", "de", "src19"), (7, "a\tb  c\n\nd", "xx", "web"), (8, prose(2, 200_000), "en", "src0"), (9, "é" * 5_000, "fr", "src3"),
        (9, prose(3, 60), "fr", "src3"), (10, prose(4, 60), "en", "src0"), (10, prose(4, 60), "en", "src0"), (None, prose(5, 60), "en", "src2"),
        (None, None, None, None), (300, "x " * 80, "en", "src0"), (700, prose(6, 90) + "\npassword = 'hunter2x9'", "en", "src0"), (-5, " \n\t ", "en", "src0"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "extra", 1) for i, t, lang, s in rows]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, rules string, slice int"


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "toxic", F.col("quality").alias("good"))
