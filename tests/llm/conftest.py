import random

import pytest

from punctum.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named as results of the operators are.
CLASHES = "fingerprint string, component_id long, score double, spans string, size long, row long, copy int, word string, node long, n_words long, text_key long"


def prose(words: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 7))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows, equal texts of other ids."""
    long, plain = prose(60_000, 1), prose(120, 2)
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n ", "en", "s", 4), (None, plain, "en", "s", 1), (None, None, None, None, None),
        (4, long, "en", "t", 1), (5, plain, "en", None, 1), (6, plain, "de", "s", 1), (6, plain, "de", "s", 1), (7, plain.upper(), "de", "t", 1),
        (8, "x" * 300_000, "fr", "t", 1), (9, "a", "fr", "", 1), (10, "É ß ü 中文 \U0001f600", None, "u", 1), (11, "!!! 123", "fr", "u", 1),
    ]
    return rows + [(100 + n, prose(50 + n, 10 + n), "en", "s", 1) for n in range(12)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, odd):
    extra = spark.createDataFrame([], CLASHES)
    return odd.unionByName(extra.limit(0), allowMissingColumns=True)


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="session")
def benchmark(spark):
    return table(spark, SF, "benchmark")


@pytest.fixture(scope="session")
def labels(spark):
    return table(spark, SF, "labels")


@pytest.fixture
def many_ranges(spark):
    """Small tables stay in as many partitions as a shuffle has."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
