import random

import pytest
from llm_rows import make, words


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    long = words(rng, 60_000, 5_000)
    one = words(rng, 80)
    return [(1, None, None, None), (2, "", "en", "src1"), (3, " \n\t ", "", ""), (4, long, "en", "src1"), (5, one, "de", "src2"),
            (5, one, "de", "src2"), (6, one, "de", None), (None, one, "en", "src1"), (None, words(rng, 70), None, "src2"), (7, "Éa\n\nb", "fr", "src3"),
            (8, "a", "en", "src1"), (9, long + " tail", "en", "src1"), (10, one + " x", "de", "src2")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return make(spark, odd_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, []).cache()
