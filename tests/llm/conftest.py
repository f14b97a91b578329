import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch(spark, tmp_path_factory):
    from demandflow.llm.common import Scratch
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return Scratch(spark, "tests")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing column names."""
    rng = random.Random(5)
    long = prose(rng, 30_000, 20_000)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Single"), (5, long), (5, long), (6, long + " tail"), (None, "no id at all here"),
            (7, "A\x0bb C\x1cd Ünï"), (8, "a\x0bB c\x1cd Ünï"), (9, "one two three four five six"), (9, "another text of the same id")]
    rows = [(i, t, "x", k, "y") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, n long, sid string")
