"""Small awkward tables for the operators of the llm subpackage."""

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(n):
        w = "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
        out.append(w + (".\n" if k % 17 == 16 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and blank texts, one long text, copies, repeated rows, equal
    ids, a null id, a null source, and extra columns whose names operators use."""
    base = prose(1, 120)
    rows = [(1, base, "en", "a", None), (2, base, "en", "a", None), (2, base, "en", "a", None),
            (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\r\n ", "en", "b", 5),
            (6, prose(2, 30000), "en", "c", None), (7, base.replace("a", "e", 1), "en", "é", None),
            (8, "one", "en", None, 3), (9, prose(3, 60), "en", "", None), (9, prose(4, 61), "en", "a", None),
            (None, prose(5, 40), "en", "a", None), (20, "É́ \U0001f600 x <|endoftext|> ß", "de", "b", None)]
    return (spark.createDataFrame(rows, SCHEMA).repartition(3)
            .withColumn("score", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("row", F.lit(2))
            .withColumn("size", F.lit(3)).withColumn("label", F.lit("x")).withColumn("one", F.lit(4)))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
