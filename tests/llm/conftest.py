from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, ids shared, clashing columns."""
    word = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor"
    rows = [
        Row(1, f"{word} alpha beta", "en", "a", 1),
        Row(1, f"{word} alpha beta", "en", "a", 1),
        Row(2, f"{word} alpha beta", None, None, None),
        Row(2, "other words under the same id, quite different from the first", "en", "b", 3),
        Row(3, None, "en", "a", 0),
        Row(4, "", None, "", 0),
        Row(5, " \t\n\r ", "en", "b", 5),
        Row(None, f"{word} alpha beta", "en", None, 2),
        Row(None, None, None, None, None),
        Row(6, f"{word} " * 5_000, "en", "a", 9),
        Row(7, "x" * 100_000, "en", "a", 9),
        Row(8, "é Σας 𝒳 +1 (555) 123-4567 mail a.b@c.de,", "el", "é", 9),
    ]
    # Names the operators use inside must not clash with those of the table.
    extra = {n: F.lit(1) for n in ("id", "body", "node", "key", "size", "line", "text_key", "sample_id", "score", "start", "whole", "shard", "word")}
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA).withColumns(extra)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
