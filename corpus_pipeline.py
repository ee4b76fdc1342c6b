"""Corpus pipeline: from documents to token files, in five stages.

Each stage works on all rows its predecessor kept. All but the last return the columns they get:

* toxicity: documents whose score reaches 0.3 go. Null and empty texts stay.
* near duplicates: of each class of documents linked by a Jaccard similarity of 0.8 of five-word
  shingles the one with the least id stays. Rows without an id stay.
* decontamination: documents that hold a benchmark item go.
* mixing: documents are repeated or cut to blocks so that sources reach their weights. Texts without
  words give nothing.
* token blocks: the ids of what is left are written as files, and read back.

SQL cannot express the models and the seeded choice, so there is no SQL for the whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm.common import stored, table
from tillstream.llm.decontamination import without_contaminated
from tillstream.llm.jaccard_join import one_of_each_class
from tillstream.llm.mixing import mixed_texts
from tillstream.llm.token_blocks import token_output
from tillstream.llm.toxicity import fit_toxicity, without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_class(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_texts(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_by_source),
    ("token_blocks", write_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
