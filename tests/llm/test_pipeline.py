"""The queries of the operators and the pipeline as the entry point names them."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tillstream.llm import queries
from verification.compare import connect, rows_of

from .conftest import FOLDER


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_equals_sql(spark, name):
    frame = queries.all_queries()[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(queries.all_sql()[name])
    assert rows_of(frame.columns, frame.collect()) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_each_operator_has_a_query():
    names = entry.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)) and "pipeline" in names


def test_stages(spark, documents, odd, empty):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER).cache()
        assert after.columns == documents.columns, name
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert {r["doc_id"] for r in after.select("doc_id").collect()} <= ids
        docs = after
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.count() == docs.count() and whole.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_stages_of_odd_rows(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, FOLDER).columns == odd.columns, name
        assert stage(spark, empty, FOLDER).count() == 0, name
