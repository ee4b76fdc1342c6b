"""Bounded samples of labelled documents for fitting the small models."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import binary
from .text_stats import describe_all

#: Labelled rows a model is fitted on at most; the first ones in the order of a hash of their id.
SAMPLE_ROWS = 20_000


def clean_labels(labels: DataFrame, label: str, id_col: str = "doc_id", where: Column | None = None) -> DataFrame:
    """(id, label) once per id; rows without id or label don't count, the larger of several labels does."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    if where is not None:
        known = known.where(where)
    return known.groupBy(F.col(id_col).alias("sample_id")).agg(F.max(F.col(label)).cast("double").alias("sample_label"))


def labelled_features(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    where: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = SAMPLE_ROWS,
    describe: Callable[[list[bytes | None]], tuple[np.ndarray, np.ndarray]] = describe_all,
) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of at most ``max_rows`` labelled documents that ``where`` holds for.

    Whole texts are read. The rows come in the order of a hash of the id, so reruns agree. The
    sampled ids are bounded by ``max_rows`` and therefore broadcast.
    """
    order = [F.xxhash64("sample_id"), F.col("sample_id")]
    ids = clean_labels(labels, label, id_col, where).orderBy(*order).limit(max_rows)
    chosen = docs.select(F.col(id_col).alias("sample_id"), F.col(text_col).alias("sample_text")).join(
        F.broadcast(ids), "sample_id"
    )

    def measure(batches):
        for batch in batches:
            _, x = describe(binary(batch, "sample_text"))
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(x.tolist(), pa.list_(pa.float64()))],
                names=["sample_id", "sample_label", "x"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    measured = chosen.select("sample_id", "sample_text", "sample_label").mapInArrow(
        measure, f"sample_id {kind}, sample_label double, x array<double>"
    )
    rows = measured.orderBy(*order, "x").limit(max_rows).select("x", "sample_label").collect()
    x = np.array([row[0] for row in rows], float)
    return x, np.array([row[1] for row in rows], float)
