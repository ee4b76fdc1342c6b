"""Catalog tables: creation, full refresh, materialized marts, audit."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.upserts import audit_state
from tillstream.schemas import RAW_SCHEMAS
from tillstream.sinks.files import make_folder, move_folder, qualified, remove_folder, write_parquet
from tillstream.sources.catalog import LAYERS


def create_layers(spark: SparkSession) -> None:
    """Create the databases and the empty raw tables that do not exist yet."""
    for database in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, ddl in RAW_SCHEMAS.items():
        create_table(spark, f"raw.{table}", ddl)


def create_table(spark: SparkSession, target: str, ddl: str) -> None:
    """An empty table whose rows may lie in folders below its own, as batches put them."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {target} ({ddl}) USING parquet OPTIONS ('recursiveFileLookup' = 'true')")


def refresh_raw(df: DataFrame, table: str, keep_if_empty: bool = False) -> int:
    """Replace the rows of a raw table and return how many were written.

    Empty input empties the table unless ``keep_if_empty``. The count is taken on the way.
    """
    return switch_rows(df, f"raw.{table}", keep_if_empty)


def switch_rows(df: DataFrame, target: str, keep_if_empty: bool = False) -> int:
    """Replace the rows of a table as one unit; rows written.

    The rows go to a folder of their own, and the table is pointed there when all are written, so
    a reader sees all old or all new rows, and a load that fails leaves the old ones. The folder
    that was replaced stays until the next load for readers that have begun.
    """
    spark = df.sparkSession
    database, name = target.split(".")
    home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    staged = f"{home}/{name}-{uuid.uuid4().hex}"
    rows = write_parquet(conformed(df, target), staged)
    if rows == 0 and keep_if_empty:
        remove_folder(spark, staged)
        return 0
    before = _properties(spark, target).get(REPLACED)
    _point_to(spark, target, staged)
    if before and before.startswith(f"{home}/"):
        remove_folder(spark, before)
    return rows


def load_batch(df: DataFrame, target: str, folder: str, number: int, spark: SparkSession | None = None) -> int:
    """Put a batch of rows into a table that lies in ``folder``; a repeated batch replaces itself.

    The first batch of a folder points the table there; what the table held before is no longer
    part of it. Each batch has a folder of its own under its number, written apart and moved.
    ``spark`` is the session whose readers shall see the batch; a stream's batches have another one.
    """
    spark = spark or df.sparkSession
    if _location(spark, target).rstrip("/") != qualified(spark, folder):
        make_folder(spark, folder)
        _point_to(spark, target, folder)
    staged = f"{folder}-staged/batch-{number}"
    rows = write_parquet(conformed(df, target), staged)
    move_folder(spark, staged, f"{folder}/batch-{number}")
    spark.catalog.refreshTable(target)
    return rows


def conformed(df: DataFrame, target: str) -> DataFrame:
    """``df`` with the columns and types of a table."""
    wanted = df.sparkSession.table(target).schema
    return df.select(*(F.col(field.name).cast(field.dataType) for field in wanted))


#: Property of a table: the folder that the last load replaced.
REPLACED = "tillstream.replaced"


def _location(spark: SparkSession, target: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {target}").where("col_name = 'Location'").first()["data_type"]


def _properties(spark: SparkSession, target: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}


def _point_to(spark: SparkSession, target: str, folder: str) -> None:
    replaced = _location(spark, target).rstrip("/")
    spark.sql(f"ALTER TABLE {target} SET LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{REPLACED}' = '{replaced}')")
    spark.catalog.refreshTable(target)


def load_tables(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """Refresh several raw tables; rows written by table."""
    return {table: refresh_raw(frame, table) for table, frame in frames.items()}


def load_counts(counts: Mapping[str, int], spark: SparkSession) -> DataFrame:
    """Rows of a load per table and in total, from the counts taken while writing."""
    per_table = spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")
    return with_total(per_table)


def with_total(per_table: DataFrame) -> DataFrame:
    return per_table.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("total")).alias("table_name"), "row_count"
    )


def materialize(
    df: DataFrame,
    name: str,
    database: str = "marts",
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Write a mart table. Bucketing on a join key lets later joins skip the shuffle."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(f"{database}.{name}")


def publish_views(frames: Mapping[str, DataFrame]) -> None:
    """Offer lazy relations by name to SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def append_audit(spark: SparkSession, source_name: str, batch: str, rows: int) -> None:
    """Add a load to the audit log; ``current_audit`` shows the newest per batch."""
    spark.range(1).select(
        F.lit(source_name).alias("source_name"),
        F.lit(batch).alias("batch_id"),
        F.current_timestamp().alias("loaded_at"),
        F.lit(rows).cast("bigint").alias("row_count"),
    ).write.insertInto("raw.ingestion_audit")


def current_audit(spark: SparkSession) -> DataFrame:
    return audit_state(spark.table("raw.ingestion_audit"))
