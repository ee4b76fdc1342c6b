"""Scans of catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.schemas import RAW_SCHEMAS

LAYERS = ("raw", "staging", "marts")


def guarded_table(spark: SparkSession, table: str, database: str = "raw") -> DataFrame:
    """The table, or an empty relation of its schema that the optimizer can see is empty."""
    name = f"{database}.{table}"
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return empty_table(spark, table)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], RAW_SCHEMAS[table]).where(F.lit(False))


def list_tables(spark: SparkSession, databases: tuple[str, ...] = LAYERS) -> DataFrame:
    """Schema and name of every table of the layers, in order."""
    rows = [
        (database, table.name)
        for database in databases
        if spark.catalog.databaseExists(database)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
    ]
    listed = spark.createDataFrame(rows, "table_schema string, table_name string")
    return listed.orderBy("table_schema", "table_name")
