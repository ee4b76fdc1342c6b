"""Data-quality checks: violation queries and one-pass suites."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.expressions import count_of, is_blank
from tillstream.settings import EVENT_TYPES, SUITE_STATUSES

RESULT_COLUMNS = ["table_name", "expectation", "column_name", "status", "failures"]


# Violation queries: the rows returned are the failures.


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicate_keys(df: DataFrame, key: str, nulls_equal: bool = True) -> DataFrame:
    """Keys held by several rows. With ``nulls_equal`` two null keys are duplicates too."""
    rows = df if nulls_equal else df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def outside_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Rows whose lower-case value is not in the domain; null passes."""
    return df.where(~F.lower(column).isin(list(domain)))


def not_positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) <= 0)


def blank_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which any of the columns is null or only spaces."""
    condition = F.lit(False)
    for column in columns:
        condition |= is_blank(F.col(column))
    return df.where(condition).select(*columns)


@dataclass(frozen=True)
class CheckResult:
    name: str
    status: str
    row_count: int
    error: str | None = None


#: What a job that fails raises, and conditions of it that say that the rows of a table are not there.
PROBLEMS = (PySparkException, Py4JJavaError)
UNREADABLE = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA")


def unreadable(problem: Exception) -> bool:
    """Whether a check can't run because a table, a column or its files are missing or broken.

    A job that was lost for any other reason, as by its executors, says nothing about the table.
    """
    if isinstance(problem, AnalysisException):
        return True
    return any(f"[{condition}" in str(problem) for condition in UNREADABLE)


def run_check(name: str, violations: Callable[[], DataFrame]) -> CheckResult:
    """Count the violations; a query over what is not there is skipped, and one whose job is lost fails."""
    try:
        failures = violations().count()
    except PROBLEMS as problem:
        return CheckResult(name, "skipped" if unreadable(problem) else "failed", 0, str(problem))
    return CheckResult(name, "failed" if failures else "passed", failures)


def results_frame(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    return spark.createDataFrame(
        [(r.name, r.status, r.row_count, r.error) for r in results],
        "name string, status string, row_count bigint, error string",
    )


# Suites: all checks of a table in one pass.


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    values: tuple = ()

    def violated(self) -> Column:
        """Whether a row fails; null passes all but the null check."""
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "accepted_values":
            return ~value.isin(list(self.values))
        if self.kind == "positive":
            return value <= 0
        raise ValueError(f"{self.kind} is not decided row by row")


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def unique(column: str) -> Expectation:
    return Expectation("unique", column)


def accepted(column: str, values: Sequence[str]) -> Expectation:
    return Expectation("accepted_values", column, tuple(values))


def positive(column: str) -> Expectation:
    return Expectation("positive", column)


def rows_above(count: int = 0) -> Expectation:
    return Expectation("row_count_above", None, (count,))


# The suite over five tables and the column tests of the warehouse models.
SUITE = {
    "raw.olist_orders": (
        not_null("order_id"),
        unique("order_id"),
        not_null("order_purchase_timestamp"),
        accepted("order_status", SUITE_STATUSES),
    ),
    "raw.retailrocket_events": (
        not_null("event_id"),
        not_null("visitor_id"),
        accepted("event_type", EVENT_TYPES),
        rows_above(0),
    ),
    "raw.frankfurter_fx_rates": (not_null("rate_date"), not_null("fx_rate"), rows_above(0)),
    "raw.open_meteo_weather": (not_null("weather_date"), not_null("city"), rows_above(0)),
    "marts.fct_commerce_orders": (
        not_null("order_id"),
        unique("order_id"),
        not_null("customer_id"),
        not_null("payment_value_brl"),
        rows_above(0),
    ),
}
MODEL_TESTS = {
    "stg_olist_orders": (not_null("order_id"), unique("order_id"), not_null("customer_id"), not_null("order_status")),
    "stg_olist_order_items": (not_null("order_id"), not_null("order_item_id")),
    "stg_olist_customers": (not_null("customer_id"), unique("customer_id")),
    "stg_olist_products": (not_null("product_id"), unique("product_id")),
    "stg_olist_order_payments": (not_null("order_id"),),
    "stg_retailrocket_events": (
        not_null("event_id"),
        unique("event_id"),
        not_null("visitor_id"),
        not_null("event_type"),
    ),
    "stg_open_food_facts_products": (not_null("product_id"), unique("product_id")),
    "stg_open_meteo_weather": (not_null("weather_date"), not_null("city")),
    "stg_frankfurter_fx_rates": (not_null("rate_date"), not_null("quote_currency")),
    "int_orders_with_context": (not_null("order_id"), unique("order_id")),
    "int_retailrocket_sessions": (not_null("session_key"), unique("session_key")),
    "fct_commerce_orders": (not_null("order_id"), unique("order_id"), not_null("customer_id")),
    "fct_retailrocket_sessions": (not_null("session_key"), unique("session_key")),
    "dim_products": (not_null("product_key"), unique("product_key"), not_null("product_id")),
}


def check_table(name: str, df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One result row per expectation, from one pass over the table.

    With a unique key the rows are first reduced to one per key, keeping the counts of the
    other checks; null keys are no duplicates. Each further unique key takes a pass of its own.
    """
    by_row = {e: f"c{i}" for i, e in enumerate(expectations) if e.kind not in ("unique", "row_count_above")}
    counts = [count_of(e.violated()).alias(column) for e, column in by_row.items()]
    all_rows = F.count(F.lit(1)).alias("rows")
    keys = [e for e in expectations if e.kind == "unique"]
    if keys:
        key = F.col(keys[0].column)
        repeated = F.sum(F.when(key.isNotNull() & (F.col("rows") > 1), F.col("rows")))
        totals = df.groupBy(key).agg(all_rows, *counts).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(repeated, F.lit(0)).alias("repeated"),
            *(F.coalesce(F.sum(column), F.lit(0)).alias(column) for column in by_row.values()),
        )
    else:
        totals = df.agg(all_rows, *counts)

    def failures(e: Expectation) -> Column:
        if e.kind == "unique":
            return F.col("repeated")
        if e.kind == "row_count_above":
            return F.when(F.col("rows") > e.values[0], 0).otherwise(1)
        return F.col(by_row[e])

    rows = F.array(*(_row(name, e, failures(e)) for e in expectations if e not in keys[1:]))
    parts = [totals.select(F.explode(rows).alias("r")).select("r.*")]
    for e in keys[1:]:
        repeated = duplicate_keys(df, e.column, nulls_equal=False).agg(
            F.coalesce(F.sum("duplicate_count"), F.lit(0)).alias("repeated")
        )
        parts.append(repeated.select(_row(name, e, F.col("repeated")).alias("r")).select("r.*"))
    return _union(parts)


def check_suite(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    suite: Mapping[str, Sequence[Expectation]] = SUITE,
) -> DataFrame:
    """Results of a suite; every expectation of a table that is absent is skipped."""
    parts = []
    absent = []
    for name, expectations in suite.items():
        frame = tables.get(name)
        if frame is not None:
            parts.append(check_table(name, frame, expectations))
        else:
            absent += [(name, e.kind, e.column, "skipped", 0) for e in expectations]
    if absent:
        parts.append(
            spark.createDataFrame(
                absent, SUITE_RESULT
            )
        )
    return _union(parts)


SUITE_RESULT = "table_name string, expectation string, column_name string, status string, failures bigint"


def run_suite(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | Callable[[], DataFrame] | None],
    suite: Mapping[str, Sequence[Expectation]] = SUITE,
) -> DataFrame:
    """Results of a suite with the column ``error``, each table checked by a job of its own.

    A table that is absent, lacks a column or cannot be read has its expectations skipped, with the
    error, and the others are checked; a job that is lost for another reason makes them fail. A table
    may be given as a function, so that one that cannot even be opened is skipped, too. A job
    returns one row for each expectation.
    """
    rows = []
    for name, expectations in suite.items():
        frame, error, status = tables.get(name), None, "skipped"
        try:
            if frame is not None:
                frame = frame() if callable(frame) else frame
                rows += [(*row, None) for row in check_table(name, frame, expectations).collect()]
                continue
        except PROBLEMS as problem:
            error, status = str(problem), "skipped" if unreadable(problem) else "failed"
        rows += [(name, e.kind, e.column, status, 0, error) for e in expectations]
    return spark.createDataFrame(rows, f"{SUITE_RESULT}, error string")


def catalog_tables(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame | None]:
    return {name: spark.table(name) if spark.catalog.tableExists(name) else None for name in names}


def summarize_results(results: DataFrame) -> DataFrame:
    """Numbers of passed, failed and skipped checks."""
    return results.agg(
        *(count_of(F.col("status") == status).alias(status) for status in ("passed", "failed", "skipped"))
    )


def write_report(results: DataFrame, path: str, contracts: Sequence[Mapping] = (), strict: bool = True) -> None:
    """Write contracts, results and summary as one JSON document.

    A suite has one row per expectation, so its results fit into one document however large
    the checked tables are. In strict mode any failed check is an error after writing.
    """
    document = results.agg(
        F.collect_list(F.struct(*results.columns)).alias("results"),
        F.struct(
            *(count_of(F.col("status") == status).alias(status) for status in ("passed", "failed", "skipped"))
        ).alias("summary"),
    ).withColumn("contracts", F.lit(json.dumps(list(contracts))))
    document.coalesce(1).write.mode("overwrite").json(path)
    if strict:
        written = results.sparkSession.read.json(path).select("summary.failed").first()
        if written[0]:
            raise RuntimeError(f"{written[0]} quality checks failed")


def _row(table: str, e: Expectation, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).cast("string").alias("column_name"),
        F.when(failures > 0, "failed").otherwise("passed").alias("status"),
        failures.cast("long").alias("failures"),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
