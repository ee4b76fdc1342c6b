"""The quality checks of the warehouse, over catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tillstream.operators import quality as Q
from tillstream.plans.staging import Staging
from tillstream.settings import EVENT_TYPES, WAREHOUSE_STATUSES


def violation_queries(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """Named queries whose rows are failures. A missing table makes its query skipped."""
    return {
        "raw_olist_orders_not_null": lambda: Q.null_rows(spark.table("raw.olist_orders"), "order_id"),
        "raw_retailrocket_event_types": lambda: Q.outside_domain(
            spark.table("raw.retailrocket_events"), "event_type", EVENT_TYPES
        ),
        "reference_fx_positive": lambda: Q.not_positive(spark.table("raw.frankfurter_fx_rates"), "fx_rate"),
        "reference_open_food_facts_products_not_null": lambda: Q.blank_rows(
            spark.table("raw.open_food_facts_products"), "product_code", "product_name"
        ),
        "marts_commerce_orders_unique": lambda: Q.duplicate_keys(spark.table("marts.fct_commerce_orders"), "order_id"),
        "valid_olist_order_statuses": lambda: Q.outside_domain(
            Staging.from_catalog(spark).orders, "order_status", WAREHOUSE_STATUSES
        ),
        "valid_retailrocket_event_types": lambda: Q.outside_domain(
            Staging.from_catalog(spark).events, "event_type", EVENT_TYPES
        ),
        "positive_fx_rates": lambda: Q.not_positive(Staging.from_catalog(spark).fx_rates, "fx_rate"),
    }


def run_violation_queries(spark: SparkSession) -> DataFrame:
    """Status and failing rows of every violation query."""
    return Q.results_frame(spark, [Q.run_check(name, query) for name, query in violation_queries(spark).items()])


def run_suite(spark: SparkSession) -> DataFrame:
    return Q.run_suite(spark, {name: partial(spark.table, name) for name in Q.SUITE})


def run_quality(spark: SparkSession, report: str, contracts: Sequence[Mapping] = (), strict: bool = True) -> None:
    """Write the reports of the violation queries and of the suite; strict fails on a failed check."""
    problems = []
    for name, results in (("violations", run_violation_queries(spark)), ("suite", run_suite(spark))):
        try:
            Q.write_report(results, f"{report}/{name}", contracts, strict)
        except RuntimeError as failed:
            problems.append(f"{name}: {failed}")
    if problems:
        raise RuntimeError("; ".join(problems))
