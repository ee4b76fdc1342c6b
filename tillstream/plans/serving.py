"""Filtered, ordered and paged reads of the marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.expressions import count_of, share_pct


def within_days(df: DataFrame, column: str, start: date | None, end: date | None) -> DataFrame:
    """Inclusive date range, each end optional."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def matching(df: DataFrame, **equals: object) -> DataFrame:
    """Rows equal to every given value; a value of None does not filter."""
    for column, value in equals.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def list_orders(
    orders: DataFrame,
    status: str | None = None,
    category: str | None = None,
    state: str | None = None,
    start: date | None = None,
    end: date | None = None,
    limit: int = 100,
    offset: int = 0,
    after: tuple[date | None, str] | None = None,
) -> DataFrame:
    """Newest orders first. ``after`` continues behind a (date, id) without a deep offset."""
    found = within_days(
        matching(orders, order_status=status, product_category_name=category, customer_state=state),
        "order_date",
        start,
        end,
    )
    if after is not None:
        found = found.where(_behind("order_date", "order_id", *after))
    return found.orderBy(F.col("order_date").desc_nulls_last(), "order_id").offset(offset).limit(limit)


def list_sessions(
    sessions: DataFrame,
    limit: int = 100,
    offset: int = 0,
    after: tuple[datetime | None, str] | None = None,
) -> DataFrame:
    """Latest sessions first."""
    if after is not None:
        sessions = sessions.where(_behind("session_start_ts", "session_key", *after))
    return (
        sessions.orderBy(F.col("session_start_ts").desc_nulls_last(), F.col("session_key").asc_nulls_last())
        .offset(offset)
        .limit(limit)
    )


def list_products(products: DataFrame, source: str | None = None, limit: int = 200) -> DataFrame:
    return matching(products, source_system=source).orderBy(F.col("product_key").asc_nulls_last()).limit(limit)


def list_weather(
    weather: DataFrame,
    city: str | None = None,
    start: date | None = None,
    end: date | None = None,
    limit: int = 500,
) -> DataFrame:
    """Oldest days first, cities of a day by name."""
    found = within_days(matching(weather, city=city), "weather_date", start, end)
    return found.orderBy(F.col("weather_date").asc_nulls_last(), F.col("city").asc_nulls_last()).limit(limit)


def list_fx_rates(
    fx_rates: DataFrame,
    quote_currency: str | None = None,
    start: date | None = None,
    end: date | None = None,
    limit: int = 500,
) -> DataFrame:
    """Oldest days first, currencies of a day by name."""
    found = within_days(matching(fx_rates, quote_currency=quote_currency), "rate_date", start, end)
    return found.orderBy(
        F.col("rate_date").asc_nulls_last(), F.col("quote_currency").asc_nulls_last()
    ).limit(limit)


def list_audit(audit: DataFrame, limit: int | None = 50) -> DataFrame:
    """Audit rows, newest load first; ``limit=None`` gives all."""
    rows = audit_columns(audit).orderBy(
        F.col("loaded_at").desc_nulls_last(), "source_name", "batch_id"
    )
    return rows if limit is None else rows.limit(limit)


def audit_columns(audit: DataFrame) -> DataFrame:
    return audit.select("source_name", "batch_id", "row_count", "loaded_at")


def order_kpis(orders: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Eight figures of the orders, all zero on empty input."""
    def or_zero(value: Column) -> Column:
        return F.coalesce(value.cast("double"), F.lit(0.0))

    return within_days(orders, "order_date", start, end).agg(
        F.count(F.lit(1)).alias("total_orders"),
        or_zero(F.sum("payment_value_brl")).alias("total_revenue_brl"),
        or_zero(F.sum("payment_value_usd")).alias("total_revenue_usd"),
        or_zero(_mean("payment_value_brl")).alias("avg_order_value_brl"),
        F.coalesce(F.sum("item_count"), F.lit(0)).alias("total_items"),
        F.countDistinct("customer_id").alias("unique_customers"),
        or_zero(_mean("freight_value")).alias("avg_freight"),
        or_zero(share_pct(F.col("order_status") == "delivered")).alias("delivery_rate_pct"),
    )


def session_funnel(sessions: DataFrame) -> DataFrame:
    """Totals of the funnel steps and the share of sessions with a transaction."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        total("view_count").alias("total_views"),
        total("addtocart_count").alias("total_addtocart"),
        total("transaction_count").alias("total_transactions"),
        F.coalesce(share_pct(F.col("transaction_count") > 0), F.lit(0.0)).alias("conversion_rate_pct"),
    )


def order_condition(
    start: date | None = None,
    end: date | None = None,
    statuses: Sequence[str] = (),
    categories: Sequence[str] = (),
    states: Sequence[str] = (),
    payment_types: Sequence[str] = (),
) -> Column:
    """Date range and value lists; an empty list does not filter, a null never matches a list."""
    condition = F.lit(True)
    if start is not None:
        condition &= F.col("order_date") >= F.lit(start)
    if end is not None:
        condition &= F.col("order_date") <= F.lit(end)
    for column, values in (
        ("order_status", statuses),
        ("product_category_name", categories),
        ("customer_state", states),
        ("payment_type", payment_types),
    ):
        if values:
            condition &= F.col(column).isin(list(values))
    return condition


def filter_orders(orders: DataFrame, **chosen) -> DataFrame:
    return orders.where(order_condition(**chosen))


def filtered_share(orders: DataFrame, **chosen) -> DataFrame:
    """Rows that pass the filter and all rows, in one pass."""
    return orders.agg(
        count_of(order_condition(**chosen)).alias("filtered_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def filter_options(orders: DataFrame, column: str) -> DataFrame:
    """Values to choose from, sorted, without null."""
    return orders.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def day_bounds(orders: DataFrame) -> DataFrame:
    return orders.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"))


def as_days(df: DataFrame, *columns: str) -> DataFrame:
    """Coerce date columns of a frame read back from a service."""
    return df.withColumns({name: F.to_date(name) for name in columns})


def as_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


def serving_products(products: DataFrame) -> DataFrame:
    """Offer the category under its mart name where that name is absent."""
    if "product_category_name" in products.columns or "category" not in products.columns:
        return products
    return products.withColumn("product_category_name", F.col("category"))


def serving_sessions(sessions: DataFrame) -> DataFrame:
    """Add the sample item as null where an older frame lacks it."""
    if "sample_item_id" in sessions.columns:
        return sessions
    return sessions.withColumn("sample_item_id", F.lit(None).cast("string"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Null in place of NaN in the floating-point columns."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({name: F.when(~F.isnan(name), F.col(name)) for name in floats})


def _mean(column: str) -> Column:
    """Mean of an exact sum; the mean of a decimal would be rounded to its scale."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def _behind(first: str, second: str, value: date | datetime | None, key: str) -> Column:
    """Rows behind (value, key) when ordered by first descending nulls last, second ascending."""
    if value is None:
        return F.col(first).isNull() & (F.col(second) > key)
    # A wall-clock time must not pass through the zone of the session.
    bound = F.lit(str(value)).cast("timestamp_ntz") if isinstance(value, datetime) else F.lit(value)
    return F.col(first).isNull() | (F.col(first) < bound) | ((F.col(first) == bound) & (F.col(second) > key))
