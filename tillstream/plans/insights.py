"""Aggregates behind the report pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.expressions import count_of, period_start, share_pct
from tillstream.plans.serving import order_kpis


def kpi_block(filtered_orders: DataFrame) -> DataFrame:
    """The headline figures of a filtered set of orders."""
    return order_kpis(filtered_orders)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, without null."""
    return _counts(df, column).orderBy(F.col("row_count").desc(), column)


def counts_by_value(df: DataFrame, column: str) -> DataFrame:
    """Rows per value in the order of the values, without null."""
    return _counts(df, column).orderBy(column)


def top_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values."""
    return value_counts(df, column).limit(n)


def order_trend(orders: DataFrame, unit: str) -> DataFrame:
    """Orders, revenue and mean items per ``day``, ``week`` or ``month``."""
    return (
        orders.where(F.col("order_date").isNotNull())
        .groupBy(period_start(unit, F.col("order_date")).alias("period"))
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("payment_value_brl").cast("double").alias("revenue_brl"),
            F.avg("item_count").alias("avg_items"),
        )
        .orderBy("period")
    )


def category_trend(orders: DataFrame, unit: str) -> DataFrame:
    """Revenue per period and category."""
    return (
        orders.where(F.col("order_date").isNotNull() & F.col("product_category_name").isNotNull())
        .groupBy(period_start(unit, F.col("order_date")).alias("period"), "product_category_name")
        .agg(_revenue())
        .orderBy("period", "product_category_name")
    )


def top_categories(orders: DataFrame, n: int = 10) -> DataFrame:
    """Categories with the most revenue."""
    return (
        orders.where(F.col("product_category_name").isNotNull())
        .groupBy("product_category_name")
        .agg(_revenue())
        .orderBy(F.col("revenue_brl").desc(), "product_category_name")
        .limit(n)
    )


def top_states(orders: DataFrame, n: int = 10) -> DataFrame:
    """States with the most orders."""
    return (
        orders.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.count("order_id").alias("order_count"))
        .orderBy(F.col("order_count").desc(), "customer_state")
        .limit(n)
    )


def category_state_long(orders: DataFrame) -> DataFrame:
    """Revenue per category and state, one row per cell that has orders."""
    return (
        orders.where(F.col("product_category_name").isNotNull() & F.col("customer_state").isNotNull())
        .groupBy("product_category_name", "customer_state")
        .agg(_revenue())
    )


def category_state_matrix(orders: DataFrame, states: Sequence[str]) -> DataFrame:
    """Revenue per category with one column for each of ``states``, empty cells zero.

    Where the states are not known beforehand, ``category_state_long`` gives all of them as rows.
    """
    return (
        category_state_long(orders).groupBy("product_category_name")
        .pivot("customer_state", list(states))
        .agg(F.sum("revenue_brl"))
        .na.fill(0.0)
    )


def commerce_insights(orders: DataFrame) -> DataFrame:
    """Category with most revenue, state with most orders, delivered share, in one pass.

    No row for empty input.
    """
    delivered = F.when(F.col("order_status") == "delivered", 1).otherwise(0)
    level = F.grouping_id()
    grouped = orders.groupingSets(
        [["product_category_name"], ["customer_state"], []], "product_category_name", "customer_state"
    ).agg(
        F.sum("payment_value_brl").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.sum(delivered).alias("delivered"),
        level.alias("level"),
    )
    of_category = (F.col("level") == 1) & F.col("product_category_name").isNotNull()
    of_state = (F.col("level") == 2) & F.col("customer_state").isNotNull()
    overall = F.col("level") == 3
    best_category = _first_by(of_category, F.col("revenue"), "product_category_name")
    best_state = _first_by(of_state, F.col("orders"), "customer_state")
    return (
        grouped.agg(
            best_category.alias("category"),
            best_state.alias("state"),
            F.max(F.when(overall, F.col("orders"))).alias("orders"),
            F.max(F.when(overall, F.col("delivered"))).alias("delivered"),
        )
        .where(F.col("orders") > 0)
        .select(
            F.col("category.key").alias("top_category"),
            (-F.col("category.rank")).cast("double").alias("top_category_revenue_brl"),
            F.col("state.key").alias("top_state"),
            (-F.col("state.rank")).alias("top_state_orders"),
            (F.col("delivered") / F.col("orders") * 100).alias("delivered_pct"),
        )
    )


def session_insights(sessions: DataFrame) -> DataFrame:
    """Conversion, mean events and the most frequent sample item, in one pass.

    No row for empty input.
    """
    grouped = sessions.groupingSets([["sample_item_id"], []], "sample_item_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("event_count").alias("events"),
        count_of(F.col("transaction_count") > 0).alias("converted"),
        F.grouping_id().alias("level"),
    )
    of_item = (F.col("level") == 0) & F.col("sample_item_id").isNotNull()
    overall = F.col("level") == 1
    return (
        grouped.agg(
            _first_by(of_item, F.col("sessions"), "sample_item_id").alias("item"),
            *(
                F.max(F.when(overall, F.col(name))).alias(name)
                for name in ("sessions", "events", "converted")
            ),
        )
        .where(F.col("sessions") > 0)
        .select(
            (F.col("converted") / F.col("sessions") * 100).alias("conversion_rate_pct"),
            (F.col("events") / F.col("sessions")).alias("avg_events"),
            F.col("item.key").alias("top_sample_item_id"),
        )
    )


def session_metrics(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.countDistinct("visitor_id").alias("unique_visitors"),
        F.avg("event_count").alias("avg_events"),
        share_pct(F.col("transaction_count") > 0).alias("conversion_rate_pct"),
    )


def funnel_steps(sessions: DataFrame) -> DataFrame:
    """One row per funnel step with its total and the percentage of the first step."""
    totals = sessions.agg(
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("view_count", "addtocart_count", "transaction_count"))
    )
    steps = F.array(
        *(
            F.struct(F.lit(place).alias("step"), F.lit(label).alias("event_type"), F.col(name).alias("total"))
            for place, (label, name) in enumerate(
                (("Views", "view_count"), ("Add to Cart", "addtocart_count"), ("Transactions", "transaction_count")), 1
            )
        )
    )
    return totals.select(F.explode(steps).alias("s"), F.col("view_count").alias("first_total")).select(
        "s.step",
        "s.event_type",
        "s.total",
        (F.try_divide(F.col("s.total"), F.col("first_total")) * 100).alias("pct_of_first"),
    )


def event_histogram(sessions: DataFrame, bins: int = 20) -> DataFrame:
    """Sessions per bin of their event count, equal bins over the observed range, empty ones too.

    The sessions are first reduced to one row per distinct event count. No row for empty input.
    """
    sizes = sessions.where(F.col("event_count").isNotNull()).groupBy("event_count").agg(
        F.count(F.lit(1)).alias("sessions")
    )
    low = sizes.agg(F.min("event_count")).scalar()
    high = sizes.agg(F.max("event_count") + 1).scalar()
    counted = (
        sizes.groupBy(
            F.width_bucket(F.col("event_count").cast("double"), low.cast("double"), high.cast("double"), F.lit(bins)).alias("bin")
        )
        .agg(F.sum("sessions").alias("session_count"))
    )
    every = sessions.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin")).where(low.isNotNull())
    return (
        every.join(counted, "bin", "left")
        .select("bin", F.coalesce("session_count", F.lit(0)).alias("session_count"))
        .orderBy("bin")
    )


def topic_counts(normalized: DataFrame) -> DataFrame:
    return normalized.groupBy("kafka_topic").agg(F.count(F.lit(1)).alias("row_count"))


def product_metrics(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.countDistinct("source_system").alias("source_count"),
    )


def table_stats(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count of each named frame."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(frame.columns)).alias("column_count")
        )
        for name, frame in frames.items()
    ]
    stats = counted[0]
    for part in counted[1:]:
        stats = stats.unionByName(part)
    return stats


def catalog_stats(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Statistics of catalog tables by report name; a missing table counts 0 rows, 0 columns."""
    absent = spark.createDataFrame([], "x int").select()
    return table_stats(
        {name: spark.table(table) if spark.catalog.tableExists(table) else absent for name, table in tables.items()}
    )


def weather_series(weather: DataFrame) -> DataFrame:
    return weather.select("weather_date", "city", "avg_temperature_c", "precipitation_mm").orderBy(
        "weather_date", "city"
    )


def fx_series(fx_rates: DataFrame) -> DataFrame:
    return fx_rates.select("rate_date", "quote_currency", "fx_rate").orderBy("rate_date", "quote_currency")


def temperature_vs_value(orders: DataFrame) -> DataFrame:
    """Points with both a temperature and an order value."""
    return orders.na.drop(subset=["avg_temperature_c", "payment_value_brl"]).select(
        "order_id", "customer_state", "avg_temperature_c", "payment_value_brl"
    )


def _counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def _revenue() -> Column:
    return F.sum("payment_value_brl").cast("double").alias("revenue_brl")


def _first_by(condition: Column, size: Column, key: str) -> Column:
    """Key with the largest size, the smallest key on a tie."""
    return F.min(F.when(condition, F.struct((-size).alias("rank"), F.col(key).alias("key"))))
