"""Intermediate relations and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.expressions import MONEY, cross_rate, order_value
from tillstream.operators.sessions import SessionRule, summarize
from tillstream.plans.staging import Staging

ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "customer_city",
    "customer_state",
    "order_purchase_ts",
    "order_date",
    "order_status",
    "item_count",
    "gross_item_value",
    "freight_value",
    "payment_value_brl",
    "payment_value_usd",
    "payment_type",
    "product_id",
    "product_category_name",
    "product_weight_g",
    "avg_temperature_c",
    "precipitation_mm",
    "brl_to_usd_fx_rate",
]


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("item_price").alias("gross_item_value"),
        F.sum("freight_value").alias("freight_value"),
        F.min("product_id").alias("primary_product_id"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value_brl"),
        F.min("payment_type").alias("payment_type"),
    )


def order_totals(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Item and payment figures of each order side by side, in one aggregation of both tables."""
    lines = items.selectExpr("order_id", "1 as line", "item_price", "freight_value", "product_id")
    paid = payments.selectExpr("order_id", "payment_value", "payment_type")
    return lines.unionByName(paid, allowMissingColumns=True).groupBy("order_id").agg(
        F.count("line").alias("item_count"),
        F.sum("item_price").alias("gross_item_value"),
        F.sum("freight_value").alias("freight_value"),
        F.min("product_id").alias("primary_product_id"),
        F.sum("payment_value").alias("payment_value_brl"),
        F.min("payment_type").alias("payment_type"),
    )


def fx_by_day(fx_rates: DataFrame) -> DataFrame:
    """USD and BRL rate of each day side by side."""
    def rate_of(currency: str):
        return F.max(F.when(F.col("quote_currency") == currency, F.col("fx_rate")))

    return fx_rates.groupBy("rate_date").agg(
        rate_of("USD").alias("eur_to_usd_fx_rate"),
        rate_of("BRL").alias("eur_to_brl_fx_rate"),
    )


def cross_rates(fx_rates: DataFrame) -> DataFrame:
    return fx_by_day(fx_rates).select(
        "rate_date",
        cross_rate(F.col("eur_to_usd_fx_rate"), F.col("eur_to_brl_fx_rate")).alias("brl_to_usd_fx_rate"),
    )


def orders_with_context(staging: Staging) -> DataFrame:
    """Orders with items, payments, customer, main product, weather and exchange rate.

    Items and payments are reduced to one row per order before they are joined, so no join
    multiplies orders. Sides reduced by an aggregate get a shuffle of their own behind it, so both
    sides of every shuffled join are plain shuffles, which lets AQE split a hot order, customer,
    product or day over several tasks. Which side is broadcast is left to Spark's size check.
    """
    orders = staging.orders.select(
        "order_id",
        "customer_id",
        "order_purchase_ts",
        F.col("order_purchase_ts").cast("date").alias("order_date"),
        "order_status",
    )
    products = staging.products.select(
        F.col("product_id").alias("primary_product_id"), "product_category_name", "product_weight_g"
    )
    weather = staging.weather.select(
        F.col("weather_date").alias("order_date"),
        F.col("city").alias("customer_city"),
        "avg_temperature_c",
        "precipitation_mm",
    )
    rates = cross_rates(staging.fx_rates).withColumnRenamed("rate_date", "order_date")
    totals = order_totals(staging.order_items, staging.order_payments)
    nothing = F.lit(0).cast(MONEY)
    return (
        orders.join(totals.repartition("order_id"), "order_id", "left")
        .join(staging.customers, "customer_id", "left")
        .join(products, "primary_product_id", "left")
        .join(weather, ["order_date", "customer_city"], "left")
        .join(rates.repartition("order_date"), "order_date", "left")
        .select(
            "order_id",
            "customer_id",
            "customer_city",
            "customer_state",
            "order_purchase_ts",
            "order_date",
            "order_status",
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            F.coalesce("gross_item_value", nothing).alias("gross_item_value"),
            F.coalesce("freight_value", nothing).alias("freight_value"),
            order_value(
                F.col("payment_value_brl"), F.col("gross_item_value"), F.col("freight_value")
            ).alias("payment_value_brl"),
            "payment_type",
            F.col("primary_product_id").alias("product_id"),
            "product_category_name",
            "product_weight_g",
            "avg_temperature_c",
            "precipitation_mm",
            "brl_to_usd_fx_rate",
        )
    )


def commerce_orders(context: DataFrame) -> DataFrame:
    """Order mart: the context with the value in USD where a rate is known."""
    usd = F.when(
        F.col("brl_to_usd_fx_rate").isNotNull(), F.col("payment_value_brl") * F.col("brl_to_usd_fx_rate")
    )
    return context.withColumn("payment_value_usd", usd).select(ORDER_COLUMNS)


def click_sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Session mart under the warehouse rule."""
    return summarize(events, SessionRule.minute_marks(gap_minutes))


def product_dimension(products: DataFrame, food_products: DataFrame) -> DataFrame:
    """Products of both sources side by side; the sources are not matched."""
    def keyed(source: str, df: DataFrame, **columns) -> DataFrame:
        def column(name: str, kind: str):
            return columns.get(name, F.lit(None)).cast(kind).alias(name)

        return df.select(
            F.concat(F.lit(f"{source}:"), "product_id").alias("product_key"),
            "product_id",
            column("product_name", "string"),
            column("brand", "string"),
            column("category", "string"),
            F.lit(None).cast(MONEY).alias("price_usd"),
            column("ecoscore_grade", "string"),
            column("image_front_url", "string"),
            F.lit(source).alias("source_system"),
        )

    shop = keyed("olist", products, category=F.col("product_category_name"))
    food = keyed(
        "open_food_facts",
        food_products,
        **{
            name: F.col(name)
            for name in ("product_name", "brand", "category", "ecoscore_grade", "image_front_url")
        },
    )
    return shop.unionByName(food)
