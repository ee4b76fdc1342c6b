"""Typed projections of the nine raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillstream.functions.expressions import MONEY, RATE, WEATHER
from tillstream.sources.catalog import guarded_table

# The time of the session zone without a zone: staging times are wall-clock times.
WALL_TIME = "timestamp_ntz"


@dataclass(frozen=True)
class Staging:
    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    order_payments: DataFrame
    events: DataFrame
    food_products: DataFrame
    weather: DataFrame
    fx_rates: DataFrame

    @classmethod
    def of(cls, raw: dict[str, DataFrame]) -> Staging:
        return cls(
            orders=stage_orders(raw["olist_orders"]),
            order_items=stage_order_items(raw["olist_order_items"]),
            customers=stage_customers(raw["olist_customers"]),
            products=stage_products(raw["olist_products"]),
            order_payments=stage_order_payments(raw["olist_order_payments"]),
            events=stage_events(raw["retailrocket_events"]),
            food_products=stage_food_products(raw["open_food_facts_products"]),
            weather=stage_weather(raw["open_meteo_weather"]),
            fx_rates=stage_fx_rates(raw["frankfurter_fx_rates"]),
        )

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str = "raw") -> Staging:
        """Staging over the catalog; an absent raw table gives an empty relation."""
        return cls.of({table: guarded_table(spark, table, database) for table in RAW_SOURCES})

    def named(self) -> dict[str, DataFrame]:
        """The staging relations under their warehouse names."""
        return {
            "stg_olist_orders": self.orders,
            "stg_olist_order_items": self.order_items,
            "stg_olist_customers": self.customers,
            "stg_olist_products": self.products,
            "stg_olist_order_payments": self.order_payments,
            "stg_retailrocket_events": self.events,
            "stg_open_food_facts_products": self.food_products,
            "stg_open_meteo_weather": self.weather,
            "stg_frankfurter_fx_rates": self.fx_rates,
        }


RAW_SOURCES = (
    "olist_orders",
    "olist_order_items",
    "olist_customers",
    "olist_products",
    "olist_order_payments",
    "retailrocket_events",
    "open_food_facts_products",
    "open_meteo_weather",
    "frankfurter_fx_rates",
)


def _typed(df: DataFrame, *columns: tuple[str, str, str], **derived: str) -> DataFrame:
    """Cast and rename (source, type, name) columns; ``derived`` are SQL expressions by name."""
    casts = [f"cast({source} as {kind}) as {name}" for source, kind, name in columns]
    return df.selectExpr(*casts, *(f"{text} as {name}" for name, text in derived.items()))


def stage_orders(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("order_id", "string", "order_id"),
        ("customer_id", "string", "customer_id"),
        ("order_status", "string", "order_status"),
        ("order_purchase_timestamp", WALL_TIME, "order_purchase_ts"),
        ("order_approved_at", WALL_TIME, "order_approved_ts"),
        ("order_estimated_delivery_date", WALL_TIME, "order_estimated_delivery_ts"),
        source_system="'olist'",
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("order_id", "string", "order_id"),
        ("order_item_id", "int", "order_item_id"),
        ("product_id", "string", "product_id"),
        ("seller_id", "string", "seller_id"),
        ("price", MONEY, "item_price"),
        ("freight_value", MONEY, "freight_value"),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("customer_id", "string", "customer_id"),
        ("customer_city", "string", "customer_city"),
        ("customer_state", "string", "customer_state"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("product_id", "string", "product_id"),
        ("product_category_name", "string", "product_category_name"),
        ("product_name_length", "int", "product_name_length"),
        ("product_description_length", "int", "product_description_length"),
        ("product_photos_qty", "int", "product_photos_qty"),
        ("product_weight_g", "int", "product_weight_g"),
    )


def stage_order_payments(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("order_id", "string", "order_id"),
        ("payment_sequential", "int", "payment_sequential"),
        ("payment_type", "string", "payment_type"),
        ("payment_installments", "int", "payment_installments"),
        ("payment_value", MONEY, "payment_value"),
    )


def stage_events(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("event_id", "string", "event_id"),
        ("visitor_id", "string", "visitor_id"),
        ("item_id", "string", "item_id"),
        ("transaction_id", "string", "transaction_id"),
        ("event_ts", WALL_TIME, "event_ts"),
        ("kafka_topic", "string", "kafka_topic"),
        event_type="lower(cast(event_type as string))",
    )


def stage_food_products(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("product_code", "string", "product_id"),
        ("product_name", "string", "product_name"),
        ("brands", "string", "brand"),
        ("categories", "string", "category"),
        ("ecoscore_grade", "string", "ecoscore_grade"),
        ("image_front_url", "string", "image_front_url"),
        ("ingested_at", WALL_TIME, "ingested_at"),
    )


def stage_weather(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("weather_date", "date", "weather_date"),
        ("city", "string", "city"),
        ("avg_temperature_c", WEATHER, "avg_temperature_c"),
        ("precipitation_mm", WEATHER, "precipitation_mm"),
        ("ingested_at", WALL_TIME, "ingested_at"),
    )


def stage_fx_rates(raw: DataFrame) -> DataFrame:
    return _typed(
        raw,
        ("rate_date", "date", "rate_date"),
        ("base_currency", "string", "base_currency"),
        ("quote_currency", "string", "quote_currency"),
        ("fx_rate", RATE, "fx_rate"),
        ("ingested_at", WALL_TIME, "ingested_at"),
    )
