"""The star-schema and event tables of the test data, read as the raw commerce tables.

Orders, line items, customers, parts and events play the commerce and click tables; suppliers
play the second product source. Weather and rates are spun from the order dates and nations by
the generators. There are no rates on Sundays, so orders of these days have no USD value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.expressions import MONEY, topic_of
from tillstream.plans.staging import Staging
from tillstream.settings import TopicPlan
from tillstream.sources.generators import fx_rows, weather_rows

# How codes of the test data read in the commerce model.
STATUS_NAMES = {"F": "delivered", "O": "shipped", "P": "processing"}
EVENT_NAMES = {"view": "view", "click": "addtocart", "purchase": "transaction"}
LOADED_AT = "2024-01-01 00:00:00"


TABLE_SCHEMAS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        f"{_renamed('o_orderstatus', STATUS_NAMES)} as order_status",
        "o_orderdate as order_purchase_timestamp",
        "o_orderdate + interval 12 hours as order_approved_at",
        "o_orderdate + interval 10 days as order_estimated_delivery_date",
    )


def raw_order_items(spark: SparkSession, folder: str) -> DataFrame:
    price = f"cast(l_extendedprice as {MONEY})"
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as order_item_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        f"{price} as price",
        f"round({price} * cast(l_tax as decimal(4,2)), 2) as freight_value",
    )


def raw_order_payments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").where("l_linestatus = 'F'").selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as payment_sequential",
        "l_returnflag as payment_type",
        "1 as payment_installments",
        f"cast(l_extendedprice as {MONEY}) as payment_value",
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        table(spark, folder, "customer")
        .join(nations, "c_nationkey", "left")
        .join(regions, "n_regionkey", "left")
        .selectExpr("c_custkey as customer_id", "n_name as customer_city", "r_name as customer_state")
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey as product_id",
        "p_type as product_category_name",
        "length(p_name) as product_name_length",
        "length(p_brand) as product_description_length",
        "1 as product_photos_qty",
        "p_size as product_weight_g",
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    event_type = _renamed("event_type", EVENT_NAMES)
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "user_id as visitor_id",
        f"{event_type} as event_type",
        "get_json_object(props, '$.k') as item_id",
        "case when event_type = 'purchase' then event_id end as transaction_id",
        "ts as event_ts",
    ).withColumn("kafka_topic", topic_of(F.col("event_type"), TopicPlan()))


def raw_food_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "s_suppkey as product_code",
        "s_name as product_name",
        "concat('brand-', s_nationkey) as brands",
        "concat('category-', s_nationkey % 7) as categories",
        "'' as image_front_url",
        "elt(s_nationkey % 6 + 1, 'a', 'b', 'c', 'd', 'e', null) as ecoscore_grade",
        f"timestamp_ntz '{LOADED_AT}' as ingested_at",
    )


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, folder, "orders")
    cities = table(spark, folder, "nation").select(F.col("n_name").alias("city"))
    return weather_rows(
        cities,
        orders.agg(F.min(day)).scalar(),
        orders.agg(F.max(day)).scalar(),
        F.to_timestamp_ntz(F.lit(LOADED_AT)),
    )


def raw_fx_rates(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, folder, "orders")
    base = spark.range(1).select(F.lit("EUR").alias("base_currency"))
    rates = fx_rows(
        base,
        orders.agg(F.min(day)).scalar(),
        orders.agg(F.max(day)).scalar(),
        F.to_timestamp_ntz(F.lit(LOADED_AT)),
    )
    return rates.where(F.dayofweek("rate_date") != 1)


def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    """Loads per priority and month, each logged once per day it grew."""
    placed = F.col("o_orderdate")
    return (
        table(spark, folder, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("source_name"),
            F.date_format(placed, "yyyyMM").alias("batch_id"),
            placed.alias("loaded_at"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "olist_orders": raw_orders(spark, folder),
        "olist_order_items": raw_order_items(spark, folder),
        "olist_customers": raw_customers(spark, folder),
        "olist_products": raw_products(spark, folder),
        "olist_order_payments": raw_order_payments(spark, folder),
        "retailrocket_events": raw_events(spark, folder),
        "open_food_facts_products": raw_food_products(spark, folder),
        "open_meteo_weather": raw_weather(spark, folder),
        "frankfurter_fx_rates": raw_fx_rates(spark, folder),
    }


def staged(spark: SparkSession, folder: str) -> Staging:
    return Staging.of(raw_tables(spark, folder))


def _renamed(column: str, names: dict[str, str]) -> str:
    """SQL that replaces the codes in ``names`` and keeps other values."""
    cases = " ".join(f"when '{code}' then '{name}'" for code, name in names.items())
    return f"case {column} {cases} else {column} end"
