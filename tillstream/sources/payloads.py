"""Landed service payloads and their reshaping into raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.expressions import RATE, WEATHER, lenient_date, strip, text_or, empty_to_null
from tillstream.schemas import (
    FX_PAYLOAD_JSON,
    PRODUCT_PAYLOAD_JSON,
    PRODUCT_SAMPLE_JSON,
    WEATHER_PAYLOAD_JSON,
)
from tillstream.sources.files import read_document


def read_product_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One product answer per file."""
    return read_document(spark, path, PRODUCT_PAYLOAD_JSON)


def read_product_sample(spark: SparkSession, path: str) -> DataFrame:
    """A sample file with all products in one array, in the shape of accepted answers."""
    sample = read_document(spark, path, "products array<string>")
    received = sample.select(F.explode("products").alias("received"))
    product = F.get(F.from_json(F.concat(F.lit('{"products":['), "received", F.lit("]}")), PRODUCT_SAMPLE_JSON)["products"], F.lit(0))
    return received.select(F.lit(1).alias("status"), product.alias("product"), "received")


def read_weather_payloads(spark: SparkSession, city_paths: dict[str, str]) -> DataFrame:
    """Daily series of a few named cities, one path each."""
    frames = [
        read_document(spark, path, WEATHER_PAYLOAD_JSON).withColumn("city", F.lit(city))
        for city, path in city_paths.items()
    ]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def read_weather_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Daily series of any number of cities in one scan; each file is named after its city."""
    return read_document(spark, folder, WEATHER_PAYLOAD_JSON, city=F.regexp_replace("_metadata.file_name", r"\.[^.]*$", ""))


def read_fx_payloads(spark: SparkSession, path: str) -> DataFrame:
    return read_document(spark, path, FX_PAYLOAD_JSON)


def accepted_products(payloads: DataFrame) -> DataFrame:
    """Answers that carry a product."""
    return payloads.where((F.col("status") == 1) & F.col("product").isNotNull())


def normalize_products(payloads: DataFrame, ingested_at: Column) -> DataFrame:
    """Product rows from accepted answers; rows without a code are dropped.

    A name of only spaces still hides the generic name and ends as ``unknown``.
    """
    product = accepted_products(payloads).select("product.*")
    name = F.coalesce(
        empty_to_null(F.col("product_name")), empty_to_null(F.col("generic_name")), F.lit("")
    )
    return product.withColumn("product_code", strip(F.col("code"))).where(
        F.col("product_code") != ""
    ).select(
        "product_code",
        text_or(strip(name), "unknown").alias("product_name"),
        text_or(F.col("brands"), "unknown").alias("brands"),
        text_or(F.col("categories"), "unknown").alias("categories"),
        text_or(F.col("image_front_url"), "").alias("image_front_url"),
        text_or(F.col("ecoscore_grade"), "unknown").alias("ecoscore_grade"),
        ingested_at.alias("ingested_at"),
    )


def normalize_weather(payloads: DataFrame, ingested_at: Column) -> DataFrame:
    """One row per city and listed day; a metric list that is too short gives null."""
    days = payloads.select(
        "city",
        F.posexplode("daily.time").alias("place", "day"),
        F.col("daily.temperature_2m_mean").alias("temperatures"),
        F.col("daily.precipitation_sum").alias("rain"),
    )
    return days.select(
        lenient_date(F.col("day")).alias("weather_date"),
        "city",
        F.get("temperatures", "place").cast(WEATHER).alias("avg_temperature_c"),
        F.get("rain", "place").cast(WEATHER).alias("precipitation_mm"),
        ingested_at.alias("ingested_at"),
    )


def normalize_fx(entries: DataFrame, ingested_at: Column) -> DataFrame:
    """Rates from a flat list of entries; incomplete entries are dropped, a zero rate is kept."""
    complete = F.col("rate").isNotNull()
    for name in ("date", "base", "quote"):
        complete = complete & (F.col(name) != "")
    return entries.where(complete).select(
        lenient_date(F.col("date")).alias("rate_date"),
        F.col("base").alias("base_currency"),
        F.col("quote").alias("quote_currency"),
        F.col("rate").cast(RATE).alias("fx_rate"),
        ingested_at.alias("ingested_at"),
    )


def explode_entries(payloads: DataFrame, column: str) -> DataFrame:
    """Flat entries of payload rows holding them in an array column."""
    return payloads.select(F.explode(column).alias("entry")).select("entry.*")


def envelope(
    payloads: DataFrame, keys: list[Column], batch: Column, ingested_at: Column, payload: Column, **constants: object
) -> DataFrame:
    """Bronze form of payload rows: keys, batch, load time, the document as JSON text, marks.

    Rows that were read from files keep the text as ``received``, with all its fields.
    """
    return payloads.select(
        *keys,
        batch.alias("batch_id"),
        ingested_at.alias("ingested_at"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"),
        *(F.lit(value).alias(name) for name, value in constants.items()),
        *(["received"] if "received" in payloads.columns else []),
    )
