"""Jobs: land a source, build the warehouse, cut sessions from files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.expressions import batch_id, strip
from tillstream.operators.sessions import SessionRule, summarize
from tillstream.plans.marts import click_sessions, commerce_orders, orders_with_context, product_dimension
from tillstream.plans.staging import Staging
from tillstream.sinks.files import add_documents, write_json_lines, write_parquet
from tillstream.sinks.tables import append_audit, load_tables, materialize, publish_views, refresh_raw
from tillstream.sources.clicks import job_clicks
from tillstream.sources.files import manifest_files, read_click_lines, read_commerce_files
from tillstream.sources.payloads import accepted_products, envelope, normalize_fx, normalize_products, normalize_weather


def new_batch(spark: SparkSession, prefix: str) -> str:
    return spark.range(1).select(batch_id(prefix, F.current_timestamp())).first()[0]


def load_commerce(spark: SparkSession, folder: str, listed: Iterable[str] | None = None) -> dict[str, int]:
    """Refresh the five commerce tables from CSV files; rows by table."""
    batch = new_batch(spark, "olist")
    counts = load_tables(read_commerce_files(spark, folder, listed))
    append_audit(spark, "olist", batch, sum(counts.values()))
    return counts


def load_manifest(spark: SparkSession, folder: str, manifest: str) -> dict[str, int]:
    """Refresh the commerce tables whose files a manifest names, and no others; rows by table."""
    listed = manifest_files(spark, manifest)
    return load_commerce(spark, folder, listed) if listed else {}


def product_documents(payloads: DataFrame, batch: Column, ingested_at: Column, fallback: bool = False) -> DataFrame:
    """The accepted answers with a code, as documents of a batch."""
    code = strip(F.col("product.code"))
    return envelope(
        accepted_products(payloads).where(code != ""),
        [code.alias("product_code")],
        batch,
        ingested_at,
        F.struct("status", "product"),
        source_system="open_food_facts",
        fallback=fallback,
    )


def load_products(payloads: DataFrame, bronze: str, store: str | None = None, fallback: bool = False) -> int:
    """Refresh the food products from answers; the accepted answers are kept as documents."""
    return _load(
        payloads.sparkSession,
        "open_food_facts",
        "open-food-facts",
        "open_food_facts_products",
        normalize_products(payloads, F.current_timestamp()),
        lambda batch: product_documents(payloads, F.lit(batch), _now_text(), fallback),
        bronze,
        store,
    )


def load_weather(payloads: DataFrame, bronze: str, store: str | None = None) -> int:
    """Refresh the weather from daily series by city."""
    return _load(
        payloads.sparkSession,
        "open_meteo",
        "open-meteo",
        "open_meteo_weather",
        normalize_weather(payloads, F.current_timestamp()),
        lambda batch: envelope(payloads, [F.col("city")], F.lit(batch), _now_text(), F.struct("daily")),
        bronze,
        store,
    )


def load_fx(entries: DataFrame, bronze: str, store: str | None = None) -> int:
    """Refresh the exchange rates from entries; each entry is kept as a document."""
    return _load(
        entries.sparkSession,
        "frankfurter",
        "frankfurter",
        "frankfurter_fx_rates",
        normalize_fx(entries, F.current_timestamp()),
        lambda batch: envelope(entries, [], F.lit(batch), _now_text(), F.struct(*(c for c in entries.columns if c != "received"))),
        bronze,
        store,
    )


def load_fallback(rows: DataFrame, source: str, table: str, keys: list[str], bronze: str) -> int:
    """Refresh a table from made-up rows, chosen by the caller in place of a service."""
    return _load(
        rows.sparkSession,
        source,
        source.replace("_", "-"),
        table,
        rows,
        lambda batch: envelope(
            rows, [F.col(key) for key in keys], F.lit(batch), _now_text(), F.struct(*rows.columns), fallback=True
        ),
        bronze,
        None,
    )


def build_warehouse(spark: SparkSession) -> None:
    """Offer staging and intermediate relations as views and write the three marts."""
    staging = Staging.from_catalog(spark)
    context = orders_with_context(staging)
    sessions = click_sessions(staging.events)
    publish_views(
        {**staging.named(), "int_orders_with_context": context, "int_retailrocket_sessions": sessions}
    )
    materialize(commerce_orders(context), "fct_commerce_orders")
    materialize(sessions, "fct_retailrocket_sessions")
    materialize(product_dimension(staging.products, staging.food_products), "dim_products")


def session_job(spark: SparkSession, source: str, target: str, gap_minutes: int = 30) -> int:
    """Cut the click events of JSON lines into sessions and write them; sessions written."""
    events = job_clicks(read_click_lines(spark, source))
    return write_parquet(summarize(events, SessionRule.elapsed(gap_minutes)), target)


def _load(spark, source, prefix, table, rows, documents, bronze, store) -> int:
    batch = new_batch(spark, prefix)
    write_json_lines(documents(batch), f"{bronze}/{batch}")
    if store is not None:
        add_documents(documents(batch), store)
    loaded = refresh_raw(rows, table)
    append_audit(spark, source, batch, loaded)
    return loaded


def _now_text():
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
