"""Fixed schemas of the raw tables, as DDL."""

from __future__ import annotations

RAW_SCHEMAS = {
    "olist_orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_estimated_delivery_date timestamp"
    ),
    "olist_order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "price decimal(12,2), freight_value decimal(12,2)"
    ),
    "olist_customers": "customer_id string, customer_city string, customer_state string",
    "olist_products": (
        "product_id string, product_category_name string, product_name_length int, "
        "product_description_length int, product_photos_qty int, product_weight_g int"
    ),
    "olist_order_payments": (
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(12,2)"
    ),
    "retailrocket_events": (
        "event_id string, visitor_id string, event_type string, item_id string, "
        "transaction_id string, event_ts timestamp, kafka_topic string"
    ),
    "open_food_facts_products": (
        "product_code string, product_name string, brands string, categories string, "
        "image_front_url string, ecoscore_grade string, ingested_at timestamp"
    ),
    "open_meteo_weather": (
        "weather_date date, city string, avg_temperature_c decimal(8,2), "
        "precipitation_mm decimal(8,2), ingested_at timestamp"
    ),
    "frankfurter_fx_rates": (
        "rate_date date, base_currency string, quote_currency string, "
        "fx_rate decimal(18,8), ingested_at timestamp"
    ),
    "ingestion_audit": "source_name string, batch_id string, loaded_at timestamp, row_count bigint",
}

# One click event per JSON line, all fields text.
CLICK_JSON = (
    "event_id string, visitor_id string, event_type string, item_id string, "
    "transaction_id string, event_ts string"
)

PRODUCT_JSON = (
    "code string, product_name string, generic_name string, brands string, "
    "categories string, image_front_url string, ecoscore_grade string"
)
PRODUCT_PAYLOAD_JSON = f"status int, product struct<{PRODUCT_JSON.replace(' string', ': string')}>"
PRODUCT_SAMPLE_JSON = f"products array<struct<{PRODUCT_JSON.replace(' string', ': string')}>>"
WEATHER_PAYLOAD_JSON = (
    "daily struct<time: array<string>, temperature_2m_mean: array<double>, "
    "precipitation_sum: array<double>>"
)
FX_PAYLOAD_JSON = "date string, base string, quote string, rate decimal(18,8)"


def column_names(ddl_name: str) -> list[str]:
    """Column names of a raw table in order."""
    ddl = RAW_SCHEMAS[ddl_name].replace("(12,2)", "").replace("(8,2)", "").replace("(18,8)", "")
    return [part.split()[0] for part in ddl.split(",")]
