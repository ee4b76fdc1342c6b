"""Plan parameters of the jobs."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# File to table, columns holding dates.
COMMERCE_FILES = {
    "olist_orders_dataset.csv": "olist_orders",
    "olist_order_items_dataset.csv": "olist_order_items",
    "olist_customers_dataset.csv": "olist_customers",
    "olist_products_dataset.csv": "olist_products",
    "olist_order_payments_dataset.csv": "olist_order_payments",
}

# Topics.
RAW_TOPIC = "retailrocket.events.raw"
EVENT_TOPICS = {
    "view": "retailrocket.events.view",
    "addtocart": "retailrocket.events.addtocart",
    "transaction": "retailrocket.events.transaction",
}
DEAD_LETTER_TOPIC = "retailrocket.events.dlq"

# Domains of the quality checks. The two status domains differ on purpose.
EVENT_TYPES = ("view", "addtocart", "transaction")
WAREHOUSE_STATUSES = ("delivered", "shipped", "processing", "invoiced", "approved")
SUITE_STATUSES = WAREHOUSE_STATUSES + ("created", "canceled", "unavailable")


@dataclass(frozen=True)
class TopicPlan:
    raw_topic: str = RAW_TOPIC
    by_type: dict[str, str] = field(default_factory=lambda: dict(EVENT_TOPICS))
    default: str = DEAD_LETTER_TOPIC


@dataclass(frozen=True)
class DayRange:
    """Inclusive date range; ``days`` keeps only the first so many dates."""

    start: date
    end: date
    days: int | None = 14


@dataclass(frozen=True)
class ReplayPlan:
    source: str
    output: str
    topics: TopicPlan = field(default_factory=TopicPlan)
    session_gap_minutes: int = 30
    watermark: str = "1 hour"
    kafka_servers: str | None = None
