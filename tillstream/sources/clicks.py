"""Normalization of raw click events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.expressions import lenient_timestamp, topic_of
from tillstream.operators.sessions import identified
from tillstream.settings import TopicPlan


def normalize_clicks(events: DataFrame, topics: TopicPlan) -> DataFrame:
    """Text ids, lower-case type and the target topic.

    An event lacking its id, visitor, type or time fails the job, as the contract demands them.
    """
    def required(name: str) -> Column:
        missing = F.raise_error(F.lit(f"click event without {name}"))
        return F.when(F.col(name).isNull(), missing).otherwise(F.col(name))

    event_type = F.lower(required("event_type").cast("string"))
    return events.select(
        required("event_id").cast("string").alias("event_id"),
        required("visitor_id").cast("string").alias("visitor_id"),
        event_type.alias("event_type"),
        F.col("item_id").cast("string").alias("item_id"),
        F.col("transaction_id").cast("string").alias("transaction_id"),
        required("event_ts").alias("event_ts"),
        topic_of(event_type, topics).alias("kafka_topic"),
    )


def job_clicks(events: DataFrame) -> DataFrame:
    """Events of the sessionization job: lower-case type, parsed time, both ids present."""
    return identified(
        events.withColumn("event_type", F.lower("event_type")).withColumn(
            "event_ts", lenient_timestamp(F.col("event_ts").cast("string"))
        )
    )


def replay_documents(events: DataFrame, topics: TopicPlan) -> DataFrame:
    """Original events with the topic they were routed to and the time of the replay."""
    return events.withColumn("normalized_topic", topic_of(F.col("event_type"), topics)).withColumn(
        "replayed_at", F.current_timestamp()
    )


def fan_out(normalized: DataFrame, topics: TopicPlan) -> DataFrame:
    """Every event twice, for the raw topic and for its own, as key and JSON value."""
    value = F.to_json(F.struct(*normalized.columns), {"ignoreNullFields": "false"})
    return normalized.select(
        F.explode(F.array(F.lit(topics.raw_topic), "kafka_topic")).alias("topic"),
        F.col("event_id").alias("key"),
        value.alias("value"),
    )
