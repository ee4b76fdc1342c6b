"""Replay of click events: normalize, route, load, archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.plans.insights import topic_counts
from tillstream.schemas import CLICK_JSON
from tillstream.settings import ReplayPlan
from tillstream.sinks.files import add_documents, exists, progress_of, publish, write_json_lines, write_topics
from tillstream.sinks.tables import load_batch, refresh_raw
from tillstream.sources.clicks import fan_out, normalize_clicks, replay_documents


def start_replay(
    spark: SparkSession,
    plan: ReplayPlan,
    continuous: str | None = None,
    files_per_batch: int = 1_000,
    added: list[int] | None = None,
    table: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start the replay of a folder of JSON lines, from the earliest file on.

    Without ``continuous`` it ends when all present files are done; with an interval it keeps
    waiting for more. Each batch writes to folders of its own, so a repeated batch replaces
    its output. Documents and archive keep each line as ``received``. Order across files does not
    matter: sessions go by event time. ``added`` gets the number of documents each batch adds to
    the store. With ``table`` each batch becomes part of that table as soon as it is done; the
    table then holds the batches of this replay and nothing else.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(plan.source).where(F.col("value").rlike(r"\S"))
    parsed = F.from_json("value", CLICK_JSON, {"mode": "FAILFAST"})
    events = lines.select(parsed.alias("parsed"), F.col("value").alias("received")).select("parsed.*", "received")
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}

    def handle(batch: DataFrame, batch_number: int) -> None:
        count = _handle_batch(batch, batch_number, plan, "continuous" if continuous else "replay", spark, table)
        if added is not None:
            added.append(count)

    return (
        events.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint or f"{plan.output}/checkpoint")
        .trigger(**trigger)
        .start()
    )


def run_replay(spark: SparkSession, plan: ReplayPlan) -> dict[str, object]:
    """Replay all present files, then load them into the raw table; counts of what was done.

    Without any event the counts are zero and the table keeps its rows.
    """
    added: list[int] = []
    start_replay(spark, plan, added=added).awaitTermination()
    if not exists(spark, f"{plan.output}/events"):
        return {"record_count": 0, "table_rows": 0, "document_rows": 0, "topic_counts": {}}
    normalized = normalized_events(spark, plan)
    loaded = refresh_raw(normalized, "retailrocket_events", keep_if_empty=True)
    per_topic = {row["kafka_topic"]: row["row_count"] for row in topic_counts(normalized).collect()}
    return {
        "record_count": sum(per_topic.values()),
        "table_rows": loaded,
        "document_rows": sum(added),
        "topic_counts": per_topic,
    }


def normalized_events(spark: SparkSession, plan: ReplayPlan) -> DataFrame:
    """Events of all replayed batches, with parsed times."""
    events = spark.read.parquet(f"{plan.output}/events").drop("batch")
    return events.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def dead_letters(spark: SparkSession, plan: ReplayPlan) -> DataFrame:
    """Messages no typed topic wanted."""
    return spark.read.parquet(f"{plan.output}/topics").where(F.col("topic") == plan.topics.default)


def _handle_batch(batch: DataFrame, number: int, plan: ReplayPlan, mode: str, spark: SparkSession, table: str | None = None) -> int:
    events = batch.persist()
    try:
        normalized = normalize_clicks(events, plan.topics)
        documents = replay_documents(events, plan.topics)
        messages = fan_out(normalized, plan.topics)
        normalized.write.mode("overwrite").parquet(f"{plan.output}/events/batch={number}")
        if plan.kafka_servers:
            publish(messages, plan.kafka_servers)
        write_topics(messages, f"{plan.output}/topics/batch={number}")
        added = add_documents(documents, f"{plan.output}/documents", key="event_id")
        # The archive is most of what a replay writes: its lines hold each event twice.
        write_json_lines(documents, f"{plan.output}/replays/{number}_raw", "gzip")
        write_json_lines(normalized, f"{plan.output}/replays/{number}_normalized", "gzip")
        if table is not None:
            timed = normalized.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
            load_batch(timed, table, f"{plan.output}/table", number, spark)
        write_json_lines(progress_of(normalized, mode, plan.source), f"{plan.output}/progress/batch={number}")
        return added
    finally:
        events.unpersist()
