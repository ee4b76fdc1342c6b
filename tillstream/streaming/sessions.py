"""Sessions over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.expressions import count_of
from tillstream.operators.sessions import COUNTS, identified
from tillstream.schemas import CLICK_JSON
from tillstream.sources.clicks import job_clicks

# Sessions of a visitor are merged before the shuffle, so a hot visitor sends few rows.
MERGE_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def click_stream(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """Click events from a folder of JSON lines, as files arrive."""
    lines = spark.readStream.schema(CLICK_JSON).option("maxFilesPerTrigger", files_per_batch).json(path)
    return job_clicks(lines)


def once_per_event(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop redelivered events that arrive within the watermark."""
    return events.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(["event_id"])


def session_stream(
    events: DataFrame, gap_minutes: int = 30, watermark: str = "1 hour", distinct_events: bool = False
) -> DataFrame:
    """Closed sessions by inactivity, in whole seconds as in the elapsed rule.

    With ``distinct_events`` a redelivered event counts once.

    A session is emitted once the watermark has passed its end. There is no session number: it
    would need every earlier session of the visitor, so visitor and start are the key.
    """
    events.sparkSession.conf.set(MERGE_EARLY, "true")
    seconds = (
        identified(events)
        .withColumn("event_second", F.date_trunc("second", "event_ts"))
        .withWatermark("event_second", watermark)
    )
    if distinct_events:
        seconds = seconds.dropDuplicatesWithinWatermark(["event_id"])
    return (
        seconds.groupBy(F.session_window("event_second", f"{gap_minutes} minutes"), "visitor_id")
        .agg(
            F.min("event_ts").alias("session_start_ts"),
            F.max("event_ts").alias("session_end_ts"),
            F.count(F.lit(1)).alias("event_count"),
            *(count_of(F.col("event_type") == kind).alias(name) for name, kind in COUNTS.items()),
            F.min("item_id").alias("sample_item_id"),
        )
        .drop("session_window")
    )


def write_closed_sessions(sessions: DataFrame, path: str, checkpoint: str, continuous: str | None = None):
    """Append closed sessions as files; all available input once, or every ``continuous`` interval."""
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        sessions.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def click_messages(spark: SparkSession, servers: str, topic: str, group: str | None = None) -> DataFrame:
    """Click events from a broker topic, from its earliest message on.

    Needs the Kafka connector on the class path. Messages are keyed by event id, so the events
    of a visitor arrive in any order; sessions go by event time.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if group is not None:
        reader = reader.option("kafka.group.id", group)
    parsed = reader.load().select(F.from_json(F.col("value").cast("string"), CLICK_JSON).alias("event"))
    return job_clicks(parsed.select("event.*"))
