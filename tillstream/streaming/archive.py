"""Sessions over an event stream that are exact whatever the order of the events.

A window closed by a watermark loses the events that come later. Here every batch is first reduced
to parts of sessions, one row per (visitor, cell of gap length), and merged with the sessions of
its visitors in an archive: an event behind the watermark extends a session, joins two, or begins
one in the past. Such events are also listed apart, so it is known how many there were.

The archive is cut into buckets of visitors. A batch reads and writes the buckets of its visitors
only, each as a new version under the number of the batch, and is done once its progress record is
written: a repeated batch starts from the versions before it and replaces its own, so events
count once however often a batch runs. Readers take the newest versions that are done.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.sessions import COUNTS, SUMMARY_COLUMNS, SessionRule, identified, merge_parts, session_key, session_parts
from tillstream.sinks.files import folders, remove_folder

PART = (
    "visitor_id string, first_tick long, last_tick long, session_start_ts timestamp, session_end_ts timestamp,"
    f" event_count long, {', '.join(f'{name} long' for name in COUNTS)}, sample_item_id string"
)
PROGRESS = "newest_event_ts timestamp, event_count long, late_count long, untimed_count long"
LATE = "event_id string, visitor_id string, event_type string, item_id string, event_ts timestamp"
_VERSION = re.compile(r"/bucket=(\d+)/batch=(\d+)/?$")


@dataclass(frozen=True)
class SessionArchive:
    """An archive of sessions under ``path``. ``buckets`` and ``rule`` must not change in its life.

    An event is late if it is more than ``lateness_seconds`` older than the newest event of the
    batches before; it counts all the same. Events without id or visitor are dropped, and those
    without a time are counted and belong to no session.
    """

    path: str
    rule: SessionRule = field(default_factory=SessionRule.elapsed)
    buckets: int = 64
    lateness_seconds: int = 3600

    def start(self, events: DataFrame, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
        """Keep the archive of a stream of events; all available ones, or every ``continuous`` interval."""
        trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
        return events.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def merge(self, events: DataFrame, number: int) -> None:
        """Add the events of batch ``number``."""
        spark = events.sparkSession
        newest = self.progress(spark).where(F.col("batch") < number).agg(F.unix_micros(F.max("newest_event_ts"))).first()[0]
        seen = F.timestamp_micros(F.lit(newest).cast("long"))
        known = identified(events).select("event_id", "visitor_id", "event_type", "item_id", "event_ts").persist()
        try:
            bucket = F.pmod(F.xxhash64("visitor_id"), F.lit(self.buckets))
            timed = known.where("event_ts is not null")
            incoming = f"{self.path}/incoming"
            session_parts(timed, self.rule).withColumn("bucket", bucket).write.mode("overwrite").parquet(incoming)
            parts = spark.read.parquet(incoming)
            touched = [row["bucket"] for row in parts.select("bucket").distinct().collect()]
            before = self._state(spark, self._versions(spark, number - 1, touched))
            merged = merge_parts(parts.drop("bucket").unionByName(before), self.rule)
            versions = merged.withColumns({"bucket": bucket, "batch": F.lit(number)}).hint("rebalance", "bucket")
            writer = versions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("bucket", "batch").parquet(f"{self.path}/sessions")
            late = F.coalesce(F.col("event_ts") < seen - F.expr(f"interval {self.lateness_seconds} seconds"), F.lit(False))
            timed.where(late).write.mode("overwrite").parquet(f"{self.path}/late/batch={number}")
            known.agg(
                F.greatest(F.max("event_ts"), seen).alias("newest_event_ts"),
                F.count(F.lit(1)).alias("event_count"),
                F.count_if(late).alias("late_count"),
                F.count_if(F.col("event_ts").isNull()).alias("untimed_count"),
            ).write.mode("overwrite").parquet(f"{self.path}/progress/batch={number}")
        finally:
            known.unpersist()
        self._prune(spark, number)

    def sessions(self, spark: SparkSession) -> DataFrame:
        """All sessions with their numbers, open ones too; ``closed`` says that only a late event could change one."""
        done = self._done(spark)
        newest = self.progress(spark).agg(F.max(F.unix_timestamp("newest_event_ts"))).first()[0]
        state = self._state(spark, self._versions(spark, done))
        number = F.row_number().over(Window.partitionBy("visitor_id").orderBy("first_tick"))
        end = (F.col("last_tick") + self.rule.gap) * self.rule.tick_seconds
        closed = F.lit(False) if newest is None else end < newest - self.lateness_seconds
        numbered = state.withColumn("session_number", number).withColumn("session_key", session_key())
        return numbered.select(*SUMMARY_COLUMNS, closed.alias("closed"))

    def late_events(self, spark: SparkSession) -> DataFrame:
        """Events that came late, with the number of their batch."""
        return self._batches(spark, "late", LATE)

    def progress(self, spark: SparkSession) -> DataFrame:
        """One row per batch that is done: newest event so far, and counts of the batch's events."""
        return self._batches(spark, "progress", PROGRESS)

    def _batches(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        if not folders(spark, f"{self.path}/{name}/batch=*/_SUCCESS"):
            return spark.createDataFrame([], f"{schema}, batch int")
        return spark.read.schema(f"{schema}, batch int").parquet(f"{self.path}/{name}")

    def _done(self, spark: SparkSession) -> int:
        return max((int(p.split("batch=")[1].split("/")[0]) for p in folders(spark, f"{self.path}/progress/batch=*/_SUCCESS")), default=-1)

    def _versions(self, spark: SparkSession, last: int, wanted: list[int] | None = None) -> list[str]:
        """Folders of the newest version up to batch ``last`` of each wanted bucket."""
        best: dict[int, tuple[int, str]] = {}
        for path in folders(spark, f"{self.path}/sessions/bucket=*/batch=*"):
            bucket, batch = map(int, _VERSION.search(path).groups())
            if batch <= last and (wanted is None or bucket in wanted):
                best[bucket] = max(best.get(bucket, (-1, "")), (batch, path))
        return [path for _, path in best.values()]

    def _state(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return spark.read.schema(PART).parquet(*paths) if paths else spark.createDataFrame([], PART)

    def _prune(self, spark: SparkSession, number: int) -> None:
        """Remove versions that neither readers nor a repeated batch ``number`` can want."""
        versions = defaultdict(list)
        for path in folders(spark, f"{self.path}/sessions/bucket=*/batch=*"):
            bucket, batch = map(int, _VERSION.search(path).groups())
            versions[bucket].append((batch, path))
        for listed in versions.values():
            before = sorted(entry for entry in listed if entry[0] < number)
            for _, path in before[:-1]:
                remove_folder(spark, path)
