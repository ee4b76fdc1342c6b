"""File sinks: session summaries, JSON lines, bronze documents, topics, replay archive."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.upserts import one_per_key, unseen

LOGGER = logging.getLogger(__name__)


def write_parquet(df: DataFrame, path: str) -> int:
    """Replace the files under ``path``; the count is taken while writing."""
    counted = Observation(f"rows of {path}")
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return counted.get["rows"]


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """One document per line, nulls included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path, compression=compression)


#: Buckets of a document store, by the hash of the key. It must not change in the life of a store.
STORE_BUCKETS = 64


def add_documents(df: DataFrame, path: str, key: str | None = None) -> int:
    """Append documents to a bronze store and return how many were added.

    With a ``key``, copies within the input and documents stored before are ignored. Such a store
    lies in buckets of the key, and a load reads the keys of the buckets that it touches, nothing
    else. If the store cannot be reached, the load goes on and 0 is returned; a job that fails is
    an error.
    """
    spark = df.sparkSession
    if not reachable(spark, path):
        LOGGER.warning("documents were not stored: %s cannot be reached", path)
        return 0
    counted = Observation(f"documents of {path}")
    if key is None:
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
        return counted.get["rows"]
    bucket = F.pmod(F.xxhash64(key), F.lit(STORE_BUCKETS)).cast("int").alias("bucket")
    touched = [row["bucket"] for row in df.select(bucket).distinct().collect()]
    kind = df.select(key).schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ", 1)
    stored = spark.read.schema(f"{kind}, bucket int").parquet(path).where(F.col("bucket").isin(touched)).select(key)
    new = unseen(one_per_key(df, [key], []), stored, [key])
    dealt = new.select("*", bucket).hint("rebalance", "bucket")
    dealt.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy("bucket").parquet(path)
    return counted.get["rows"]


def reachable(spark: SparkSession, path: str) -> bool:
    """Whether the folder ``path`` is there or can be made."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jvm_path)
    except Py4JJavaError:
        LOGGER.warning("no folder %s", path, exc_info=True)
        return False


def write_topics(messages: DataFrame, path: str) -> None:
    """Messages as files, one folder per topic."""
    messages.write.mode("overwrite").partitionBy("topic").parquet(path)


def write_kafka(messages: DataFrame, servers: str) -> None:
    """Messages to a broker, keyed; needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def publish(messages: DataFrame, servers: str) -> bool:
    """Messages to a broker if it takes them; else a warning, and the replay goes on without."""
    try:
        write_kafka(messages, servers)
    except (Py4JJavaError, PySparkException):
        LOGGER.warning("messages were not published to %s", servers, exc_info=True)
        return False
    return True


def progress_of(normalized: DataFrame, mode: str, source: str) -> DataFrame:
    """Progress record of a replay: number of records and greatest event time.

    Times that are still text are parsed first: their order as text is not that of the times.
    """
    time = F.col("event_ts")
    if dict(normalized.dtypes)["event_ts"] == "string":
        time = F.try_to_timestamp(time)
    return normalized.agg(
        F.count(F.lit(1)).alias("record_count"), F.max(time).alias("last_event_ts")
    ).select(
        F.lit(mode).alias("mode"),
        F.lit(source).alias("replay_source"),
        "record_count",
        "last_event_ts",
        F.current_timestamp().alias("updated_at"),
    )


def _at(spark: SparkSession, path: str):
    """(file system, path) of a path, as the JVM knows them."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    system, jvm_path = _at(spark, path)
    return system.exists(jvm_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the catalog writes it."""
    system, jvm_path = _at(spark, path)
    return system.makeQualified(jvm_path).toString()


def make_folder(spark: SparkSession, path: str) -> None:
    system, jvm_path = _at(spark, path)
    system.mkdirs(jvm_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    system, jvm_path = _at(spark, path)
    system.delete(jvm_path, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder, in place of one that may be there."""
    system, jvm_target = _at(spark, target)
    system.delete(jvm_target, True)
    if not system.rename(_at(spark, source)[1], jvm_target):
        raise OSError(f"cannot move {source} to {target}")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of the file system."""
    system, jvm_path = _at(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(jvm_path) or []]
