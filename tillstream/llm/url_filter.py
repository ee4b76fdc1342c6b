"""URL filters: rules over host and path, then a block list kept as sorted 64-bit digests.

The block list becomes files in the shared folder: sorted xxhash64 digests, offsets, strings. Every
executor maps the files into memory; the digests of a batch of hosts are looked up by one binary
search, and what is found is compared with the string stored.
"""

from __future__ import annotations

import mmap
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import shared_folder

from .common import strings

#: Fixed values: (host, path, verdict); of those that fit the longest counts.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Names that are blocked below each of these domains.
BLOCKED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_DOMAINS = ("example.com", "example.net", "example.org")
#: Strings of a file of digests.
FILE_STRINGS = 4_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def default_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"{name}.{domain}",) for name in BLOCKED_NAMES for domain in BLOCKED_DOMAINS], "entry string")


def encode_digests(shard: int, shards: int, entries: list[bytes]) -> bytes:
    digests = np.array([xxhash.xxh64_intdigest(entry) for entry in entries], "<u8")
    order = np.lexsort((np.arange(len(entries)), digests))
    blob = [entries[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(entry) for entry in blob])]).astype("<u8")
    return np.array([shard, shards, len(entries)], "<u8").tobytes() + digests[order].tobytes() + offsets.tobytes() + b"".join(blob)


class Digests:
    """One file of digests, mapped into memory."""

    def __init__(self, data):
        self.shard, self.shards, count = (int(x) for x in np.frombuffer(data, "<u8", 3))
        self.digests = np.frombuffer(data, "<u8", count, 24)
        self.offsets = np.frombuffer(data, "<u8", count + 1, 24 + 8 * count)
        self.data, self.begin = data, 32 + 16 * count

    def entry(self, i: int) -> bytes:
        return bytes(self.data[self.begin + int(self.offsets[i]) : self.begin + int(self.offsets[i + 1])])

    def holds(self, digests: np.ndarray, entries: list[bytes]) -> np.ndarray:
        at = np.searchsorted(self.digests, digests)
        found = np.zeros(len(entries), bool)
        inside = at < len(self.digests)
        for i in np.flatnonzero(inside)[self.digests[at[inside]] == digests[inside]]:
            k = at[i]
            while k < len(self.digests) and self.digests[k] == digests[i] and not found[i]:
                found[i] = self.entry(k) == entries[i]
                k += 1
        return found


def publish(entries: DataFrame) -> list[str]:
    """Write the distinct non-null strings of a one-column frame as files of digests; their names.

    The files are written by Spark to the shared folder, dealt by their digests, and fetched by
    each executor once.
    """
    spark = entries.sparkSession
    listed = entries.select(F.col(entries.columns[0]).alias("entry")).where("entry is not null").distinct()
    shards = 1 << max(0, int(np.ceil(np.log2(max(listed.count(), 1) / FILE_STRINGS))))
    log2 = shards.bit_length() - 1
    shard = F.shiftrightunsigned(F.xxhash64("entry"), 64 - log2) if log2 else F.lit(0).cast("long")

    def build(key, group):
        rows = sorted(entry.encode() for entry in group.column("entry").to_pylist())
        return pa.table({"content": pa.array([encode_digests(int(key[0].as_py()), shards, rows)], pa.binary())})

    path = f"{shared_folder(spark).rstrip('/')}/llm-digests-{uuid.uuid4().hex}"
    files = listed.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "content binary")
    files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()
    for row in found:
        spark.sparkContext.addFile(row["path"])
    return [row["path"].rsplit("/", 1)[1] for row in found]


def suffixes(host: str) -> list[bytes]:
    """The host and the domains above it."""
    labels = host.split(".")
    return [".".join(labels[i:]).encode() for i in range(len(labels))] if host else []


def split_url(url):
    """(host, path) of a url column; both empty if it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _UPPER.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def judge_urls(
    pages: DataFrame,
    blocked: DataFrame | None = None,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict) per row of ``pages``.

    The longest rule that fits gives the verdict, of equally long ones the first; else the block list
    does: a host is blocked if it or a domain above it is listed. Null, empty and malformed urls have
    an empty host and path and are allowed.
    """
    names = publish(blocked if blocked is not None else default_list(pages.sparkSession))
    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("link")).select("id", *(c.alias(n) for c, n in zip(split_url("link"), ("host", "path"))))
    rule = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for host, path, says in sorted(reversed(rules), key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    ruled = parts.select("id", "host", "path", rule.alias("rule"), verdict.alias("says"))

    def probe(batches):
        files = None
        for batch in batches:
            if files is None:
                files = []
                for name in names:
                    with open(SparkFiles.get(name), "rb") as file:
                        files.append(Digests(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)))
            hosts = strings(batch, "host")
            entries = list({entry for host in set(hosts) for entry in suffixes(host)})
            digests = np.array([xxhash.xxh64_intdigest(entry) for entry in entries], np.uint64)
            listed = np.zeros(len(entries), bool)
            for file in files:
                listed |= file.holds(digests, entries)
            bad = {entry for entry, found in zip(entries, listed) if found}
            verdicts = [
                says or ("block" if any(entry in bad for entry in suffixes(host)) else "allow")
                for host, says in zip(hosts, strings(batch, "says"))
            ]
            yield pa.record_batch([*(batch.column(k) for k in range(4)), pa.array(verdicts, pa.string())], names=[id_col, "host", "path", "rule", "verdict"])

    kind = pages.schema[id_col].dataType.simpleString()
    return ruled.mapInArrow(probe, f"{id_col} {kind}, host string, path string, rule string, verdict string")
