"""What the operators of this package share: reading, words, Arrow batches, tables between jobs."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.session import shared_folder

#: Separators of words: the ASCII white space. `bytes.split()` splits at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, what: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the folder shared by the cluster and read it back.

    This cuts the lineage: a lost executor cannot change or recompute what later jobs see.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, what: str) -> DataFrame:
    """``stored``, with less disk for more work: for tables that hold most of the texts."""
    return stored(df, what, "zstd")


def sized(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``max_rows`` narrow rows.

    Beyond that it comes back without a hint, so the join shuffles both sides.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


#: What a module of a Python process holds for the package from task to task, by attribute.
HELD = {"tokenizers": "tillstream_encoders"}


def give_back() -> None:
    """Return memory that is free inside this process to the machine; Spark keeps the process for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not every C library has it
        return


#: Rows of an Arrow batch of whole texts; Spark's own 10,000 take some 30 MB, several times over in a task and its process.
BATCH_ROWS = 1_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand rows to Python in batches of ``BATCH_ROWS`` at most; the session's setting comes back behind."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    # Zero and less stand for no bound.
    spark.conf.set(name, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def driver_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Few rows of the driver as a table. They go out by Arrow: rows as such would start Python processes of
    their own on the executors, which stay there beside those of the operators."""
    struct = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(struct)
    with small_batches(spark):
        return spark.createDataFrame(pa.table({name: list(column) for name, column in zip(struct.names, columns)}), struct)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, ``BATCH_ROWS`` at a time: for jobs that the caller runs."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` in a process that has let go of what tasks of other operators held, and gives back what it used."""

    def run(batches):
        for module, name in HELD.items():
            vars(sys.modules.get(module, sys)).pop(name, None)
        give_back()
        yield from fn(batches)
        give_back()

    return run


def over_batches(df: DataFrame, columns: list[str], fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Map the named columns of ``df`` by a function over Arrow batches."""
    return df.select(*columns).mapInArrow(lean(fn), schema)


def binary(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def strings(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, kept while the table is small; a lookup fills it."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    total = np.zeros(count, np.uint64)
    for i in range(width):
        total = total * _GOLDEN + words[i : i + count]
    return mix(total + np.uint64(width))


#: A bit filter has at most so many bits (16 MB), and at least so many for each key if they fit.
FILTER_LOG2 = 27
FILTER_BITS = 64


def bit_filter(keys: DataFrame) -> tuple[np.ndarray, int]:
    """(packed bits, logarithm of their number) of a filter over a column of 64-bit hashes.

    Each hash sets two bits. The size is bounded; an overfull filter lets more through, it loses none.
    """
    name = keys.columns[0]
    log2 = int(min(FILTER_LOG2, max(16, np.ceil(np.log2(FILTER_BITS * max(keys.count(), 1))))))
    slots = [F.shiftrightunsigned(name, 64 - log2), F.shiftrightunsigned(name, 64 - 2 * log2).bitwiseAND(F.lit((1 << log2) - 1))]
    slot = keys.select(F.explode(F.array(*slots)).alias("slot"))
    rows = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))
    found = rows.toPandas()
    bits = np.zeros(1 << (log2 - 6), np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits.view(np.uint8), log2


def passing(bits: np.ndarray, log2: int, hashes: np.ndarray) -> np.ndarray:
    """Indices of the hashes that both probes of the filter let through."""
    at = np.arange(len(hashes))
    for shift in (64 - log2, 64 - 2 * log2):
        slot = (hashes[at] >> np.uint64(shift)) & np.uint64((1 << log2) - 1)
        at = at[(bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at


def remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus``; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
