"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks.

Sources are cut into shards, and the whole mix into blocks of equally many words. The blocks are
seats, given to shards by the highest quotients of their target over 1, 3, 5, ... A shard's quota is
a number of whole copies and a rest; the rest is met by the blocks of its documents with the least
seeded hashes.
"""

from __future__ import annotations

from fractions import Fraction
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary, driver_table, lean, mix, over_batches, parts, sized, stored

WEIGHTS = (3, 1, 2)
#: Words of a block, and of a shard about.
BLOCK = 16
SHARD_WORDS = 4_000_000
#: Rows of the table of shards that are broadcast at most.
SHARD_ROWS = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, percent: int = 150, most: int = 2) -> list[float]:
    """Words wanted of each source: shares by weight, at most ``most`` times its size, the excess reshared."""
    size = np.array(sizes, float)
    weight = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    want = np.zeros(len(sizes))
    left, open_ = size.sum() * percent / 100, size > 0
    while open_.any():
        share = left * weight / weight[open_].sum()
        over = open_ & (share > most * size)
        if not over.any():
            want[open_] = share[open_]
            break
        want[over] = most * size[over]
        left -= want[over].sum()
        open_ &= ~over
    return want.tolist()


def apportion(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients of votes over 1, 3, 5, ...; the first of equal quotients wins."""
    votes = votes.astype(float)
    if not len(votes) or votes.sum() <= 0 or seats <= 0:
        return np.zeros(len(votes), np.int64)
    # With divisor d a party has round(votes / d) seats; find a d that gives not too many.
    low, high = 0.0, 2 * votes.sum() + 1
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if np.floor(votes / middle + 0.5).sum() > seats:
            low = middle
        else:
            high = middle
    # A little less than that for certain, so that a seat of equal quotients is still to be given.
    got = np.maximum(np.floor(votes / high * (1 - 1e-12) + 0.5 - 1e-9), 0).astype(np.int64)
    rest = seats - int(got.sum())
    if rest > 0:
        # Only the highest quotients can win one of the rest; these are compared as exact fractions.
        quotient = votes / (2 * got + 1)
        least = np.partition(quotient, -min(rest, len(votes)))[-min(rest, len(votes))]
        chosen = np.flatnonzero(quotient >= least * (1 - 1e-9)).tolist()
        heap = [(-Fraction(votes[i]) / int(2 * got[i] + 1), i) for i in chosen]
        heapify(heap)
        for _ in range(rest):
            i = heap[0][1]
            got[i] += 1
            heapreplace(heap, (-Fraction(votes[i]) / int(2 * got[i] + 1), i))
    return got


def block_hashes(key: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each block of rows that have so many."""
    row = np.repeat(np.arange(len(key)), blocks)
    place = np.arange(len(row)) - np.repeat(blocks.cumsum() - blocks, blocks)
    return row, mix(key[row] + _STEP * place.astype(np.uint64)) >> np.uint64(1)


def block_sizes(size: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of each row, words of each block); only a document's last block may be short."""
    blocks = -(-size // block)
    words = np.full(int(blocks.sum()), block, np.int64)
    last = blocks.cumsum()[blocks > 0] - 1
    words[last] = (size - (blocks - 1) * block)[blocks > 0]
    return blocks, words


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(id, source, key, size): words of each document and a seeded hash of it."""
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col))

    def count(batches):
        for batch in batches:
            sizes = [len((text or b"").split()) for text in binary(batch, "body")]
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64())], names=["id", "source", "key", "size"])

    kinds = {name: docs.schema[name].dataType.simpleString() for name in (id_col, source_col)}
    keyed = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), key.alias("key"), F.col(text_col).alias("body"))
    return over_batches(keyed, ["id", "source", "key", "body"], count, f"id {kinds[id_col]}, source {kinds[source_col]}, key long, size long")


def plan_mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, most: int = 2, block: int = BLOCK) -> DataFrame:
    """(source, pieces, shard, source_size, target, copies, bound) per shard of measured rows.

    The driver gets one row per source and one per shard of some millions of words.
    """
    spark = rows.sparkSession
    totals = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    totals.sort(key=lambda row: (row["source"] is None, row["source"] if row["source"] is not None else ""))
    want = targets([row["size"] for row in totals], weights, percent, most)
    kind = rows.schema["source"].dataType.simpleString()
    sources = driver_table(
        spark,
        [(row["source"], row["size"], t, row["size"] // SHARD_WORDS + 1) for row, t in zip(totals, want)],
        f"source {kind}, source_size long, target double, pieces long",
    )
    placed = in_shards(rows, sources)
    shards = placed.groupBy("source", "source_size", "target", "pieces", "shard").agg(F.sum("size").alias("words"))
    # A total order of the shards decides between equal quotients.
    cells = shards.orderBy(F.col("source").asc_nulls_last(), "shard").collect()
    words = np.array([row["words"] for row in cells], float)
    votes = np.array([row["target"] * row["words"] / max(row["source_size"], 1) for row in cells], float)
    quota = apportion(votes, int(round(votes.sum() / block))) * block
    quota = np.minimum(quota, most * words).astype(np.int64)
    copies = np.where(words > 0, quota // np.maximum(words, 1), 0).astype(np.int64)
    rest = (quota - copies * words).astype(np.int64)
    planned = driver_table(
        spark,
        [(row["source"], row["shard"], int(c), int(r)) for row, c, r in zip(cells, copies, rest)],
        f"source {kind}, shard long, copies long, rest long",
    )
    planned = sized(stored(planned, "quotas"), SHARD_ROWS)
    matched = placed.join(planned.select(F.col("source").alias("s"), F.col("shard").alias("p"), "copies", "rest"), F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("p"))).drop("s", "p")

    def bound(group):
        key = group.column("key").to_numpy().view(np.uint64)
        size = group.column("size").to_numpy()
        rest = group.column("rest")[0].as_py()
        blocks, words = block_sizes(size, block)
        _, hashes = block_hashes(key, blocks)
        order = np.argsort(hashes, kind="stable")
        filled = words[order].cumsum()
        # The number of blocks, none included, whose words come nearest to the rest.
        taken = int(np.searchsorted(filled, rest, "left")) if rest else 0
        if taken < len(filled) and rest and abs(filled[taken] - rest) <= rest - (filled[taken - 1] if taken else 0):
            taken += 1
        limit = int(hashes[order[taken - 1]]) if taken else -1
        first = group.slice(0, 1)
        return pa.table({name: first.column(name) for name in ("source", "source_size", "target", "pieces", "shard", "copies")} | {"bound": pa.array([limit], pa.int64())})

    columns = f"source {kind}, source_size long, target double, pieces long, shard long, copies long, bound long"
    return matched.groupBy("source", "shard").applyInArrow(bound, columns)


def in_shards(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's columns and their shard. ``sources`` has one row per source."""
    small = sized(sources.withColumnRenamed("source", "s"), SHARD_ROWS)
    joined = rows.join(small, rows["source"].eqNullSafe(small["s"])).drop("s")
    return joined.withColumn("shard", F.pmod(F.shiftright("key", 3), F.col("pieces")))


def taken_blocks(key: np.ndarray, size: np.ndarray, bound: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, words, whether its hash is within the bound) of each block."""
    blocks, words = block_sizes(size, block)
    row, hashes = block_hashes(key, blocks)
    return row, words, hashes.astype(np.int64) <= bound[row]


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = 150,
    most: int = 2,
    block: int = BLOCK,
    seed: int = 11,
) -> DataFrame:
    """(id, size, source_size, target, taken) per row of ``docs``.

    Null, empty and white-space texts have size 0 and give nothing. Rows without a source are a
    source of their own, the last one. Repeated rows are taken alike. Reruns agree, whatever the
    partitions are.
    """
    rows = stored(measured(docs, id_col, text_col, source_col, seed), "sizes")
    plan = stored(plan_mix(rows, weights, percent, most, block), "plan")
    sources = plan.select("source", "source_size", "target", "pieces").distinct()
    placed = in_shards(rows, sources)
    shards = sized(plan.select(F.col("source").alias("s"), F.col("shard").alias("p"), "copies", "bound"), SHARD_ROWS)
    joined = placed.join(shards, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("p")))

    def take(batches):
        for batch in batches:
            key, size, copies, bound = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("key", "size", "copies", "bound"))
            row, words, inside = taken_blocks(key.view(np.uint64), size, bound, block)
            taken = copies * size + np.bincount(row, words * inside, len(size)).astype(np.int64)
            yield pa.record_batch([*(batch.column(k) for k in range(4)), pa.array(taken)], names=[id_col, "size", "source_size", "target", "taken"])

    kind = docs.schema[id_col].dataType.simpleString()
    return over_batches(
        joined, ["id", "size", "source_size", "target", "key", "copies", "bound"], take,
        f"{id_col} {kind}, size long, source_size long, target double, taken long",
    )


def mixed_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = 150,
    most: int = 2,
    block: int = BLOCK,
    seed: int = 11,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each whole copy of a document is a row with its text
    as it was, and the blocks taken beyond are one more row with the words of these blocks, a blank
    between words. Together the rows have as many words as ``mix_sources`` says are taken.
    """
    rows = stored(measured(docs, id_col, text_col, source_col, seed), "sizes")
    plan = stored(plan_mix(rows, weights, percent, most, block), "plan")
    columns = docs.columns
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)).alias("mix_key")
    whole = docs.select(F.struct(*columns).alias("whole"), F.col(source_col).alias("source"), key.alias("key"), F.col(text_col).alias("body"))
    placed = in_shards(whole, plan.select("source", "pieces").distinct())
    shards = sized(plan.select(F.col("source").alias("s"), F.col("shard").alias("p"), "copies", "bound"), SHARD_ROWS)
    joined = placed.join(shards, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("p")))

    def take(batches):
        for batch in parts(batches):
            body = binary(batch, "body")
            key, copies, bound = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("key", "copies", "bound"))
            texts, rows_out = [], []
            for i, text in enumerate(body):
                words = (text or b"").split()
                if not words:
                    continue
                texts += [text] * int(copies[i])
                rows_out += [i] * int(copies[i])
                _, _, inside = taken_blocks(key[i : i + 1].view(np.uint64), np.array([len(words)]), bound[i : i + 1], block)
                if inside.any():
                    chosen = [w for b in np.flatnonzero(inside) for w in words[b * block : (b + 1) * block]]
                    texts.append(b" ".join(chosen))
                    rows_out.append(i)
            taken = batch.column(0).take(pa.array(rows_out, pa.int64()))
            yield pa.record_batch([taken, pa.array(texts, pa.binary()).cast(pa.string())], names=["whole", "body"])

    kind = joined.schema["whole"].dataType.simpleString()
    out = joined.select("whole", "body", "key", "copies", "bound").mapInArrow(lean(take), f"whole {kind}, body string")
    return out.select(*(F.col("body").alias(c) if c == text_col else F.col("whole")[c].alias(c) for c in columns))
