"""Benchmark decontamination by spaced seeds.

A seed is what a mask shows of the words: it ignores the words at some places, which may differ.
For every length of item there are up to three masks such that, however the words that may differ
lie in a window, one mask at one place meets none of them; so seeds miss no alignment that
verification would accept (a test tries all patterns of changes). Because of their gaps the masks
show more words than the longest run that is sure to be left unchanged: six of a window of 20,
where the run has four. Hashes of benchmark items and of documents are joined; around each hit the
words are compared along the hit's alignment, and an item counts as found if most words of a long
enough window agree.

Before the join, documents drop seeds that cannot match by a bit filter over the benchmark's seeds.
Its size is bounded; a filter that is too small lets more seeds through but loses none.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bit_filter, lists, mix, over_batches, passing, stored, strings

#: Words of the window that is verified, and the percentage of them that must agree.
WINDOW = 20
PERCENT = 80
#: Documents are searched together up to about so many words.
WORDS_AT_ONCE = 50_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: ASCII letters in lower case, other ASCII characters but digits as blanks.
_PLAIN = bytes(
    c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    return (text or "").lower().encode().translate(_PLAIN).split()


#: Places that a mask shows, by the words of an item (of its window, if it is longer). In four words none may differ.
MASKS: dict[int, tuple[tuple[int, ...], ...]] = {
    1: ((0,),),
    2: ((0, 1),),
    3: ((0, 1, 2),),
    4: ((0, 1, 2, 3),),
    5: ((0, 1, 3), (0, 2, 3)),
    6: ((0, 1, 2, 4), (0, 2, 3, 4)),
    7: ((0, 1, 2, 3, 5), (0, 1, 3, 4, 5), (0, 2, 3, 4, 5)),
    8: ((0, 1, 2, 3, 4, 6), (0, 1, 2, 4, 5, 6), (0, 2, 3, 4, 5, 6)),
    9: ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 5, 6)),
    10: ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 5, 7)),
    11: ((0, 1, 3, 5, 6), (0, 1, 2, 5, 6)),
    12: ((0, 1, 2, 4, 6, 7), (0, 2, 3, 6, 7, 8), (0, 1, 2, 3, 4, 6)),
    13: ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7)),
    14: ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7)),
    15: ((0, 1, 2, 3, 5, 6), (0, 1, 4, 8, 9, 10), (0, 1, 3, 5, 6, 10)),
    16: ((0, 1, 2, 3, 5, 6), (0, 2, 3, 11, 12, 13), (0, 1, 2, 4, 5, 6)),
    17: ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 8, 9)),
    18: ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 8, 9)),
    19: ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 8, 9)),
    20: ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 8, 9), (0, 1, 2, 4, 5, 6)),
}
#: Words from the first to the last place of the longest mask.
SPAN = 1 + max(mask[-1] for masks in MASKS.values() for mask in masks)


def masks_of(count: int) -> tuple[tuple[int, ...], ...]:
    """The masks of an item of ``count`` words."""
    return MASKS[min(count, WINDOW)]


def seeds(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of what the mask shows at each place."""
    count = max(len(words) - mask[-1], 0)
    total = np.full(count, sum(1 << place for place in mask), np.uint64)
    for place in mask:
        total = total * _GOLDEN + words[place : place + count]
    return mix(total)


def benchmark_seeds(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, hash, offset, mask): each seed of each item once; a mask is told by the bits of its places."""

    def cut(batches):
        hashes = WordHashes()
        for batch in batches:
            for item, text in zip(batch.column(0), strings(batch, text_col)):
                words = hashes.of(plain_words(text))
                for mask in masks_of(len(words)) if len(words) else ():
                    found, bits = seeds(words, mask), sum(1 << place for place in mask)
                    yield pa.record_batch(
                        [pa.array([item.as_py()] * len(found), batch.column(0).type), pa.array(found.view(np.int64)), pa.array(np.arange(len(found))), pa.array(np.full(len(found), bits))],
                        names=["item", "hash", "offset", "mask"],
                    )

    kind = benchmark.schema[id_col].dataType.simpleString()
    return over_batches(benchmark.where(F.col(id_col).isNotNull()), [id_col, text_col], cut, f"item {kind}, hash long, offset long, mask long").distinct()


def _grouped(texts) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Consecutive texts with words, about WORDS_AT_ONCE in all, as (number of the first, texts)."""
    first, size, group = 0, 0, []
    for words in texts:
        if group and size + len(words) > WORDS_AT_ONCE:
            yield first, group
            first, size, group = first + len(group), 0, []
        group.append(words)
        size += len(words)
    if size:
        yield first, group


def find_hits(docs: DataFrame, bits: np.ndarray, log2: int, masks: list[tuple[int, ...]], id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, part, words, hits): stretches of documents around seeds that pass the filter."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def stretches_of(texts: list[np.ndarray]):
        """(text, words, places of hits, their hashes) of each stretch of several texts, sought together."""
        ends = np.cumsum([len(words) for words in texts])
        words = np.concatenate(texts)
        ats, keys = [], []
        for mask in masks:
            found = seeds(words, mask)
            at = passing(sent.value, log2, found)
            # A seed that reaches into the next text is none.
            at = at[at + mask[-1] < ends[np.searchsorted(ends, at, side="right")]]
            ats.append(at)
            keys.append(found[at])
        at, key = np.concatenate(ats), np.concatenate(keys)
        order = np.argsort(at, kind="stable")
        at, key = at[order], key[order]
        text = np.searchsorted(ends, at, side="right")
        breaks = np.flatnonzero((np.diff(at) > SPAN + 2 * WINDOW) | (np.diff(text) > 0)) + 1
        for first, behind in zip(np.append(0, breaks), np.append(breaks, len(at))) if len(at) else ():
            row = text[first]
            begin = max(at[first] - WINDOW, ends[row] - len(texts[row]))
            stop = min(at[behind - 1] + SPAN + WINDOW, ends[row])
            yield row, words[begin:stop], at[first:behind] - begin, key[first:behind]

    def scan(batches):
        hashes = WordHashes()
        for batch in batches:
            texts = strings(batch, "body")
            for rows, group in _grouped(map(hashes.of, map(plain_words, texts))):
                found = list(stretches_of(group))
                if not found:
                    continue
                taken = batch.take(pa.array([rows + int(row) for row, *_ in found]))
                parts = [int.from_bytes(os.urandom(8), "little", signed=True) for _ in found]
                yield pa.record_batch(
                    [
                        taken.column(0), taken.column(2), pa.array(parts, pa.int64()), lists([w.view(np.int64) for _, w, _, _ in found], pa.int64()),
                        lists([at for _, _, at, _ in found], pa.int64()), lists([key.view(np.int64) for *_, key in found], pa.int64()),
                    ],
                    names=["id", "text_key", "part", "words", "ats", "hashes"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), F.xxhash64(text_col).alias("text_key"))
    return over_batches(
        keyed, ["id", "body", "text_key"], scan, f"id {kind}, text_key long, part long, words array<long>, ats array<long>, hashes array<long>"
    )


def agreement(document: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int]:
    """(agreeing words in the best window, window, agreeing words in all) along a diagonal."""
    first = max(0, -diagonal)
    last = min(len(item), len(document) - diagonal)
    same = np.zeros(len(item), np.int64)
    if last > first:
        same[first:last] = item[first:last] == document[first + diagonal : last + diagonal]
    window = min(len(item), WINDOW)
    total = np.concatenate([[0], same.cumsum()])
    return int((total[window:] - total[:-window]).max()) if window else 0, window, int(same.sum())


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, text_key, item, matched, window): benchmark items found in documents.

    An item is found if, along one alignment, at least 80 % of the words of a window of 20 item words
    agree (of the whole item if it is shorter). Words are compared in lower case without ASCII
    punctuation. Items without id or words are never reported. Null and empty texts hold nothing. Rows without an id are searched, too;
    ``text_key`` (xxhash64 of the text) tells rows that share an id apart. Repeated rows give one
    result row.
    """
    found = stored(benchmark_seeds(benchmark, item_col, item_text_col), "seeds")
    bits, log2 = bit_filter(found.select("hash"))
    used = {row["mask"] for row in found.select("mask").distinct().collect()}
    # The masks that the benchmark has, at most as many as there are in all; without items one that finds nothing.
    shown = {sum(1 << place for place in mask): mask for masks in MASKS.values() for mask in masks}
    masks = [mask for bits_of, mask in sorted(shown.items()) if bits_of in used] or [MASKS[1][0]]
    stretches = stored(find_hits(docs, bits, log2, masks, id_col, text_col), "stretches")
    hits = stretches.select("part", F.explode(F.arrays_zip("ats", "hashes")).alias("hit")).select("part", "hit.ats", F.col("hit.hashes").alias("hash"))
    aligned = hits.join(found, "hash").select("part", "item", (F.col("ats") - F.col("offset")).alias("diagonal")).distinct()
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).alias("item_text"))
    both = aligned.join(stretches.select("id", "text_key", "part", "words"), "part").join(items, "item")

    def compare(batches):
        hashes = WordHashes()
        for batch in batches:
            known: dict[str, np.ndarray] = {}
            results = []
            texts = strings(batch, "item_text")
            for document, text, diagonal in zip(batch.column(3), texts, batch.column(4).to_pylist()):
                if text not in known:
                    known[text] = hashes.of(plain_words(text)).view(np.int64)
                results.append(agreement(document.values.to_numpy(), known[text], diagonal))
            best, window, matched = (np.array(x, np.int64) for x in zip(*results)) if results else (np.zeros(0, np.int64),) * 3
            keep = pa.array(100 * best >= PERCENT * np.maximum(window, 1))
            out = pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(matched), pa.array(window)],
                names=["id", "text_key", "item", "matched", "window"],
            )
            yield out.filter(keep)

    kinds = (docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString())
    checked = over_batches(
        both, ["id", "text_key", "item", "words", "diagonal", "item_text"], compare,
        f"id {kinds[0]}, text_key long, item {kinds[1]}, matched long, window long",
    )
    return (
        checked.groupBy("id", "text_key", "item").agg(F.max("matched").alias("matched"), F.max("window").alias("window"))
        .select(F.col("id").alias(id_col), "text_key", F.col("item").alias(item_col if item_col != id_col else "item"), "matched", "window")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    found = contaminated(docs, benchmark, id_col, text_col, **columns)
    bad = found.select(F.col(id_col).alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs[text_col]) == bad["bad_key"]), "left_anti")
