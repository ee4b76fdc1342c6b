"""Byte strings that repeat anywhere in the corpus, found on enhanced suffix arrays; later copies go.

A string of ``WIDTH`` bytes is repeated if it also starts earlier: in a document of smaller id, or
earlier in the same one. All bytes under a repeated string are removed. Strings are judged on the
input, so what remains may hold new ones.

The suffix array is sparse and spread over the cluster. Of the ``GRAM``-byte strings in each
window of WIDTH bytes the one of least hash is an anchor, so equal windows hold equal anchors at
equal places, and one suffix for each anchor is enough.

1. The hashes of all anchors are counted; a bit filter of those met twice is sent out. It has a
   bounded size, and an overfull one lets more anchors through.
2. Anchors that pass are written with their contexts: the ``WIDTH - GRAM`` bytes on either side.
   Equal contexts of an anchor are one entry with their first place, by an aggregate that combines
   early, so a passage copied a billion times is few rows.
3. The different contexts of one anchor are sorted by what follows the anchor, which with the common
   prefixes of neighbours is an enhanced suffix array, and by what precedes it, read backwards. A
   scan with a stack gives the intervals of the tree of common prefixes. The members of an interval
   of t bytes are split by the WIDTH - GRAM - t bytes before the anchor: where all differ there is
   no repeat, members that share them are occurrences of one, and each occurrence but the first
   is covered up to t bytes behind the anchor. The tree of the other side gives the bytes before it.
   An anchor with more than ``MOST_CONTEXTS`` contexts isn't put into one task: its windows are
   compared by an aggregate over all of them, with the same result.
4. Later occurrences of a context are covered as far as it reaches. The spans of each document are
   joined with its text; documents without any keep theirs where they are.

Null and empty texts have no bytes. Documents are ordered by id (null first), then by MD5 of the
text; of fully equal rows the first counts as earlier than the others. Other columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, FILTER_LOG2, binary, mix, over_batches, passing, stored

WIDTH = 100
GRAM = 48
FREE = WIDTH - GRAM
#: More different contexts of one anchor than this are not sorted in one task.
MOST_CONTEXTS = 200_000
#: Texts are scanned together up to about so many bytes; anchors are written in rows of so many.
BYTES_AT_ONCE = 1_000_000
ANCHORS_PER_ROW = 64
CONTEXTS_AT_ONCE = 30_000
#: Rows of a batch whose texts are Python objects at one time.
ROWS_AT_ONCE = 500
#: The words of a filter come to the driver in blocks of 2^BLOCK_LOG2.
BLOCK_LOG2 = 14

_NO_ANCHOR = np.uint64(2**64 - 1)
_FACTOR = 0x9E3779B97F4A7C15
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each ``GRAM`` bytes, by joining hashes of half the length."""
    part, length, factor = _LETTERS[data], 1, _FACTOR
    whole, reached = None, 0
    while length <= GRAM:
        if GRAM & length:
            if whole is None:
                whole, reached = part.copy(), length
            else:
                count = len(part) - reached
                whole = whole[:count] * np.uint64(factor) + part[reached : reached + count]
                reached += length
        if 2 * length <= GRAM:
            part = part[:-length] * np.uint64(factor) + part[length:]
        factor, length = factor * factor % 2**64, 2 * length
    return mix(whole)


def _over_windows(values: np.ndarray, width: int, best: Callable) -> np.ndarray:
    """The best of each ``width`` adjacent values."""
    length = 1
    while 2 * length <= width:
        values, length = best(values[:-length], values[length:]), 2 * length
    return best(values[: len(values) - (width - length)], values[width - length :]) if length < width else values


def _marked(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of adjacent texts, which lie in ``data`` from starts to ends."""
    size = len(data)
    if size < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = np.full(size, _NO_ANCHOR)
    hashes[: size - GRAM + 1] = gram_hashes(data)
    hashes[_marked(size, np.maximum(starts, ends - GRAM + 1), ends)] = _NO_ANCHOR
    least = np.zeros(size + FREE, np.uint64)
    least[FREE : FREE + size - FREE] = _over_windows(hashes, FREE + 1, np.minimum)
    least[FREE:][_marked(size, np.maximum(starts, ends - WIDTH + 1), ends)] = 0
    places = np.flatnonzero(_over_windows(least, FREE + 1, np.maximum) == hashes)
    return places, hashes[places]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(first, ROWS_AT_ONCE)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Groups of the texts of a batch, as (number of the first, texts)."""
    first, size, group = 0, 0, []
    for i, text in enumerate(binary(batch, "text")):
        if group and size + len(text or b"") > BYTES_AT_ONCE:
            yield first, group
            first, size, group = i, 0, []
        group.append(text or b"")
        size += len(text or b"")
    if group:
        yield first, group


def _anchors_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, hash) of the anchors of several texts."""
    ends = np.cumsum([len(text) for text in texts])
    starts = np.append(0, ends[:-1])
    places, hashes = anchors(np.frombuffer(b"".join(texts), np.uint8), starts, ends)
    which = np.searchsorted(ends, places, side="right")
    return which, places - starts[which], hashes


def _name(doc_id: int | None, digest: bytes) -> int:
    return xxhash.xxh3_64_intdigest(f"{doc_id}".encode() + digest) >> 1


ANCHORS = (
    "doc_id long, digest binary, name long, n_bytes long, place array<int>, hash array<long>, context array<long>,"
    " before array<binary>, after array<binary>"
)


def _repeated_hashes(docs: DataFrame) -> DataFrame:
    """Hashes of anchors that occur twice or more."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            for _, texts in _texts(batch):
                found, count = np.unique(_anchors_of(texts)[2], return_counts=True)
                found = np.concatenate([found, found[count > 1]]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["hash"])

    counted = over_batches(docs, ["text"], scan, "hash long").groupBy("hash").count()
    return counted.where("count > 1").select("hash")


def _anchor_rows(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """Anchors whose hash passes the filter of ``hashes``, with their contexts, in rows by document."""
    bits, log2 = _filter(hashes)
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids = batch.column("doc_id").to_pylist()
            for first, texts in _texts(batch):
                which, place, found = _anchors_of(texts)
                at = passing(sent.value, log2, found)
                which, place, found = which[at], place[at], found[at]
                rows = []
                for i in np.unique(which).tolist():
                    text, doc_id = texts[i], ids[first + i]
                    digest = hashlib.md5(text, usedforsecurity=False).digest()
                    lo, hi = np.searchsorted(which, [i, i + 1])
                    for a in range(lo, hi, ANCHORS_PER_ROW):
                        cut = slice(a, min(a + ANCHORS_PER_ROW, hi))
                        here = place[cut].tolist()
                        before = [text[max(0, p - FREE) : p] for p in here]
                        after = [text[p + GRAM : p + WIDTH] for p in here]
                        context = [xxhash.xxh3_64_intdigest(b + a, len(b)) for b, a in zip(before, after, strict=True)]
                        context = np.array(context, np.uint64).view(np.int64)
                        rows.append((doc_id, digest, _name(doc_id, digest), len(text), here, found[cut].view(np.int64), context, before, after))
                if rows:
                    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
                    kinds += [pa.list_(pa.binary())] * 2
                    columns = [pa.array(part, kind) for part, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    names = ["doc_id", "digest", "name", "n_bytes", "place", "hash", "context", "before", "after"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return over_batches(docs, ["doc_id", "text"], scan, ANCHORS)


def _filter(keys: DataFrame) -> tuple[np.ndarray, int]:
    """The bits of ``bit_filter`` over a column of hashes, packed by the executors: the driver gets a few blocks."""
    name = keys.columns[0]
    log2 = int(min(FILTER_LOG2, max(16, np.ceil(np.log2(FILTER_BITS * max(keys.count(), 1))))))
    mask = F.lit((1 << log2) - 1)
    slots = [F.shiftrightunsigned(name, 64 - log2), F.shiftrightunsigned(name, 64 - 2 * log2).bitwiseAND(mask)]
    slot = keys.select(F.explode(F.array(*slots)).alias("slot"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            word, value = np.asarray(batch.column("word")), np.asarray(batch.column("bits"))
            for block in np.unique(word >> BLOCK_LOG2).tolist():
                mine = word >> BLOCK_LOG2 == block
                bits = blocks.setdefault(block, np.zeros(1 << BLOCK_LOG2, np.int64))
                bits[word[mine] & ((1 << BLOCK_LOG2) - 1)] = value[mine]
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([b.tobytes() for b in blocks.values()], pa.binary())], ["block", "bits"])

    dealt = words.repartition(8, F.shiftright("word", BLOCK_LOG2))
    bits = np.zeros(max(1 << (log2 - 6), 1 << BLOCK_LOG2), np.int64)
    for row in over_batches(dealt, ["word", "bits"], pack, "block long, bits binary").toLocalIterator():
        bits[row["block"] << BLOCK_LOG2 : (row["block"] + 1) << BLOCK_LOG2] = np.frombuffer(row["bits"], np.int64)
    return bits.view(np.uint8), log2


class Tree:
    """Sorted strings of groups with the common prefixes of neighbours, and the intervals of these."""

    def __init__(self, group: np.ndarray, strings: list[bytes]):
        size = len(strings)
        length = np.fromiter(map(len, strings), np.int64, size)
        letters = np.frombuffer(b"".join(s.ljust(FREE, b"\0") for s in strings), np.uint8).reshape(size, FREE)
        # A string that ends stands before those that go on with zero bytes.
        self.order = order = np.lexsort((length, np.ascontiguousarray(letters).view(f"S{FREE}").ravel(), group))
        same = letters[order[1:]] == letters[order[:-1]]
        common = np.where(same.all(axis=1), FREE, np.argmin(same, axis=1))
        common = np.minimum(common, np.minimum(length[order[1:]], length[order[:-1]]))
        #: Common prefix of each place with the one before it; -1 where a group begins.
        self.common = np.full(size, -1, np.int64)
        self.common[1:] = np.where(np.diff(group[order]) == 0, common, -1)
        self.rank = np.empty(size, np.int64)
        self.rank[order] = np.arange(size)

    def leaders(self, depth: int) -> np.ndarray:
        """For each string the first place of those that share its first ``depth`` bytes and its group."""
        first = np.where(self.common < depth, np.arange(len(self.common)), 0)
        return np.maximum.accumulate(first)[self.rank]

    def intervals(self) -> dict[int, list[tuple[int, int]]]:
        """By depth, the intervals [first, behind) of places whose least common prefix it is."""
        found: dict[int, list[tuple[int, int]]] = {}
        stack: list[tuple[int, int]] = []
        for place, depth in enumerate([*self.common.tolist()[1:], -1], 1):
            first = place - 1
            while stack and stack[-1][0] > depth:
                above, first = stack.pop()
                found.setdefault(above, []).append((first, place))
            if depth >= 0 and (not stack or stack[-1][0] < depth):
                stack.append((depth, first))
        return found


def _reach(tree: Tree, other: Tree) -> np.ndarray:
    """For each string how far along ``tree`` a repeat with an earlier string goes; -1 without one.

    Strings are numbered in order of their occurrence.
    """
    reach = np.full(len(tree.order), -1, np.int64)
    for depth, intervals in tree.intervals().items():
        first, behind = np.array(intervals).T
        sizes = behind - first
        member = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        string = tree.order[member]
        # Members of an interval that share enough bytes on the other side are one repeat.
        key = np.repeat(np.arange(len(first)), sizes) * len(reach) + other.leaders(FREE - depth)[string]
        by = np.lexsort((string, key))
        later = by[1:][np.diff(key[by]) == 0]
        reach[string[later]] = np.maximum(reach[string[later]], depth)
    return reach


def covered(group: np.ndarray, before: list[bytes], after: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes before the anchor, bytes behind it) that are covered in each context; -1 without.

    Contexts of a group have the same anchor and come in order of occurrence; the first counts as
    the original of what it shares with later ones.
    """
    if not len(group):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    follows, precedes = Tree(group, after), Tree(group, [text[::-1] for text in before])
    return _reach(precedes, follows), _reach(follows, precedes)


PLACE = ["doc_id", "digest", "place"]
CONTEXTS = "hash long, doc_id long, digest binary, place int, before binary, after binary"
SPANS = "doc_id long, digest binary, start long, stop long"


def _contexts(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The contexts at their first places, told by a filter; it may let some later ones through."""
    bits, log2 = _filter(firsts.select(F.col("name").bitwiseXOR(F.col("context")).bitwiseXOR(F.shiftleft(F.col("place").cast("long"), 33))))
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def flat(batch: pa.RecordBatch, name: str) -> pa.Array:
        return batch.column(batch.schema.get_field_index(name)).flatten()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("place").value_lengths())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            place = np.asarray(flat(batch, "place"))
            key = np.asarray(batch.column("name"))[row] ^ np.asarray(flat(batch, "context")) ^ (place.astype(np.int64) << 33)
            at = passing(sent.value, log2, key.view(np.uint64))
            own = [batch.column(name).take(pa.array(row[at])) for name in ("doc_id", "digest")]
            found = [flat(batch, name).take(pa.array(at)) for name in ("hash", "place", "before", "after")]
            yield pa.RecordBatch.from_arrays([found[0], *own, *found[1:]], ["hash", "doc_id", "digest", "place", "before", "after"])

    return over_batches(rows, rows.columns, scan, CONTEXTS)


def _spans_of_groups(contexts: DataFrame) -> DataFrame:
    """Covered spans of contexts, anchor by anchor, each in one task."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        group = np.unique(np.asarray(table["hash"]), return_inverse=True)[1]
        before, after = covered(group, table["before"].to_pylist(), table["after"].to_pylist())
        at = np.flatnonzero(before >= 0)
        place = np.asarray(table["place"])[at]
        own = [table[name].take(pa.array(at)).combine_chunks() for name in ("doc_id", "digest")]
        return pa.RecordBatch.from_arrays(
            [*own, pa.array(place - before[at], pa.int64()), pa.array(place + GRAM + after[at], pa.int64())],
            ["doc_id", "digest", "start", "stop"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.concat_tables([held, pa.table(batch)]) if held is not None else pa.table(batch)
            if held.num_rows >= CONTEXTS_AT_ONCE:
                # The last anchor may go on in the next batch.
                hashes = np.asarray(held["hash"])
                cut = int(np.searchsorted(hashes, hashes[-1], side="left"))
                if cut:
                    yield solve(held.slice(0, cut))
                    held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield solve(held)

    ordered = contexts.repartition("hash").sortWithinPartitions("hash", *PLACE)
    return over_batches(ordered, ordered.columns, scan, SPANS)


def _spans_of_windows(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts: all their windows, compared by an aggregate."""
    where = F.struct(*PLACE)
    # A window has k bytes before the anchor and FREE - k behind it.
    shifts = F.filter(F.sequence(F.lit(0), F.lit(FREE)), lambda k: (k <= F.length("before")) & (FREE - k <= F.length("after")))
    window = contexts.select("hash", where.alias("at"), "before", "after", F.explode(shifts).alias("k"))
    own = F.concat(F.expr("substring(before, length(before) - k + 1, k)"), F.expr(f"substring(after, 1, {FREE} - k)"))
    window = window.select("hash", "k", F.unhex(F.sha2(own, 256)).alias("window"), "at")
    key = ["hash", "k", "window"]
    first = window.groupBy(*key).agg(F.min("at").alias("first"))
    later = window.join(first, key).where("at <> first")
    spans = later.groupBy("at").agg(F.max("k").alias("k"), F.min("k").alias("least"))
    return spans.select(
        "at.doc_id",
        "at.digest",
        (F.col("at.place") - F.col("k")).cast("long").alias("start"),
        (F.col("at.place") + WIDTH - F.col("least")).cast("long").alias("stop"),
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, spans) for documents with removed bytes; digest is the MD5 of the text.

    Spans are (start, stop) in bytes, in no order, and may overlap.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(_anchor_rows(docs, stored(_repeated_hashes(docs), "anchor-hashes")), "anchors")
    each = F.explode(F.arrays_zip("place", "hash", "context")).alias("anchor")
    occurrence = rows.select("doc_id", "digest", "name", "n_bytes", each).select("doc_id", "digest", "name", "n_bytes", "anchor.*")
    first = F.min(F.struct(*PLACE, "name")).alias("first")
    groups = stored(occurrence.groupBy("hash", "context").agg(first, F.count(F.lit(1)).alias("n")), "contexts")
    several = stored(groups.groupBy("hash").count().where("count > 1"), "anchors-counted")
    firsts = groups.join(several, "hash", "left_semi").select("context", "first.*")
    contexts = _contexts(rows, firsts)
    many = several.where(F.col("count") > MOST_CONTEXTS).select("hash")
    found = _spans_of_groups(contexts.join(many, "hash", "left_anti"))
    found = found.unionByName(_spans_of_windows(contexts.join(many, "hash", "left_semi")))
    # Later occurrences of a context are covered as a whole, if it is as long as a window.
    start = F.greatest(F.col("place") - FREE, F.lit(0)).cast("long")
    stop = F.least(F.col("place") + WIDTH, F.col("n_bytes"))
    later = (
        occurrence.join(groups.where("n > 1").select("hash", "context", "first"), ["hash", "context"])
        .where(~F.struct(*PLACE).eqNullSafe(F.struct(*(F.col(f"first.{name}") for name in PLACE))))
        .select("doc_id", "digest", start.alias("start"), stop.alias("stop"))
        .where(F.col("stop") - F.col("start") >= WIDTH)
    )
    spans = found.unionByName(later).groupBy("doc_id", "digest")
    return spans.agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """(what remains, number of removed runs) of a text without the bytes under ``spans``."""
    gone, kept, runs, at = 0, [], 0, -1
    for start, stop in sorted(spans):
        if start > at:
            runs += 1
            kept.append(text[gone:start])
        at = max(at, stop)
        gone = at
    return b"".join(kept) + text[gone:], runs


def _judged(docs: DataFrame, spans: DataFrame, kind: str, final: Callable[[bytes], object]) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``final`` of the remaining bytes, of type ``kind``.

    Texts without spans do not move: a filter tells the others, which are joined with their spans.
    """
    spans = stored(spans.withColumn("name", _spark_name()), "spans")
    bits, log2 = _filter(spans.select("name"))
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    arrow = pa.binary() if kind == "binary" else pa.string()
    results = [("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", arrow)]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = [text or b"" for text in binary(batch, "text")]
            names = np.asarray(batch.column("name")).view(np.uint64)
            moved = np.zeros(len(texts), bool)
            moved[passing(sent.value, log2, names)] = True
            columns = [
                batch.column("doc_id"),
                batch.column("digest"),
                pa.array([len(text) for text in texts], pa.int64()),
                pa.array([text if go else None for text, go in zip(texts, moved, strict=True)], pa.binary()),
                pa.array([None if go else final(text) for text, go in zip(texts, moved, strict=True)], arrow),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_bytes", "text", "kept"])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            lists = batch.column("spans").to_pylist()
            for text, spans, kept in zip(batch.column("text").to_pylist(), lists, batch.column("kept").to_pylist(), strict=True):
                if text is None:
                    rows.append((0, 0, kept))
                else:
                    left, runs = cut(text, [(span["start"], span["stop"]) for span in spans or ()])
                    rows.append((len(text) - len(left), runs, final(left)))
            made = [pa.array([row[i] for row in rows], column) for i, (_, column) in enumerate(results)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], ["doc_id", "n_bytes", *(name for name, _ in results)])

    body = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(body)).alias("digest"), "text")
    named = named.withColumn("name", _spark_name())
    begun = over_batches(named, named.columns, begin, f"doc_id long, digest binary, n_bytes long, text binary, kept {kind}")
    keyed = spans.select(F.col("doc_id").alias("id"), F.col("digest").alias("md5"), "spans")
    whole = begun.join(keyed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("md5")), "left")
    columns = ["doc_id", "n_bytes", "text", "kept", "spans"]
    done = over_batches(whole, columns, end, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}")
    # Of fully equal rows the first keeps what it has; the others repeat it.
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    copies = done.groupBy(*columns).count().withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
    gone = (F.col("copy") > 1) & (F.col("n_bytes") >= WIDTH)
    return copies.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(gone, F.lit(final(b""))).otherwise(F.col("kept")).alias("kept"),
    )


def _spark_name() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the remaining bytes ``kept`` of each document."""
    return _judged(docs, repeated_spans(docs), "binary", bytes)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """The same with the SHA-256 of the remaining bytes."""

    def digest(kept: bytes) -> str:
        return hashlib.sha256(kept).hexdigest()

    return _judged(docs, repeated_spans(docs), "string", digest).withColumnRenamed("kept", "kept_sha256")
