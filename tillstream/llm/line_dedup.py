"""Line deduplication by deletion neighbourhoods.

A line is its sequence of words. Two lines are near if one word inserted, deleted or replaced makes
them equal. Each line gives the hashes of all its variants with one word left out; near lines share
a variant: lines with one word replaced the one without that word, a longer and a shorter line the
one that is the shorter. The earliest line of each variant is compared word by word.

Before that, lines that cannot have a near one are dropped: one edit leaves either the first or the
second half of a line as it was, so a line whose halves no other line has needs no variants.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, binary, bit_filter, mix, over_batches, packed, passing, stored

#: Shorter lines are only compared as they are: a changed word is too large a part of them.
LEAST_WORDS = 5
#: Bytes of the lines whose variants are formed at a time.
STEP_BYTES = 1_000_000
#: Lines a task remembers as met.
SEEN = 300_000
_GOLDEN = 0x9E3779B97F4A7C15


class Powers:
    """Powers of the hash's base and of its inverse, as many as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            for name, base in (("up", _GOLDEN), ("down", pow(_GOLDEN, -1, 1 << 64))):
                grown = np.full(size, base, np.uint64)
                grown[0] = 1
                setattr(self, name, np.multiply.accumulate(grown))


def prefixes(words: np.ndarray, powers: Powers) -> np.ndarray:
    """Sums of words times powers for each prefix, the empty one first."""
    n = len(words)
    powers.reach(n)
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers.up[:n], out=out[1:])
    return out


class Lines:
    """The lines with words of a text: their numbers, sizes, hashes and the keys of their halves.

    One running sum over all words gives the hash of any run of them.
    """

    def __init__(self, text: bytes | None, hashes: WordHashes, powers: Powers):
        self.raw = (text or b"").split(b"\n")
        split = [line.split() for line in self.raw]
        self.numbers = np.array([i for i, words in enumerate(split) if words], np.int64)
        self.sizes = np.array([len(words) for words in split if words], np.int64)
        self.ends = self.sizes.cumsum()
        self.powers = powers
        self.sums = prefixes(hashes.of([word for words in split for word in words]), powers)
        self.names = mix(self.run(self.ends - self.sizes, self.ends) + self.sizes.astype(np.uint64)).view(np.int64)

    def run(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.powers.down[begin]

    def halves(self) -> np.ndarray:
        """Keys of the first and last h words of each line, for both roundings of h: one edit spares one."""
        begin, keys = self.ends - self.sizes, []
        for h in (self.sizes // 2, (self.sizes - 1) // 2):
            keys.append(mix(self.run(begin, begin + h)) + (2 * h).astype(np.uint64))
            keys.append(mix(self.run(self.ends - h, self.ends)) + (2 * h + 1).astype(np.uint64))
        return mix(np.stack(keys, axis=1)).view(np.int64)

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, place, hash) of every line without one word; equal to the hash of a line that is what is left."""
        line = np.repeat(np.arange(len(self.sizes)), self.sizes)
        begin, end, at = (self.ends - self.sizes)[line], self.ends[line], np.arange(len(line))
        rest = (self.sums[at] - self.sums[begin]) + (self.sums[end] - self.sums[at + 1]) * self.powers.down[1]
        names = mix(rest * self.powers.down[begin] + (self.sizes[line] - 1).astype(np.uint64))
        return line, at - begin, names.view(np.int64)


def near(a: list[bytes], b: list[bytes]) -> bool:
    """Is the edit distance of two sequences of words at most one?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("body"))


def _place():
    """Order of lines: by id, rows without one last; versions of one id by their text's hash."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "line_no", "line")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, text_key, line_no, near) of each line that has an equal or a near line before it.

    Lines are split at line feeds and counted from 0; lines without a word are neither dropped nor
    compared. Equal lines are dropped but for the first, near ones if any earlier line of the corpus
    is near (whether or not that one stays). Repeated rows are one document.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = _keyed(docs, id_col, text_col)

    def cut(batches):
        """All lines; those long enough with their halves and content where a task first meets them."""
        hashes, powers, seen = WordHashes(), Powers(), set()
        for batch in batches:
            texts = binary(batch, "body")
            ends = np.cumsum([len(text or b"") for text in texts]) // STEP_BYTES
            for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1):
                # The lines of many texts one after the other.
                bodies = [texts[i] or b"" for i in some]
                before = np.cumsum([0, *(body.count(b"\n") + 1 for body in bodies)])
                found = Lines(b"\n".join(bodies), hashes, powers)
                own = np.searchsorted(before, found.numbers, "right") - 1
                at = pa.array(some[own])
                names, first = np.unique(found.names, return_index=True)
                if len(seen) > SEEN:
                    seen.clear()
                new = np.zeros(len(own), bool)
                new[[i for name, i in zip(names.tolist(), first.tolist()) if name not in seen]] = True
                seen.update(names.tolist())
                new &= found.sizes >= least_words
                halves = pa.ListArray.from_arrays(np.append(0, 4 * new.cumsum()).astype(np.int32), found.halves()[new].ravel())
                contents = pa.array([found.raw[i] if long else None for i, long in zip(found.numbers.tolist(), new.tolist())], pa.binary())
                columns = [pa.array(x) for x in (found.numbers - before[own], found.names)]
                yield pa.record_batch(
                    [batch.column(0).take(at), batch.column(1).take(at), *columns, halves, contents],
                    names=["id", "text_key", "line_no", "line", "halves", "content"],
                )

    kinds = f"id {kind}, text_key long, line_no long, line long, halves array<long>, content binary"
    found = over_batches(keyed, ["id", "text_key", "body"], cut, kinds)
    every = packed(found, "lines")
    lines = every.select("id", "text_key", "line_no", "line")
    firsts = stored(lines.groupBy("line").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("times")), "firsts")

    long_enough = every.where("content is not null")
    halved = long_enough.select("line", F.explode("halves").alias("half"))
    common = halved.groupBy("half").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low <> high").select("half")
    sent = docs.sparkSession.sparkContext.broadcast(bit_filter(stored(common, "halves")))

    def spell(batches):
        """Lines with a half that passes, each once per task."""
        seen = set()
        for batch in batches:
            keys = batch.column(1).flatten().to_numpy().view(np.uint64)
            hit = np.zeros(len(keys), bool)
            hit[passing(*sent.value, keys)] = True
            at = np.flatnonzero(hit.reshape(-1, 4).any(axis=1))
            names, first = np.unique(batch.column(0).to_numpy()[at], return_index=True)
            if len(seen) > SEEN:
                seen.clear()
            new = [i for name, i in zip(names.tolist(), at[first].tolist()) if name not in seen]
            seen.update(names.tolist())
            yield batch.select(["line", "content"]).take(pa.array(new, pa.int64()))

    spelled = over_batches(long_enough, ["line", "halves", "content"], spell, "line long, content binary").dropDuplicates(["line"])
    spelled = stored(spelled, "spelled")

    def varying(met):
        """The variants of lines, and at place -1 the lines themselves; with a filter, those that pass it."""

        def vary(batches):
            hashes, powers = WordHashes(), Powers()
            for batch in batches:
                contents = batch.column(1).to_pylist()
                ends = np.cumsum([len(content) for content in contents]) // STEP_BYTES
                for some in np.split(np.arange(len(contents)), np.flatnonzero(np.diff(ends)) + 1):
                    lines = Lines(b"\n".join(contents[i] for i in some), hashes, powers)
                    own = np.arange(len(lines.names))
                    line, place, variant = map(np.concatenate, zip(lines.variants(), (own, np.full(len(own), -1), lines.names)))
                    if met is not None:
                        at = passing(*met.value, variant.view(np.uint64))
                        line, place, variant = line[at], place[at], variant[at]
                    yield pa.record_batch([pa.array(x) for x in (lines.names[line], place, variant)], names=["line", "place", "variant"])

        return over_batches(spelled, ["line", "content"], vary, "line long, place long, variant long")

    # Nearly all variants are those of one line: only hashes are shuffled to find the others.
    shared = varying(None).groupBy("variant").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("variant")
    met = docs.sparkSession.sparkContext.broadcast(bit_filter(stored(shared, "shared")))
    order = firsts.select("line", "first")
    meeting = stored(varying(met).join(order, "line"), "variants")
    varied = meeting.where("place >= 0")
    whole = meeting.where("place < 0").select("variant", "line", "first")
    # One word replaced: the same word left out of both.
    replaced = varied.groupBy("variant", "place").agg(F.min("first").alias("other"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    one = varied.join(replaced, ["variant", "place"]).select("line", "first", "other")
    # One word more or less: the shorter line is a variant of the longer.
    longer = varied.join(whole.select("variant", F.col("first").alias("other")), "variant").select("line", "first", "other")
    shorter = whole.join(varied.groupBy("variant").agg(F.min("first").alias("other")), "variant").select("line", "first", "other")
    pairs = stored(one.unionByName(longer).unionByName(shorter).where("other < first").select("line", F.col("other.line").alias("earlier")).distinct(), "pairs")
    both = pairs.join(spelled.select("line", F.col("content").alias("a")), "line").join(
        spelled.select(F.col("line").alias("earlier"), F.col("content").alias("b")), "earlier"
    )

    def compare(batches):
        for batch in batches:
            a, b = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            yield batch.select(["line"]).filter(pa.array([near(x.split(), y.split()) for x, y in zip(a, b)], pa.bool_()))

    near_lines = over_batches(both, ["line", "a", "b"], compare, "line long").distinct().withColumn("near", F.lit(True))
    # A line that is there once and near to none is not dropped.
    suspect = firsts.join(near_lines, "line", "left").where(F.col("near") | (F.col("times") > 1)).drop("times")
    again = ~F.col("first").eqNullSafe(_place())
    marked = lines.join(suspect, "line").where(again | F.col("near"))
    return marked.select("id", "text_key", "line_no", F.coalesce(~again, F.lit(False)).alias("near")).distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, n_lines, n_equal, n_near, text) per row: its lines with words, those dropped, and what is left.

    Null texts stay null; empty texts and tables are left as they are.
    """
    gone = dropped_lines(docs, id_col, text_col, least_words)
    gone = gone.groupBy("id", "text_key").agg(
        F.collect_list("line_no").alias("gone"),
        F.sum((~F.col("near")).cast("long")).alias("n_equal"),
        F.sum(F.col("near").cast("long")).alias("n_near"),
    )
    named = gone.select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key"), "gone", "n_equal", "n_near")
    keyed = _keyed(docs, id_col, text_col)
    joined = keyed.join(named, (F.col("text_key") == F.col("gone_key")) & F.col("id").eqNullSafe(F.col("gone_id")), "left")

    def write(batches):
        for batch in batches:
            counts, texts = [], []
            for text, lost in zip(binary(batch, "body"), batch.column(2).to_pylist()):
                lines = (text or b"").split(b"\n")
                counts.append(sum(1 for line in lines if line.strip(b" \t\n\r\x0b\x0c")))
                lost = set(lost or ())
                texts.append(None if text is None else b"\n".join(line for i, line in enumerate(lines) if i not in lost))
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), batch.column(3), batch.column(4), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[id_col, "n_lines", "n_equal", "n_near", "text"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    ready = joined.select("id", "body", "gone", F.coalesce("n_equal", F.lit(0)).alias("n_equal"), F.coalesce("n_near", F.lit(0)).alias("n_near"))
    return ready.mapInArrow(write, f"{id_col} {kind}, n_lines long, n_equal long, n_near long, text string")
