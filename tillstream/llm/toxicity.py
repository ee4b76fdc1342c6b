"""Toxicity: class-conditional Kneser-Ney models of the letters in words.

Two models, of toxic and of ordinary documents, are counted over all labelled documents but the few
of the curve. A word's
probability is the product of its bytes' probabilities, each given the bytes before it in the word.
Interpolated Kneser-Ney smoothing discounts the class counts and hands the rest to the next shorter
context. Contexts shorter than ``SHARED`` use the counts of both classes together, so rare
expressions rest on the shared model. A document has two measures: the difference of the two
log-likelihoods per byte, and the root of the mean over its words of what the difference of a word
has beyond ``MARGIN``, up to ``MOST``, which a few strong words raise in a long text. A logistic
curve fitted on held-out documents turns both and the length into a score.

All n-grams are kept. Spark counts and smooths them and writes them in ascending order as files in the
shared folder; tasks map the files into memory and look n-grams up by binary search. Nothing of the
model but the paths of its files passes the driver, and there is one way for every size.
"""

from __future__ import annotations

import mmap
import uuid
from collections import Counter
from dataclasses import dataclass, replace
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.session import shared_folder

from .common import binary, bit_filter, lean, over_batches, parts, passing, small_batches, stored
from .training import clean_labels

#: Bytes of the longest n-gram; an n-gram and its length fit a 64-bit number.
ORDER = 6
#: N-grams up to this length are counted over both classes.
SHARED = 2
DISCOUNT = 0.75
#: Extra weight of the shorter context, in counts; it keeps sparse contexts from giving evidence.
PRIOR = 1.0
#: Log-likelihood difference of a word that is noise, and the most that counts beyond it.
MARGIN = 2.0
MOST = 8.0
#: N-grams of a file, 24 bytes each.
FILE_GRAMS = 1_000_000
#: Words whose n-grams are formed at a time.
STEP_WORDS = 20_000
#: N-grams a task counts before it gives their counts out.
HELD_GRAMS = 400_000
#: Labelled documents of which the curve is fitted, left out of the counts.
CURVE_ROWS = 4_000


def lowered(text: bytes | None) -> list[bytes]:
    return (text or b"").decode("utf-8", "replace").lower().encode().split()


def grams(words: list[bytes], order: int | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(n-gram numbers by length, word of each byte, valid lengths of each byte) of padded words.

    A word is followed by a blank. Position i holds the n-grams that end at byte i; those that would
    begin before the blank of the word's start don't count.
    """
    joined = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    blank = joined == 32
    word = np.cumsum(blank[:-1]) - 1  # of the byte at i + 1
    starts = np.flatnonzero(blank)[:-1]
    depth = np.arange(1, len(joined)) - starts[word] + 1  # bytes from the blank, both included
    keys = []
    number = np.zeros(len(joined) - 1, np.uint64)
    for k in range(1, (order or ORDER) + 1):
        number = number.copy()
        reach = len(joined) - k
        at = slice(max(k - 2, 0), None)
        number[at] |= joined[(0 if k > 1 else 1) : (0 if k > 1 else 1) + len(number[at])].astype(np.uint64) << np.uint64(8 * (k - 1))
        keys.append(number | (np.uint64(k) << np.uint64(56)))
        if reach <= 0:
            break
    return keys, word, depth


class GramFile:
    """One file of the model: ascending n-grams, per class what they add and what they hand down."""

    def __init__(self, data):
        count = int(np.frombuffer(data, "<u8", 1)[0])
        self.keys = np.frombuffer(data, "<u8", count, 8)
        self.gain, self.rest = np.frombuffer(data, "<f4", 4 * count, 8 + 8 * count).reshape(2, 2, count)


def encode_grams(keys: np.ndarray, gain: np.ndarray, rest: np.ndarray) -> bytes:
    return np.array([len(keys)], "<u8").tobytes() + keys.astype("<u8").tobytes() + np.stack([gain, rest]).astype("<f4").tobytes()


def publish(rows: DataFrame) -> tuple[str, ...]:
    """Write the smoothed n-grams as files of up to ``FILE_GRAMS``, in ascending order; their paths.

    The files stay in the shared folder. Where that is no path of the machines' own, each executor
    fetches them from it once.
    """
    spark = rows.sparkSession
    columns = ["gram", *(f"{what}_{c}" for what in ("gain", "rest") for c in (0, 1))]

    def write(batches):
        held, count = [], 0

        def file():
            found = pa.Table.from_batches(held)
            keys, *values = (found.column(i).to_numpy() for i in range(5))
            content = encode_grams(keys, np.stack(values[:2]), np.stack(values[2:]))
            return pa.record_batch([pa.array([content], pa.binary())], names=["content"])

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= FILE_GRAMS:
                yield file()
                held, count = [], 0
        if count:
            yield file()

    ordered = rows.select(*columns).repartitionByRange("gram").sortWithinPartitions("gram")
    path = f"{shared_folder(spark).rstrip('/')}/llm-model-{uuid.uuid4().hex}"
    # The text writer puts the bytes of a value and one separator into a file of its own.
    content = ordered.mapInArrow(lean(write), "content binary").select(F.col("content").cast("string").alias("value"))
    content.write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()
    paths = sorted(row["path"] for row in found)
    for each in paths:
        if urlparse(each).scheme not in ("", "file"):
            spark.sparkContext.addFile(each)
    return tuple(paths)


def mapped(path: str) -> GramFile:
    """A file of the model in the memory of a task."""
    parts = urlparse(path)
    local = unquote(parts.path) if parts.scheme in ("", "file") else SparkFiles.get(path.rsplit("/", 1)[1])
    with open(local, "rb") as file:
        return GramFile(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))


@dataclass(frozen=True)
class Model:
    """Paths of the files of n-grams, and the curve: weights of both measures, of one, of log length."""

    paths: tuple[str, ...] = ()
    weights: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)

    def curve(self, mean: np.ndarray, excess: np.ndarray, words: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return 1 / (1 + np.exp(-np.clip(a * mean + b * excess + c + d * np.log1p(words), -30, 30)))


class Evidence:
    """Measures of documents by the files of a model; words met before are looked up."""

    limit = 300_000

    def __init__(self, files: list[GramFile]):
        self.files = sorted((file for file in files if len(file.keys)), key=lambda file: file.keys[0])
        self.firsts = np.array([file.keys[0] for file in self.files[1:]], np.uint64)
        self.known: dict[bytes, int] = {}
        self.values = np.zeros(0)

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gain, rest) of ascending n-grams by class; unknown ones add nothing and hand all down."""
        gain, rest = np.zeros((2, len(keys))), np.ones((2, len(keys)))
        cuts = [0, *np.searchsorted(keys, self.firsts).tolist(), len(keys)]
        for file, begin, end in zip(self.files, cuts, cuts[1:]):
            if begin < end:
                at = np.minimum(np.searchsorted(file.keys, keys[begin:end]), len(file.keys) - 1)
                found = np.flatnonzero(file.keys[at] == keys[begin:end])
                gain[:, begin + found] = file.gain[:, at[found]]
                rest[:, begin + found] = file.rest[:, at[found]]
        return gain, rest

    def words(self, words: list[bytes]) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of each word."""
        if not words or not self.files:
            return np.zeros(len(words))
        keys, word, depth = grams(words)
        p = np.full((2, len(word)), 1 / 256)
        # What the context hands down was looked up where the context ended, one byte before.
        _, blank = self.look(np.array([32 | 1 << 56], np.uint64))
        _, root = self.look(np.zeros(1, np.uint64))
        before = np.repeat(root, len(word), axis=1)
        for k, key in enumerate(keys, 1):
            # Many words share their n-grams: each is looked up once, in the order of the files.
            names, where = np.unique(key, return_inverse=True)
            gain, rest = self.look(names)
            p = np.where(depth >= k, gain[:, where] + before * p, p)
            before = np.concatenate([blank if k == 1 else root, rest[:, where[:-1]]], axis=1)
        return np.bincount(word, np.log(p[0]) - np.log(p[1]), len(words))

    def of(self, texts: list[bytes | None], step: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(difference per byte, root of the mean excess of words, number of words) of each text."""
        mean, excess, sizes = np.zeros((3, len(texts)))
        for begin in range(0, len(texts), step):
            some = [lowered(text) for text in texts[begin : begin + step]]
            if len(self.known) > self.limit:
                self.known, self.values = {}, np.zeros(0)
            new = [word for word in set().union(*some) if word not in self.known]
            found = [self.words(new[at : at + STEP_WORDS]) for at in range(0, len(new), STEP_WORDS)]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.values = np.concatenate([self.values, *found])
            beyond = np.clip(self.values - MARGIN, 0, MOST)
            for i, words in enumerate(some, begin):
                if words:
                    at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                    mean[i] = self.values[at].sum() / (sum(map(len, words)) + len(words))
                    excess[i] = np.sqrt(beyond[at].mean())
                    sizes[i] = len(words)
        return mean, excess, sizes


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(sample_text, sample_label) of the labelled documents.

    A bit filter over the labelled ids keeps other texts out of the shuffle of the join. The join
    always shuffles: a broadcast would put the filter and what follows in Python into one task, with
    a process for each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bit_filter(labels.select(F.xxhash64("sample_id").alias("key"))))

    @F.pandas_udf("boolean")
    def may_be_labelled(keys: pd.Series) -> pd.Series:
        found = np.zeros(len(keys), bool)
        found[passing(*sent.value, keys.to_numpy(np.int64).view(np.uint64))] = True
        return pd.Series(found)

    named = docs.select(F.col(id_col).cast(labels.schema["sample_id"].dataType).alias("sample_id"), F.col(text_col).alias("sample_text"))
    return named.where(may_be_labelled(F.xxhash64("sample_id"))).join(labels.hint("merge"), "sample_id").select("sample_text", "sample_label")


def count_grams(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(gram, toxic, ordinary): in how many places labelled documents have each n-gram of bytes."""

    def count(batches):
        words: tuple[Counter, Counter] = Counter(), Counter()
        held = GramCounts()
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            for text, label in zip(binary(batch, "sample_text"), toxic):
                words[int(label > 0)].update(lowered(text))
                if len(words[0]) + len(words[1]) > STEP_WORDS:
                    yield from held.add(words)
                    words = Counter(), Counter()
        yield from held.add(words)
        yield from held.drain()

    parts = labelled_texts(docs, labels, id_col, text_col).mapInArrow(lean(count), "gram long, toxic long, ordinary long")
    return parts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


class GramCounts:
    """Counts of n-grams by class, given out whenever there are more than ``HELD_GRAMS``."""

    def __init__(self):
        self.gram, self.times = np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)

    def add(self, words: tuple[Counter, Counter]):
        """Count the n-grams of words; a long text's words in slices."""
        for label, each in enumerate(words):
            listed, times = list(each), np.fromiter(each.values(), np.int64, len(each))
            for begin in range(0, len(listed), STEP_WORDS):
                keys, word, depth = grams(listed[begin : begin + STEP_WORDS])
                some = times[begin : begin + STEP_WORDS][word]
                inside = [depth >= k for k in range(1, len(keys) + 1)]
                # The slice is counted first, so that little is held beside what was counted before.
                # Sums as floating-point numbers are exact up to 2**53 places of a task.
                found, where = np.unique(np.concatenate([key[i] for key, i in zip(keys, inside)]), return_inverse=True)
                own = np.zeros((2, len(found)), np.int64)
                own[1 - label] = np.bincount(where, np.concatenate([some[i] for i in inside]), len(found))
                del keys, word, depth, inside, where
                found, where = np.unique(np.concatenate([self.gram, found]), return_inverse=True)
                both = np.concatenate([self.times, own], axis=1)
                self.gram, self.times = found, np.stack([np.bincount(where, row, len(found)) for row in both]).astype(np.int64)
                if len(found) > HELD_GRAMS:
                    yield from self.drain()

    def drain(self):
        if len(self.gram):
            yield pa.record_batch([pa.array(self.gram.view(np.int64)), *map(pa.array, self.times)], names=["gram", "toxic", "ordinary"])
        self.__init__()


def smoothed_table(grams: DataFrame) -> DataFrame:
    """(gram, gain_0, gain_1, rest_0, rest_1): interpolated Kneser-Ney models of both classes.

    The longest n-grams have their class counts; a shorter one has the number of bytes seen before
    it, which is what Kneser-Ney backs off to. One that begins at a word's start has no byte before
    it and keeps its count. Those up to ``SHARED`` bytes take both over both classes.
    """
    length = F.shiftright("gram", 56)
    shorter = "shiftleft((gram >> 56) - 1, 56)"
    tail = F.expr(f"(gram & (shiftleft(1L, cast(8 * ((gram >> 56) - 1) as int)) - 1)) | {shorter}")
    none = F.lit(0).cast("long")
    own = grams.select("gram", "toxic", "ordinary", none.alias("kinds_0"), none.alias("kinds_1"), none.alias("kinds"))
    before = grams.where(length > 1).select(
        tail.alias("gram"), none, none, (F.col("toxic") > 0).cast("long"), (F.col("ordinary") > 0).cast("long"), F.lit(1).cast("long")
    )
    sums = own.union(before).groupBy("gram").agg(*(F.sum(c).alias(c) for c in own.columns[1:]))
    inner = (length < ORDER) & ((length == 1) | F.expr("(gram >> cast(8 * ((gram >> 56) - 1) as int)) & 255 != 32"))
    pooled = F.when(inner, F.col("kinds")).otherwise(F.col("toxic") + F.col("ordinary"))
    counts = [
        F.when(length <= SHARED, pooled).when(inner, F.col(f"kinds_{c}")).otherwise(F.col(raw)).cast("double").alias(f"count_{c}")
        for c, raw in enumerate(("toxic", "ordinary"))
    ]
    context = F.when(length > 1, F.expr(f"((gram & {(1 << 56) - 1}L) >> 8) | {shorter}")).otherwise(0)
    counted = stored(sums.select("gram", context.alias("context"), *counts), "counts")
    handed = counted.groupBy("context").agg(
        *(F.sum(f"count_{c}").alias(f"total_{c}") for c in (0, 1)), *(F.sum((F.col(f"count_{c}") > 0).cast("double")).alias(f"seen_{c}") for c in (0, 1))
    )
    gain = [(F.greatest(F.col(f"count_{c}") - DISCOUNT, F.lit(0.0)) / (F.col(f"total_{c}") + PRIOR)).alias(f"gain_{c}") for c in (0, 1)]
    rest = [((PRIOR + F.least(DISCOUNT * F.col(f"seen_{c}"), F.col(f"total_{c}"))) / (F.col(f"total_{c}") + PRIOR)).alias(f"rest_{c}") for c in (0, 1)]
    nothing = F.lit(None).cast("double")
    gains = counted.join(handed, "context").select("gram", *gain, nothing.alias("rest_0"), nothing.alias("rest_1"))
    rests = handed.select(F.col("context").alias("gram"), nothing, nothing, *rest)
    return gains.union(rests).groupBy("gram").agg(
        *(F.coalesce(F.max(f"{what}_{c}"), F.lit(missing)).alias(f"{what}_{c}") for what, missing in (("gain", 0.0), ("rest", 1.0)) for c in (0, 1))
    )


def measured(docs: DataFrame, model: Model, columns: list[str], text_col: str, kinds: str, row) -> DataFrame:
    """``columns`` of each row and what ``row`` makes of (mean, excess, words) of its text."""

    def measure(batches):
        evidence = None
        for batch in parts(batches):
            evidence = evidence or Evidence([mapped(path) for path in model.paths])
            found = row(*evidence.of(binary(batch, text_col)))
            yield pa.record_batch([*batch.columns[:-1], *map(pa.array, found.values())], names=[*columns, *found])

    own = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in columns)
    return over_batches(docs, [*columns, text_col], measure, own + kinds)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    where: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Models of both classes from the labelled documents that ``where`` holds for.

    An eighth of them, ``CURVE_ROWS`` at most, gives the curve from measures to score and is kept out
    of the counts; the n-grams of all others are counted, and all are kept. Labels without id or
    value don't count, the larger of several labels of an id does, and rows that repeat in ``docs``
    count each time. Without labels of both classes the score is the share of toxic labels, without
    any it is one half.
    """
    known = clean_labels(labels, label, id_col, where)
    order = [F.xxhash64("sample_id", F.lit(1)), F.col("sample_id")]
    aside = F.pmod(F.xxhash64("sample_id"), F.lit(8)) == 0
    ids = stored(known.where(aside).orderBy(*order).limit(CURVE_ROWS), "curve")
    counted = stored(known.join(F.broadcast(ids.select("sample_id")), "sample_id", "left_anti"), "labels")
    with small_batches(docs.sparkSession):
        found = stored(count_grams(docs, counted, id_col, text_col), "grams")
    model = Model(publish(smoothed_table(found)))
    chosen = docs.select(F.col(id_col).alias("sample_id"), F.col(text_col).alias("sample_text")).join(F.broadcast(ids), "sample_id")
    rows = chosen.select("sample_text", F.col("sample_label").alias("y"), F.xxhash64("sample_id").alias("i"))
    kinds = "mean double, excess double, n double"
    found = measured(rows, model, ["y", "i"], "sample_text", kinds, lambda mean, excess, n: {"mean": mean, "excess": excess, "n": n})
    sample = found.orderBy("i", "excess", "mean", "n").limit(CURVE_ROWS).toPandas()
    return fit_curve(model, *(sample[name].to_numpy(float) for name in ("mean", "excess", "n", "y")))


def fit_curve(model: Model, mean: np.ndarray, excess: np.ndarray, words: np.ndarray, y: np.ndarray) -> Model:
    """Logistic regression of the label on both measures and log length."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    w = np.array([0.0, 0.0, np.log(share / (1 - share)), 0.0])
    if 0 < y.sum() < len(y):
        scale = np.array([mean.std() + 1e-9, excess.std() + 1e-9, 1.0, 1.0])
        x = np.stack([mean, excess, np.ones_like(mean), np.log1p(words)], axis=1) / scale
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(4)
            w = w + np.clip(np.linalg.solve(bend, x.T @ (y - p) - 1e-2 * w), -4, 4)
        w = w / scale
    return replace(model, weights=tuple(w.tolist()))


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence) per row, repeated rows and null ids as they come; an empty table gives none.

    The evidence is the difference of log-likelihoods per byte. A null text and one without words have
    none, and the score of length 0.
    """
    kinds = "score double, evidence double"
    return measured(docs, model, [id_col], text_col, kinds, lambda mean, excess, n: {"score": model.curve(mean, excess, n), "evidence": mean})


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is below ``least``, with all their columns.

    Each row is judged by its text alone: repeated rows stay or go together, null ids are as others.
    Null texts and those without words stay: nothing in them is toxic.
    """

    def keep(batches):
        evidence = None
        for batch in parts(batches):
            evidence = evidence or Evidence([mapped(path) for path in model.paths])
            mean, excess, n = evidence.of(binary(batch, text_col))
            yield batch.filter(pa.array((model.curve(mean, excess, n) < least) | (n == 0)))

    return docs.mapInArrow(lean(keep), docs.schema)
