"""Stretches of a text that repeat with a period, found by internal pattern matching.

A run is a stretch of words that equals itself shifted by its smallest period q, has at least
``max(6, 4 q)`` words, and that no neighbouring word extends. The words of a batch of texts are one
sequence in which every text has an alphabet of its own, so nothing matches across texts.

* Factors of 2^k words get names by prefix doubling; only positions whose name is not yet unique
  are sorted again. The last order is the suffix array, and the occurrences of a factor are an
  interval of it that its name states.
* A dyadic block is a factor of 2^k words that starts at a multiple of 2^k in its text. A run with
  (2^(k+1) - 1) / 3 <= q < (2^(k+2) - 1) / 3 holds such a block and its copy q words on. That copy
  starts in a neighbouring window shorter than the block, in which the occurrences of the block
  form one progression. A wavelet tree over the suffix array answers "the first occurrence at or
  behind x" (range successor), so two or three questions tell the progression.
* One or two occurrences give their distances as candidate periods. More have the block's own
  period p as difference; then q is the shift from the stretch of period p around the block to
  the one around the progression, measured at their left or at their right ends.
* A candidate is stretched by longest common extensions on the names, and kept if long enough.

For n words that makes O(n) candidates, found in O(n log n) range questions in the worst case.

Null and empty texts have no words and no run; repeated rows each give their row; a null id is
kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary, over_batches

#: A run has at least so many words, and so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Texts are searched together up to about so many words; a longer text is searched alone.
WORDS_AT_ONCE = 500_000


def _numbered(words: list[bytes]) -> np.ndarray:
    """Numbers of the words of a text, in order of their first appearance."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


class WaveletTree:
    """Numbers below 2^bits in a fixed order; counts and order statistics of intervals of them."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        self.split: list[int] = []
        for bit in reversed(range(self.bits)):
            low = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=before[1:])
            self.zeros.append(before)
            self.split.append(int(before[-1]))
            values = np.concatenate([values[low], values[~low]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values in [lo, hi) are less than x (below 2^bits)."""
        lo, hi, total = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        for level, before in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            lo0, hi0 = before[lo], before[hi]
            total += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, lo - lo0 + self.split[level], lo0), np.where(one, hi - hi0 + self.split[level], hi0)
        return total

    def smallest(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of the given rank (from 0) in [lo, hi), which must hold more values."""
        lo, hi, rank, value = lo.copy(), hi.copy(), rank.copy(), np.zeros(len(lo), np.int64)
        for level, before in enumerate(self.zeros):
            lo0, hi0 = before[lo], before[hi]
            one = rank >= hi0 - lo0
            rank -= np.where(one, hi0 - lo0, 0)
            value = value * 2 + one
            lo, hi = np.where(one, lo - lo0 + self.split[level], lo0), np.where(one, hi - hi0 + self.split[level], hi0)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The least value in [lo, hi) that is at least x and at most ``most``; -1 without one."""
        found = np.full(len(lo), -1, np.int64)
        rank = self.below(lo, hi, np.minimum(x, (1 << self.bits) - 1))
        some = np.flatnonzero((rank < hi - lo) & (x < 1 << self.bits))
        found[some] = self.smallest(lo[some], hi[some], rank[some])
        return np.where(found <= most, found, -1)


class Factors:
    """Names of the factors of 2^k words of several texts, and their suffix array."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.n = n = len(words)
        self.start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.end = self.start + np.repeat(sizes, sizes)
        key = np.repeat(np.arange(len(sizes)), sizes) * (int(words.max(initial=0)) + 1) + words
        order = np.argsort(key, kind="stable")
        name = np.empty(n, np.int64)
        _, head, count = np.unique(key[order], return_index=True, return_counts=True)
        name[order] = np.repeat(head, count)
        #: Names by k: the place in the order where the equal factors begin; -1 behind the last word.
        self.names: list[np.ndarray] = []
        size = np.empty(n, np.int64)
        size[order] = np.repeat(count, count)
        self.sizes: list[np.ndarray] = []
        while True:
            self.names.append(np.append(name, -1).astype(np.int32))
            self.sizes.append(size.astype(np.int32))
            open_ = np.flatnonzero(size[order] > 1)
            if not len(open_):
                break
            at, step = order[open_], 1 << (len(self.names) - 1)
            follow = at + step
            inside = follow < self.end[at]
            second = np.where(inside, name[np.where(inside, follow, 0)] + 1, 0)
            pair = name[at] * (n + 1) + second
            by = np.argsort(pair, kind="stable")
            at, pair = at[by], pair[by]
            order[open_] = at
            first = np.flatnonzero(np.diff(pair, prepend=pair[0] - 1))
            count = np.diff(first, append=len(pair))
            # Open places of one name are adjacent, so a group's place is that of its first member.
            name, size = name.copy(), size.copy()
            name[at] = np.repeat(open_[first], count)
            size[at] = np.repeat(count, count)
        self.order = order

    def common_right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that begins at i and at j (i < j, one text; j may be its end)."""
        i, j, length = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.names))):
            same = np.where(self.names[k][i] == self.names[k][j], 1 << k, 0)
            i, j, length = i + same, j + same, length + same
        return length

    def common_left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that ends before i and before j (i < j, one text)."""
        i, j, length = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        low = self.start[np.minimum(i, self.n - 1)]
        for k in reversed(range(len(self.names))):
            room = i - (1 << k) >= low
            a, b = np.where(room, i - (1 << k), 0), np.where(room, j - (1 << k), 0)
            same = np.where(room & (self.names[k][a] == self.names[k][b]), 1 << k, 0)
            i, j, length = i - same, j - same, length + same
        return length


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in the text, length, period) of all runs, by text, start and period.

    ``words`` are the numbers of the words of all texts, ``sizes`` the texts' numbers of words.
    """
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, none, none
    f = Factors(words, sizes)
    if len(f.names) < 2:
        return none, none, none, none
    # The tree holds suffixes whose first two words recur; others are no occurrences of a block.
    kept = f.sizes[1][f.order] > 1
    place = np.zeros(f.n + 1, np.int64)
    np.cumsum(kept, out=place[1:])
    inside = np.arange(f.n) - f.start
    tree = WaveletTree(inside[f.order[kept]])
    found = []
    for k in range(1, len(f.names)):
        block = 1 << k
        s = np.flatnonzero((f.sizes[k] > 1) & (inside & (block - 1) == 0))
        lo = place[f.names[k][s]]
        hi = lo + f.sizes[k][s]
        window = inside[s] + (4 * block - 2) // 3
        one = tree.successor(lo, hi, inside[s] + (2 * block + 1) // 3, window)
        some = one >= 0
        s, lo, hi, window, one = s[some], lo[some], hi[some], window[some], one[some]
        two = tree.successor(lo, hi, one + 1, window)
        more = np.flatnonzero(two >= 0)
        three = np.full(len(s), -1, np.int64)
        three[more] = tree.successor(lo[more], hi[more], two[more] + 1, window[more])
        few, many = three < 0, np.flatnonzero(three >= 0)
        pairs = few & (two >= 0)
        found += [(s[few], one[few] - inside[s[few]]), (s[pairs], two[pairs] - inside[s[pairs]])]
        if len(many):
            at, p = s[many], (two - one)[many]
            there = at + (one[many] - inside[at])
            left = f.common_left(there, there + p) - f.common_left(at, at + p)
            right = f.common_right(there, there + p) - f.common_right(at, at + p)
            found += [(at, there - at - left), (at, there - at + right)]
    at, q = (np.concatenate(part) for part in zip(*found, strict=True))
    real = (q > 0) & (at + q <= f.end[at])
    at, q = at[real], q[real]
    begin = at - f.common_left(at, at + q)
    stop = at + q + f.common_right(at, at + q)
    long = stop - begin >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
    begin, stop, q = begin[long], stop[long], q[long]
    # Of several periods of one stretch the smallest counts.
    by = np.lexsort((q, stop, begin))
    begin, stop, q = begin[by], stop[by], q[by]
    first = np.ones(len(by), bool)
    first[1:] = (np.diff(begin) != 0) | (np.diff(stop) != 0)
    begin, stop, q = begin[first], stop[first], q[first]
    by = np.lexsort((q, begin))
    begin, stop, q = begin[by], stop[by], q[by]
    text = np.searchsorted(np.cumsum(sizes), begin, side="right")
    return text, begin - f.start[begin], stop - begin, q


def collapsed(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay if of each run only the first period does."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts + periods, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) == 0


def _groups(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Consecutive texts that are searched together, as (first, behind the last)."""
    first = total = 0
    for i, words in enumerate(texts):
        if i > first and total + len(words) > WORDS_AT_ONCE:
            yield first, i
            first, total = i, 0
        total += len(words)
    if first < len(texts):
        yield first, len(texts)


def runs_of(texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, lengths, periods) of the runs of each text, given as its words."""
    out = []
    for first, behind in _groups(texts):
        part = texts[first:behind]
        sizes = np.array([len(words) for words in part], np.int64)
        ids = np.concatenate([_numbered(words) for words in part])
        text, starts, lengths, periods = find_runs(ids, sizes)
        cut = np.searchsorted(text, np.arange(len(part) + 1))
        out += [(starts[a:b], lengths[a:b], periods[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return out


def damaged(words: list[bytes], seed: int | None) -> list[bytes]:
    """The contract's test damage: some texts get a repeating tail. ``seed`` is crc32 of the id."""
    n = len(words)
    if seed is None or seed % 10 or not n:
        return words
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    for batch in batches:
        seeds = batch.column("seed").to_pylist()
        texts = [damaged((text or b"").split(), seed) for text, seed in zip(binary(batch, "text"), seeds, strict=True)]
        yield batch, texts, runs_of(texts)


def _seeded(docs: DataFrame, damage: bool) -> DataFrame:
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary")) if damage else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", seed.alias("seed"))


def periodic_runs(docs: DataFrame, damage: bool = False) -> DataFrame:
    """Per document its runs, and the text with one period of each run, words joined by one space."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, runs in _searched(batches):
            listed = [[{"start": s, "length": n, "period": q} for s, n, q in zip(*map(np.ndarray.tolist, r), strict=True)] for r in runs]
            kept = [b" ".join(_kept(w, r)).decode("utf-8", "replace") for w, r in zip(texts, runs, strict=True)]
            row = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in texts], pa.int64()), pa.array(listed, pa.list_(row)), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return over_batches(_seeded(docs, damage), ["doc_id", "text", "seed"], search, RUNS)


def _kept(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[bytes]:
    if not len(runs[0]):
        return words
    return [words[i] for i in np.flatnonzero(collapsed(len(words), *runs))]


def run_digests(docs: DataFrame, damage: bool = True) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of runs and collapsed text."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, runs in _searched(batches):
            rows = [_digest(w, *r) for w, r in zip(texts, runs, strict=True)]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(part, kind) for part, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words"]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    return over_batches(_seeded(docs, damage), ["doc_id", "text", "seed"], search, DIGEST + ", n_words long")


def _digest(words: list[bytes], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> tuple:
    best: tuple = (None,) * 4
    listed = b""
    if len(starts):
        i = np.lexsort((periods, starts, -lengths))[0]
        start, length, period = int(starts[i]), int(lengths[i]), int(periods[i])
        best = (start, length, period, 1000 * length // period)
        rows = zip(starts.tolist(), lengths.tolist(), periods.tolist(), strict=True)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()
    kept = b" ".join(_kept(words, (starts, lengths, periods)))
    return (len(starts), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest(), len(words))
