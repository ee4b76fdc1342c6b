"""Runs against a search of all periods, and the query against plain Python over a whole table."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

from tillstream.llm import periodic_runs as P

from .conftest import FOLDER


def plain_runs(words):
    """(start, length, period) of all runs, trying every period."""
    ids = {word: i for i, word in enumerate(dict.fromkeys(words))}
    w, n, found = np.array([ids[word] for word in words], np.int64), len(words), {}
    for q in range(1, n // 4 + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], w[:-q] == w[q:], [False]]).astype(np.int8)))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
    return sorted((start, length, q) for (start, length), q in found.items())


def listed(runs):
    return [list(zip(*map(np.ndarray.tolist, part), strict=True)) for part in runs]


def made_text(rng):
    letters = [b"%d" % i for i in range(rng.choice([1, 2, 2, 3]))]
    words = []
    for _ in range(rng.randint(0, 4)):
        unit = words[-rng.randint(1, len(words)) :] if words and rng.random() < 0.4 else [rng.choice(letters) for _ in range(rng.randint(1, 7))]
        words += (unit * rng.randint(1, 8))[: rng.randint(1, 120)]
    return words


def test_runs_equal_a_search_of_all_periods():
    rng = random.Random(11)
    for _ in range(1_500):
        texts = [made_text(rng) for _ in range(rng.randint(0, 4))]
        assert listed(P.runs_of(texts)) == [plain_runs(words) for words in texts]


def test_texts_are_searched_apart_or_together(monkeypatch):
    rng = random.Random(12)
    texts = [made_text(rng) for _ in range(50)]
    together = listed(P.runs_of(texts))
    monkeypatch.setattr(P, "WORDS_AT_ONCE", 30)
    assert listed(P.runs_of(texts)) == together


def test_wavelet_tree_answers_range_successor():
    rng = np.random.default_rng(13)
    values = rng.permutation(200) % 90
    tree = P.WaveletTree(values)
    lo, size = rng.integers(0, 200, 400), rng.integers(0, 60, 400)
    hi, x = np.minimum(lo + size, 200), rng.integers(0, 140, 400)
    most = x + rng.integers(0, 50, 400)
    want = [min((v for v in values[a:b] if c <= v <= d), default=-1) for a, b, c, d in zip(lo, hi, x, most, strict=True)]
    assert tree.successor(lo, hi, x, most).tolist() == want


def plain_row(doc_id, text):
    words, n = (text or "").encode().split(), len((text or "").encode().split())
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return doc_id, len(runs), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest()


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_whole_table_equals_plain_python(documents):
    got = P.run_digests(documents).select(COLUMNS).collect()
    rows = documents.select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(plain_row(*row) for row in rows)
    assert sum(row["n_runs"] > 0 for row in got) > len(rows) // 20


def test_odd_rows(odd, empty):
    got = P.run_digests(odd).select(COLUMNS).collect()
    want = [plain_row(*row) for row in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert P.run_digests(empty).collect() == [] and P.periodic_runs(empty).collect() == []


def test_spans_and_collapsed_texts(odd):
    rows = {row["doc_id"]: row for row in P.periodic_runs(odd).collect()}
    assert [tuple(run) for run in rows[6]["runs"]] == [(0, 60_000, 12)]
    assert rows[6]["collapsed"].split() == odd.where("doc_id = 1").first()["text"].split()[:12]
    assert rows[3]["runs"] == [] and rows[3]["collapsed"] == "" and rows[3]["n_words"] == 0
