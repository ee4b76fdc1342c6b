"""Removal of repeats against a plain search of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tillstream.llm import repeats as R

from .conftest import SCHEMA


def plain_rows(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of (doc_id, text) by all windows of 100 bytes."""
    rows = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1]).digest()))
    seen, out = set(), []
    for doc_id, text in rows:
        gone = np.zeros(len(text) + 1, np.int32)
        for i in range(len(text) - 99):
            window = text[i : i + 100]
            if window in seen:
                gone[i] += 1
                gone[i + 100] -= 1
            seen.add(window)
        removed = np.cumsum(gone)[:-1] > 0
        kept = bytes(b for b, r in zip(text, removed.tolist(), strict=True) if not r)
        spans = int(np.sum(np.diff(np.concatenate([[False], removed]).astype(int)) == 1))
        out.append((doc_id, len(text), int(removed.sum()), spans, kept))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in frame.collect()), key=repr)


def test_anchors_are_the_same_in_equal_windows():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 40):
        texts = [rng.integers(97, 97 + letters, n).astype(np.uint8).tobytes() for n in (0, 40, 99, 100, 101, 400, 230)]
        texts.append(texts[5][50:250] + texts[6][:130])
        which, place, hashes = R._anchors_of(texts)
        chosen = {}
        for i, text in enumerate(texts):
            at = place[which == i].tolist()
            assert all(text[p : p + 48] and p + 48 <= len(text) for p in at)
            for s in range(len(text) - 99):
                inside = tuple(p - s for p in at if s <= p <= s + 52)
                assert inside
                least = hashes[which == i][[s <= p <= s + 52 for p in at]].min()
                best = tuple(p - s for p, h in zip(at, hashes[which == i], strict=True) if s <= p <= s + 52 and h == least)
                assert chosen.setdefault(text[s : s + 100], best) == best


def test_intervals_of_the_tree():
    rng = random.Random(2)
    for _ in range(200):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 8))).encode() for _ in range(rng.randint(1, 12))]
        group = np.array([rng.randint(0, 1) for _ in strings])
        tree = R.Tree(group, strings)
        got = {(d, frozenset(tree.order[a:b].tolist())) for d, part in tree.intervals().items() for a, b in part}
        want = set()
        for i in range(len(strings)):
            for j in range(i):
                if group[i] == group[j]:
                    d = next((k for k, (x, y) in enumerate(zip(strings[i], strings[j], strict=False)) if x != y), min(len(strings[i]), len(strings[j])))
                    want.add((d, frozenset(k for k in range(len(strings)) if group[k] == group[i] and strings[k][:d] == strings[i][:d] and len(strings[k]) >= d)))
        assert got == want


def test_cover_equals_all_pairs(monkeypatch):
    monkeypatch.setattr(R, "FREE", 6)
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 14)
        before = ["".join(rng.choice("ab") for _ in range(rng.choice([6, 6, 3, 0]))).encode() for _ in range(n)]
        after = ["".join(rng.choice("ab") for _ in range(rng.choice([6, 6, 4, 0]))).encode() for _ in range(n)]
        group = np.array([rng.randint(0, 1) for _ in range(n)])
        left, right = R.covered(group, before, after)
        for i in range(n):
            pairs = []
            for j in range(i):
                if group[i] == group[j]:
                    a = next((k for k in range(6) if before[i][-k - 1 : len(before[i]) - k] != before[j][-k - 1 : len(before[j]) - k] or k >= min(len(before[i]), len(before[j]))), 6)
                    b = next((k for k in range(6) if k >= min(len(after[i]), len(after[j])) or after[i][k] != after[j][k]), 6)
                    pairs += [(a, b)] if a + b >= 6 else []
            assert (left[i], right[i]) == (max((a for a, _ in pairs), default=-1), max((b for _, b in pairs), default=-1))


@pytest.fixture(scope="module")
def passages(spark):
    """Texts that share passages of about 100 bytes, with other bytes around them."""
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefgh éü") for _ in range(rng.randint(60, 260))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice(base) for _ in range(rng.randint(0, 4))]
        parts = [p[rng.randint(0, 30) : len(p) - rng.randint(0, 30)] if rng.random() < 0.7 else p for p in parts]
        rows.append((i // 2 if i % 17 == 0 else i, "".join(p + rng.choice(["", "x", "yz"]) for p in parts)))
    rows += [(200, "z" * 350), (201, "z" * 99), (202, "ab" * 200), (203, rows[5][1]), (203, rows[5][1])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(7)


def test_removed_bytes_equal_a_search_of_all_windows(passages):
    assert found(R.without_repeats(passages)) == plain_rows(passages.collect())


def test_anchors_with_many_contexts_give_the_same(passages, monkeypatch):
    monkeypatch.setattr(R, "MOST_CONTEXTS", 2)
    assert found(R.without_repeats(passages)) == plain_rows(passages.collect())


def test_contexts_in_small_blocks_give_the_same(passages, monkeypatch):
    monkeypatch.setattr(R, "CONTEXTS_AT_ONCE", 3)
    monkeypatch.setattr(R, "ANCHORS_PER_ROW", 3)
    monkeypatch.setattr(R, "BYTES_AT_ONCE", 300)
    assert found(R.without_repeats(passages)) == plain_rows(passages.collect())


def test_whole_table(documents):
    part = documents.select("doc_id", "text")
    got = R.repeat_digests(part).collect()
    want = [(*row[:4], hashlib.sha256(row[4]).hexdigest()) for row in plain_rows(part.collect())]
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_rows(odd, empty):
    assert found(R.without_repeats(odd)) == plain_rows(odd.select("doc_id", "text").collect())
    assert R.without_repeats(empty).collect() == [] and odd.sparkSession.createDataFrame([], SCHEMA).count() == 0
