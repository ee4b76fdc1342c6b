"""Operators against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tillstream.llm import common as C
from tillstream.llm import decontamination as D
from tillstream.llm import jaccard_join as J
from tillstream.llm import line_dedup as L
from tillstream.llm import mixing as M
from tillstream.llm import personal_data as P
from tillstream.llm import quality_ranking as K
from tillstream.llm import quality_rules as Q
from tillstream.llm import token_blocks as B
from tillstream.llm import toxicity as X
from tillstream.llm import url_filter as U
from tillstream.llm.common import WordHashes, lean, parts, remainder
from tillstream.llm.components import components
from tillstream.llm.text_stats import describe

from .conftest import FOLDER

WORDS = re.compile("[^\x20\x09-\x0D]+")


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


# 1. Lines


def deduped(rows, least=L.LEAST_WORDS):
    first, out = {}, {}
    for name, text in sorted(rows):
        for i, line in enumerate((text or "").split("\n")):
            words = tuple(WORDS.findall(line))
            if words:
                first.setdefault(words, (name, i))
    known = sorted(first, key=first.get)
    near = {b for k, b in enumerate(known) if len(b) >= least and any(len(a) >= least and distance_one(a, b) for a in known[:k] if abs(len(a) - len(b)) < 2)}
    for name, text in rows:
        kept = []
        for i, line in enumerate((text or "").split("\n")):
            words = tuple(WORDS.findall(line))
            if not words or (first[words] == (name, i) and words not in near):
                kept.append(line)
        out[name] = "\n".join(kept)
    return out


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_lines_match_brute_force(spark, documents):
    made = spark.createDataFrame(
        [(10_000, "one two three four five six"), (10_001, "one two three four five\none two three 4 five six\na b\na c"), (10_002, "zero one two three four five six\na b\n\n")],
        "doc_id long, text string",
    )
    frame = documents.select("doc_id", "text").limit(60).unionByName(made).cache()
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(frame).collect()}
    assert got == deduped(texts(frame))


def test_variants_of_lines():
    text = b"a b c\n\nb c\nx a b c y"
    lines = L.Lines(text, WordHashes(), L.Powers())
    split = [line.split() for line in text.split(b"\n") if line]
    made = list(zip(*(x.tolist() for x in lines.variants())))
    assert [x[:2] for x in made] == [(i, at) for i, words in enumerate(split) for at in range(len(words))]
    for i, at, name in made:
        left = b" ".join(split[i][:at] + split[i][at + 1 :])
        assert name == L.Lines(left, WordHashes(), L.Powers()).names[0]


def test_lines_shuffle_little(spark, monkeypatch):
    """Lines that share a half and nothing else: their many variants are not stored."""
    made = {}
    keep = L.stored
    monkeypatch.setattr(L, "stored", lambda df, what: made.setdefault(what, keep(df, what)))
    rows = [(i, f"a b c d e f g h {i} {i + 1} {i + 2} {i + 3} {i + 4} {i + 5}") for i in range(0, 3_000, 10)]
    rows.append((9_999, "a b c d e f g h 10 11 12 13 14 changed"))
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("n_near > 0 or n_equal > 0").collect()
    assert [(r["doc_id"], r["n_near"]) for r in got] == [(9_999, 1)]
    assert made["variants"].count() < 100


def test_lines_are_stored_once(spark, monkeypatch):
    """A task stores the content of a line where it first meets it, and of lines long enough only; in little room."""
    made = {}
    keep = C.stored
    monkeypatch.setattr(C, "stored", lambda df, what, *codec: made.setdefault(what, keep(df, what, *codec)))
    monkeypatch.setattr(L, "stored", C.stored)
    body = "\n".join(["a b c d e f", "a b", "a b c d x f", "a b c d e f"])
    rows = [(i, f"{body}\nown {i} b c d") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for seen in (L.SEEN, 1):
        monkeypatch.setattr(L, "SEEN", seen)
        made.clear()
        got = {r["doc_id"]: r["text"] for r in L.dedup_lines(frame.coalesce(1)).collect()}
        assert got == deduped(rows)
        contents = [bytes(r["content"]) for r in made["lines"].where("content is not null").collect()]
        assert len(contents) == len(set(contents)) == 52 and made["lines"].count() == 250
    assert all(".zstd." in path for path in made["lines"].inputFiles())


def test_lines_of_odd_rows(odd, empty):
    rows = L.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["text"] is None and by[4]["text"] == "" and by[3]["n_lines"] == 0
    assert L.dedup_lines(empty).count() == 0


# 2. Benchmark


def test_planted_items_are_found_and_clean_documents_left(spark, documents):
    item = " ".join(f"item{i}" for i in range(30))
    changed = item.replace("item7 ", "seven ").replace("item19", "nineteen")
    half = " ".join(f"item{i}" for i in range(11))
    docs = spark.createDataFrame(
        [(1, f"before {item.upper()}, after"), (2, f"x y {changed}!"), (3, f"{half} and then something else entirely " * 2), (4, "nothing"), (5, None), (6, "")],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (None, item)], "item_id long, text string")
    found = D.contaminated(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 1)}
    assert {r["doc_id"] for r in D.without_contaminated(docs, benchmark).collect()} == {3, 4, 5, 6}
    clean = documents.select("doc_id", "text")
    assert D.contaminated(clean, benchmark).count() == 0


def test_benchmark_matches_brute_force(spark, documents):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(documents, benchmark).collect()}
    items = [(r["item_id"], D.plain_words(r["text"])) for r in benchmark.collect()]
    places = {}
    for item, sought in items:
        for off, word in enumerate(sought):
            places.setdefault(word, []).append((item, sought, off))
    want = set()
    for name, text in texts(documents):
        words = D.plain_words(text)
        diagonals = {}
        for at, word in enumerate(words):
            for item, sought, off in places.get(word, ()):
                diagonals.setdefault((item, at - off), (sought, []))[1].append(off)
        for (item, _), (sought, offs) in diagonals.items():
            window = min(len(sought), D.WINDOW)
            if max(sum(first <= o < first + window for o in offs) for first in offs) * 100 >= 80 * window:
                want.add((name, item))
    assert got == want and want


def test_seeds_miss_no_pattern_of_changes():
    item = np.arange(1, 21, dtype=np.uint64)
    for count in range(1, 21):
        words = item[:count]
        shown = [(mask, D.seeds(words, mask)) for mask in D.masks_of(count)]
        assert all(mask[0] == 0 and len(mask) <= count - count // 5 for mask, _ in shown)
        for changed in itertools.combinations(range(count), count // 5):
            other = words.copy()
            other[list(changed)] += np.uint64(100)
            assert any((own == D.seeds(other, mask)).any() for mask, own in shown), (count, changed)


def test_masks_ignore_what_lies_between_their_places():
    mask = (0, 1, 3)
    words = np.arange(1, 30, dtype=np.uint64)
    other = words.copy()
    other[[4, 12]] = 77
    same = D.seeds(words, mask) == D.seeds(other, mask)
    assert same[2] and same[10] and not same[[1, 3, 4, 9, 11, 12]].any()
    assert D.seeds(words[:3], mask).size == 0 and not set(D.seeds(words, (0, 1, 3))) & set(D.seeds(words, (0, 1, 2)))
    # All but the shortest items are sought by masks with gaps.
    assert all(any(m[-1] >= len(m) for m in D.masks_of(count)) for count in range(5, 30))


def test_changed_and_short_items_are_found(spark):
    words = [f"w{i}" for i in range(40)]
    fifth = ["other" if i % 5 == 4 else w for i, w in enumerate(words)]
    items = [(1, " ".join(words)), (2, "quite a short item"), (3, "seven words are here in this item"), (4, "one"), (5, " ,. "), (6, None)]
    rows = [
        (1, "before it " + " ".join(fifth) + " after it"), (2, "x Quite a short, item! y"), (3, "x seven words are there in this item y"),
        (4, "quite a long item"), (5, "seven words were there in this item"), (6, "x y one"), (7, " ".join(["other" if i % 4 == 3 else w for i, w in enumerate(words)])),
    ]
    found = D.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (2, 2), (3, 3), (6, 4)}


def test_benchmark_of_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor")], "item_id long, text string")
    assert {r["doc_id"] for r in D.contaminated(odd, benchmark).collect()} == {1, 2, 6, None}
    left = D.without_contaminated(odd, benchmark)
    assert left.columns == odd.columns and left.count() == 7
    assert D.contaminated(empty, benchmark).count() == 0
    assert D.contaminated(odd, benchmark.limit(0)).count() == 0


# 3 and 4. Quality


def test_counts_of_rules():
    text = "a b c a b c x\na b c a b c x\n\n \nend #*$ <é>"
    counts, _ = describe(text.encode())
    assert counts == [17, 23, 5, 1, 14]
    assert describe(None) == describe(b"") and describe(b" \n")[0] == [0] * 5


def test_trees_keep_their_constraints_and_separate():
    rng = np.random.default_rng(1)
    x = rng.random((2_000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(20 * x[:, 0]) < 0.6) & (x[:, 1] > 0.2)).astype(float)
    forest = Q.fit_forest(x, y, [-1, 0, 0])
    grid = np.stack([np.linspace(0, 1, 200), np.full(200, 0.7), np.full(200, 0.5)], axis=1)
    assert (np.diff(forest.margin(grid)) <= 1e-12).all()
    # No cut of one feature alone does better than these two together.
    cuts = np.linspace(0, 1, 101)
    best = max((((x[:, 0] < a) & (x[:, 1] > b)) == (y > 0)).mean() for a in cuts for b in cuts[:50])
    assert ((forest.probability(x) > 0.5) == (y > 0)).mean() > best - 0.02
    falling = (x[:, 0] + 0.5 * x[:, 2] < 0.7).astype(float)
    forest = Q.fit_forest(x, falling, [-1, 0, -1])
    assert ((forest.probability(x) > 0.5) == (falling > 0)).mean() > 0.93
    assert (Q.fit_forest(x, np.ones(2_000), [0, 0, 0]).probability(x) > 0.9).all()
    assert Q.fit_forest(np.zeros((0, 3)), np.zeros(0), [0, 0, 0]).probability(x).shape == (2_000,)


def test_quality_models_on_held_out(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in known.where(remainder("doc_id", 5) == 0).collect()}
    where = remainder("doc_id", 5) != 0
    scores = {r["doc_id"]: r["score"] for r in K.score_quality(docs, K.fit_quality(docs, known, where=where)).collect()}
    assert np.mean([(scores[k] >= K.CUT) == (v == 1) for k, v in truth.items()]) > 0.9
    kept = {r["doc_id"]: r for r in Q.apply_rules(docs, Q.fit_rules(docs, known, where=where)).collect()}
    assert np.mean([kept[k]["kept"] == (v == 1) for k, v in truth.items() if not kept[k]["base_failed"]]) > 0.9


def test_quality_of_odd_rows(odd, empty, labels):
    for rows in (Q.apply_rules(odd, Q.fit_rules(odd, labels)), K.score_quality(odd, K.fit_quality(odd, labels))):
        found = rows.collect()
        assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert Q.apply_rules(empty, Q.fit_rules(empty, labels)).count() == 0
    assert K.score_quality(empty, K.fit_quality(empty, labels.limit(0))).count() == 0


# 5. Jaccard join


def classes(rows, width, percent):
    sets = []
    for _, text in rows:
        words = WORDS.findall((text or "").encode().lower().decode())
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    least = [name for name, _ in rows]
    changed = True
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and (100 + percent) * len(sets[i] & sets[j]) >= percent * (len(sets[i]) + len(sets[j]))]
    while changed:
        changed = False
        for i, j in links:
            low = min(least[i], least[j])
            if least[i] != low or least[j] != low:
                least[i] = least[j] = low
                changed = True
    return {name: (len(s), c) for (name, _), s, c in zip(rows, sets, least)}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_classes_match_brute_force(spark, documents, width, percent):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(80)]
    near = []
    for k in range(60):  # near copies of near copies
        words = list(base)
        for at in rng.integers(0, 80, rng.integers(0, 6)):
            words[at] = f"c{k}_{at}"
        near.append((50_000 + k, " ".join(words)))
    frame = documents.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_classes(frame, width=width, percent=percent).collect()}
    assert got == classes(texts(frame), width, percent)


def test_links_inside_a_group_of_equal_prefixes(spark):
    """Three sets with the same rare shingles, which no other set has: two are similar, the third to neither."""
    rows = []
    for k in range(12):
        head = [f"h{k}_{i}" for i in range(3)]
        x, y = ([f"{c}{k}_{i}" for i in range(7)] for c in "xy")
        made = [head + x, head + y, [*head, *y[:6], f"z{k}"]]
        rows += [(100 * k + i, " ".join(words)) for i, words in enumerate(made)]
        rows += [(100 * k + 10 + i, " ".join([*x, *y, f"z{k}"])) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_classes(frame, width=1, percent=80).collect()}
    assert all(got[100 * k + 2][1] == 100 * k + 1 for k in range(12))
    assert got == classes(rows, 1, 80)


def test_classes_of_odd_rows(odd, empty):
    rows = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in J.jaccard_classes(odd).collect()))
    assert len(rows) == odd.count()
    assert all(c == 1 for i, _, c in rows if i in (1, 2)) and all(c is None for i, _, c in rows if i == 0)
    assert [c for i, n, c in rows if i in (3, 4, 5)] == [3, 4, 5]
    assert J.jaccard_classes(empty).count() == 0
    kept = J.one_of_each_class(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 6. Addresses


def test_urls(spark):
    urls = {
        1: ("HTTP://Spam-Farm.example.org/a?b", "spam-farm.example.org", "/a", None, "block"),
        2: ("https://m.adult-x.example.com/fr/", "m.adult-x.example.com", "/fr/", "com/", "allow"),
        3: ("https://WWW.example.com/en/x#y", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        4: ("https://b.example.com/en/x", "b.example.com", "/en/x", "example.com/en/", "block"),
        5: ("https://a.net?/es/", "a.net", "", None, "allow"),
        6: ("no scheme", "", "", None, "allow"),
        7: (None, "", "", None, "allow"),
        8: ("", "", "", None, "allow"),
        9: ("x://notspam-farm.example.org/", "notspam-farm.example.org", "/", None, "allow"),
        10: ("x://" + "a." * 5_000 + "net/fr/", "a." * 5_000 + "net", "/fr/", "net/fr/", "block"),
    }
    pages = spark.createDataFrame([(k, v[0], "h") for k, v in urls.items()], "page_id long, url string, host string")
    got = {r["page_id"]: tuple(r)[1:] for r in U.judge_urls(pages).collect()}
    assert got == {k: v[1:] for k, v in urls.items()}
    assert U.judge_urls(pages.limit(0)).count() == 0
    listed = U.judge_urls(pages, spark.createDataFrame([], "entry string"), rules=())
    assert {r["verdict"] for r in listed.collect()} == {"allow"}


def test_digest_collisions_are_told_apart(monkeypatch):
    monkeypatch.setattr(U.xxhash, "xxh64_intdigest", lambda entry: 7)
    file = U.Digests(U.encode_digests(0, 1, [b"a", b"b"]))
    assert file.holds(np.array([7, 7, 7], np.uint64), [b"b", b"c", b"a"]).tolist() == [True, False, True]


# 7. Mixing


def test_seats_are_those_of_the_highest_quotients():
    rng = np.random.default_rng(0)
    for _ in range(100):
        votes, seats = rng.integers(0, 30, 6).astype(float), int(rng.integers(0, 40))
        got = [0] * 6
        for _ in range(seats if votes.sum() else 0):
            got[max(range(6), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
        assert M.apportion(votes, seats).tolist() == got


def test_seats_of_equal_quotients_are_exact():
    rng = np.random.default_rng(9)
    for _ in range(1_500):
        votes, seats = rng.integers(0, 12, int(rng.integers(1, 7))), int(rng.integers(0, 30))
        got = [0] * len(votes)
        for _ in range(seats if votes.sum() else 0):
            got[max(range(len(votes)), key=lambda i: (Fraction(int(votes[i]), 2 * got[i] + 1), -i))] += 1
        assert M.apportion(votes, seats).tolist() == got
    many = M.apportion(rng.random(20_000) * 1e9, 1_000_003)
    assert many.sum() == 1_000_003


def test_mix_reaches_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = M.mix_sources(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (rows["taken"] <= 2 * rows["size"]).all()
    by = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), told=("source_size", "first"))
    assert (by["size"] == by["told"]).all() and (abs(by["taken"] - by["target"]) <= M.BLOCK).all()
    again = M.mix_sources(docs.repartition(7)).toPandas()
    assert dict(zip(rows["doc_id"], rows["taken"])) == dict(zip(again["doc_id"], again["taken"]))
    words = {}
    for name, text in texts(M.mixed_texts(docs)):
        words[name] = words.get(name, 0) + len(WORDS.findall(text))
    assert words == {k: v for k, v in zip(rows["doc_id"], rows["taken"]) if v}


def test_targets_are_capped_and_reshared():
    assert M.targets([10, 100, 1000, 0]) == [20, 200, 1445, 0]
    assert M.targets([]) == []


def test_mix_of_odd_rows(odd, empty):
    rows = M.mix_sources(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert M.mix_sources(empty).count() == 0 and M.mixed_texts(empty).count() == 0
    assert M.mixed_texts(odd).columns == odd.columns


# 8. Toxicity


def test_toxicity_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = X.fit_toxicity(docs, known, where=remainder("doc_id", 4) != 2)
    scores = {r["doc_id"]: r["score"] for r in X.score_toxicity(docs, model).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in known.where(remainder("doc_id", 4) == 2).collect()}
    score, toxic = np.array([scores[k] for k in truth]), np.array([v == 1 for v in truth.values()])
    caught, left = score[toxic], score[~toxic]
    area = np.mean((caught[:, None] > left[None, :]) + 0.5 * (caught[:, None] == left[None, :]))
    print("toxicity: accuracy", ((score >= 0.3) == toxic).mean(), "recall", (caught >= 0.3).mean(), "precision", toxic[score >= 0.3].mean(), "area", area)
    assert ((score >= 0.3) == toxic).mean() > 0.95
    assert (caught >= 0.3).mean() >= 0.9 and area >= 0.96


def test_grams_and_their_probabilities():
    keys, word, depth = X.grams([b"ab", b"c"])
    assert [int(k & np.uint64(0xFFFFFF)) for k in keys[1]] == [0x2061, 0x6162, 0x6220, 0x2063, 0x6320]
    assert word.tolist() == [0, 0, 0, 1, 1] and depth.tolist() == [2, 3, 4, 2, 3]


def test_labels_beyond_the_curve_are_counted(spark, documents, labels, monkeypatch):
    seen, count = [], X.count_grams
    monkeypatch.setattr(X, "CURVE_ROWS", 2)
    monkeypatch.setattr(X, "count_grams", lambda docs, known, *names: seen.append(known.count()) or count(docs, known, *names))
    usable = labels.where("doc_id is not null and toxic is not null").select("doc_id").distinct().count()
    X.fit_toxicity(documents, labels)
    assert seen == [usable - 2]


def plain_kneser_ney(words: tuple[Counter, Counter]):
    """Difference of log-likelihoods of a word, by dictionaries of strings and one position at a time."""
    raw: tuple[Counter, Counter] = Counter(), Counter()

    def cut(word):
        padded = b" " + word + b" "
        return [[padded[j - k + 1 : j + 1] for k in range(1, min(X.ORDER, j + 1) + 1)] for j in range(1, len(padded))]

    for c in (0, 1):
        for word, times in words[c].items():
            for grams in cut(word):
                for gram in grams:
                    raw[c][gram] += times
    every = set(raw[0]) | set(raw[1])
    count: tuple[dict, dict] = {}, {}
    for gram in every:
        inner = len(gram) < X.ORDER and (len(gram) == 1 or gram[:1] != b" ")
        for c in (0, 1):
            if len(gram) <= X.SHARED:
                count[c][gram] = sum(1 for g in every if g[1:] == gram) if inner else raw[0][gram] + raw[1][gram]
            else:
                count[c][gram] = sum(1 for g in every if g[1:] == gram and raw[c][g]) if inner else raw[c][gram]
    after: tuple[dict, dict] = {}, {}
    for c in (0, 1):
        for gram, n in count[c].items():
            after[c].setdefault(gram[:-1], []).append(n)

    def likelihood(word, c):
        total = 0.0
        for grams in cut(word):
            p = 1 / 256
            for gram in grams:
                seen = after[c].get(gram[:-1], [])
                whole, kinds = sum(seen), sum(1 for n in seen if n > 0)
                gain = max(count[c].get(gram, 0) - X.DISCOUNT, 0) / (whole + X.PRIOR)
                p = gain + (X.PRIOR + min(X.DISCOUNT * kinds, whole)) / (whole + X.PRIOR) * p
            total += np.log(p)
        return total

    return lambda word: likelihood(word, 1) - likelihood(word, 0)


def test_the_model_is_that_of_plain_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(X, "STEP_WORDS", 3)  # words are counted in slices
    monkeypatch.setattr(X, "HELD_GRAMS", 20)
    texts = [(1, "idiot idiots fool foul", 1.0), (2, "Foul IDIOT idiot é", 1.0), (3, "fools of the house are kind", 0.0), (4, "the house the idiom", 0.0), (5, None, 1.0), (6, "", 0.0)]
    docs = spark.createDataFrame([r[:2] for r in texts], "doc_id long, text string").repartition(3)
    known = spark.createDataFrame([(r[0], r[2]) for r in texts], "sample_id long, sample_label double")
    words: tuple[Counter, Counter] = Counter(), Counter()
    for _, text, label in texts:
        words[int(label)].update((text or "").lower().encode().split())
    paths = X.publish(X.smoothed_table(X.count_grams(docs, known, "doc_id", "text")))
    plain = plain_kneser_ney(words)
    asked = [b"idiot", b"idiotic", b"foul", b"house", b"kindness", "é".encode(), b"zzz", b"a"]
    whole = [X.mapped(path) for path in paths]
    keys, gain, rest = (np.concatenate([getattr(file, name) for file in whole], axis=-1) for name in ("keys", "gain", "rest"))
    assert (np.diff(keys.astype(np.int64)) > 0).all()
    assert np.allclose(X.Evidence(whole).words(asked), [plain(word) for word in asked], atol=1e-5)
    # The same n-grams cut into many files, listed in any order.
    cuts = [X.GramFile(X.encode_grams(keys[i : i + 7], gain[:, i : i + 7], rest[:, i : i + 7])) for i in range(0, len(keys), 7)]
    assert np.array_equal(X.Evidence(cuts[::-1]).words(asked), X.Evidence(whole).words(asked))


def test_measures_are_those_of_the_words(spark, documents, labels):
    model = X.fit_toxicity(documents, labels)
    evidence = X.Evidence([X.mapped(path) for path in model.paths])
    texts = [b"one two  two", b"", None, "Ärger ohne Ende".encode()]
    mean, excess, sizes = evidence.of(texts, step=1)
    for text, a, b, n in zip(texts, mean, excess, sizes):
        words = (text or b"").decode().lower().encode().split()
        values = X.Evidence(evidence.files).words(words)
        assert n == len(words)
        assert np.isclose(a, values.sum() / (len(b" ".join(words)) + 1) if words else 0)
        assert np.isclose(b, np.sqrt(np.clip(values - X.MARGIN, 0, X.MOST).mean()) if words else 0)


def test_the_stage_keeps_what_the_scores_leave(spark, documents, labels):
    model = X.fit_toxicity(documents, labels)
    low = {r["doc_id"] for r in X.score_toxicity(documents, model).where("score < 0.3").collect()}
    assert {r["doc_id"] for r in X.without_toxic(documents, model).collect()} == low and 0 < len(low) < documents.count()


def test_tasks_let_go_of_what_others_held():
    import tokenizers

    path = B.tokenizer_path("word_bpe_49k.json")
    assert B.process_encoder(path) is B.process_encoder(path)
    assert list(lean(lambda batches: batches)([1, 2])) == [1, 2] and not hasattr(tokenizers, "tillstream_encoders")


def test_texts_go_to_python_in_small_batches(spark, documents, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, write = spark.conf.get(name), [], J.stored
    monkeypatch.setattr(J, "stored", lambda df, what: (seen.append((what, int(spark.conf.get(name)))), write(df, what))[1])
    J.jaccard_classes(documents)
    assert {rows for what, rows in seen if what in ("heads", "verified")} == {1_000} and spark.conf.get(name) == before
    # A batch of a job that the caller runs is cut in the task.
    batch = pa.record_batch([pa.array(range(2_500))], names=["i"])
    assert [b.num_rows for b in parts([batch, batch.slice(0, 0)])] == [1_000, 1_000, 500]


def test_texts_are_mixed_in_small_batches(documents, monkeypatch):
    tasks = []
    monkeypatch.setattr(M, "lean", lambda fn: tasks.append(fn) or fn, raising=False)
    M.mixed_texts(documents)
    n = 2_500
    columns = {"whole": [{"i": i} for i in range(n)], "body": [f"a {i}" for i in range(n)], "key": [0] * n, "copies": [2] * n, "bound": [-1] * n}
    found = list(tasks[0]([pa.RecordBatch.from_pydict(columns)]))
    assert [b.num_rows for b in found] == [2_000, 2_000, 1_000]
    assert [(r["whole"]["i"], r["body"]) for b in found for r in b.to_pylist()] == [(i, f"a {i}") for i in range(n) for _ in range(2)]


def test_texts_are_encoded_in_small_batches(spark, tmp_path, monkeypatch):
    class Rows:
        """Gives each text the number of rows of its batch as its id."""

        def each(self, texts):
            return iter([np.array([len(texts)], "<u4").tobytes()] * len(texts))

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(B, "process_encoder", lambda path: Rows())
    path = f"{tmp_path}/tokens"
    B.write_token_files(spark.range(12_000).selectExpr("id doc_id", "'a' text"), path)
    found = B.read_token_files(spark, path, with_ids=True).select("ids").collect()
    assert len(found) == 12_000 and max(r["ids"][0] for r in found) == 1_000 and spark.conf.get(name) == before


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_of_the_driver_start_no_python_processes(spark, documents, monkeypatch):
    kind = type(spark)
    made, make = [], kind.createDataFrame
    monkeypatch.setattr(kind, "createDataFrame", lambda *a, **b: (made.append(make(*a, **b)), made[-1])[1])
    M.mix_sources(documents)
    B.token_output(documents)
    assert len(made) == 3 and not any("RDD" in plan_of(frame) for frame in made)
    nothing = C.driver_table(spark, [], "a string, b long")
    assert nothing.count() == 0 and nothing.dtypes == [("a", "string"), ("b", "bigint")]
    rows = [(None, 1, 0.5), (None, None, 1.0)]
    assert [tuple(r) for r in C.driver_table(spark, rows, "a string, b long, c double").collect()] == rows


def test_a_task_has_one_python_process(documents, labels):
    known = labels.selectExpr("doc_id sample_id", "toxic sample_label").limit(10)
    plan = plan_of(X.count_grams(documents, known, "doc_id", "text"))
    assert "Exchange" in plan[plan.index("MapInArrow") : plan.index("ArrowEvalPython")]


def test_toxicity_of_odd_rows(odd, empty, labels):
    model = X.fit_toxicity(odd, labels)
    assert all(0 <= r["score"] <= 1 for r in X.score_toxicity(odd, model).collect())
    assert X.without_toxic(odd, model).columns == odd.columns
    nothing = X.fit_toxicity(empty, labels.limit(0))
    assert X.score_toxicity(odd, nothing).count() == odd.count() and X.score_toxicity(empty, nothing).count() == 0


# 9. Personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def right(kind, found):
    number = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
        return 16 <= len(number) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(number) <= 15


def base_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, p in BASE.items() for m in re.finditer(p, text or "") if right(kind, m.group())]


def test_spans_match_brute_force(spark, documents, odd):
    hard = [
        "a@b.c.d%e@f.g @x.y a@b a@b. a@@b.c é𝒳 q@é.de z@w.x-", "1.2.3.4.5 1.2.3.45.6.7.8 256.1.1.1 000255.0.0.1 1.2.3", "4111 1111-1111 1111 4111111111111111 4111111111111112 41111111111111111111",
        "+1 (555) 123-4567. +123 +1-2-3-4-5-6-7-8 ++49 30 1234567) +1234567890123456", "5" * 20_000 + " " + "a" * 20_000 + "@", 'token = "0123456789abcdef0123456789abcdef01234567" x',
    ]
    frame = documents.select("doc_id", "text").unionByName(spark.createDataFrame([(90_000 + i, t) for i, t in enumerate(hard)], "doc_id long, text string"))
    frame = frame.unionByName(odd.select("doc_id", "text"))
    want = sorted((name or 0, hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest()) for name, text in texts(frame))
    rows = P.personal_data(frame).collect()
    assert sorted((r["doc_id"] or 0, r["base_sha256"]) for r in rows) == want
    spans = {r["doc_id"]: r["spans"].split(",") for r in rows}
    assert all(set(base_spans(text)) <= set(spans[name]) for name, text in texts(frame) if name not in (None, 1, 2))
    assert any(span.startswith("secret:") for span in spans[90_005])
    assert P.personal_data(odd.limit(0)).count() == 0


def test_spans_of_a_text_with_many_finds(spark):
    pieces = ["+1 (555) 123-4567", "555-123-4567", "me [at] host [dot] org", "a.b@c.de", "4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "999.1.1.1", "12", "tel"]
    rng = np.random.default_rng(9)
    text = " ".join(pieces[i] for i in rng.integers(0, len(pieces), 100_000))
    row = P.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    want = base_spans(text)
    assert row["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert set(want) <= set(row["spans"].split(","))


# 10. Token blocks


@pytest.mark.parametrize("count", [0, 1, 127, 128, 129, 5_000])
@pytest.mark.parametrize("most", [1, 2, 50_000, 2**32 - 1])
def test_blocks_round_trip(count, most):
    rng = np.random.default_rng(count)
    ids = rng.integers(0, most, count, dtype=np.uint32)
    if count > 20:
        ids[rng.integers(0, count, count // 20)] = 2**32 - 1
    assert (B.decode_blocks(*B.encode_blocks(ids)) == ids).all()


def test_token_files(spark, documents, odd, empty, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(B.tokenizer_path("word_bpe_49k.json"))
    frame = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text").where("doc_id > 2 and doc_id < 9").selectExpr("doc_id + 70000 as doc_id", "text"))
    start, want = 0, []
    for name, text in sorted(texts(frame)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    B.write_token_files(frame, str(tmp_path / "small"), file_ids=3_000)
    assert sorted(tuple(r) for r in B.token_output(frame).collect()) == want
    small = B.read_token_files(spark, str(tmp_path / "small"), with_ids=True).orderBy("part", "number", "place").collect()
    assert [r["id"] for r in small] == [w[0] for w in want] and [r["ids_crc32"] for r in small] == [w[3] for w in want]
    assert B.token_output(empty).count() == 0 and B.token_output(odd).count() == odd.count()


def test_words_are_cut_many_texts_at_a_time():
    texts = ["onesed, (onesed) aïe! don't", "", " a.b \x0b\x1c x,é. ÷. ", "\n", "é.\u0301 <|endoftext|>,"]
    for marks in (True, False):
        words, bounds = B.cut_words([text.encode() for text in texts], marks)
        found = [[w.decode() for w in words.to_pylist()[a:b]] for a, b in zip(bounds, bounds[1:])]
        want = [["onesed", ",", "(onesed)", "aïe", "!", "don't"], [], ["a.b", "\x1c", "x,é.", "÷."], [], ["é.\u0301", "<|endoftext|>,"]]
        assert found == want if marks else ["".join(f) for f in found] == ["".join(w) for w in want] and len(words) == 10
    assert [len(x) for x in B.cut_words([])] == [0, 1] and B.cut_words([b"", b" "])[1].tolist() == [0, 0, 0]


def test_letters_are_composed_before_they_are_lowered():
    encoder = B.Encoder(B.tokenizer_path("word_bpe_49k.json"))
    texts = ["J\u030c x", "\u0130\u0327", "T\u0308,", "A\u0301", "\u212a", "\u0391\u0345", "\u00c9T\u00c9"]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.each(texts)]
    assert found == [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_a_mark_behind_a_word_is_looked_up_once():
    encoder = B.Encoder(B.tokenizer_path("word_bpe_49k.json"))
    looked = []
    encoder.learn = lambda words, learn=encoder.learn: (looked.extend(words), learn(words))
    list(encoder.each(["onesed, onesed. onesed!"]))
    assert sorted(looked) == [b"!", b",", b".", b"onesed"]


def test_encoder_keeps_words_without_marks():
    encoder = B.Encoder(B.tokenizer_path("word_bpe_49k.json"))
    texts = ["Onesed, onesed. (onesed) onesed!? aïe;", None, "", " \n", " onesed\x0b\x1cx\x85y\r\n", "don't, we'll; été été ΟΔΟΣ İs 12,3", "<|endoftext|> <a|b>."]
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.each(texts)]
        assert found == [encoder.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    # One entry for a plain word, whatever follows it; its ids come without the steps that leave it as it is.
    assert b"onesed" in encoder.known and b"onesed," not in encoder.known and encoder.plain is not encoder.tokenizer
    encoder.limit = 0
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.each(texts)] == found
