"""Repair of conversations against a plain search, and the whole table against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillstream.llm import conversation_repair as C

from .conftest import FOLDER

WHITE = b" \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults_of(turns):
    """Fault of each turn (role, text) in order."""
    seen, out = set(), []
    for turn in turns:
        text = turn[1].encode().rstrip(WHITE).decode()
        fault = "b" if not text else "d" if turn in seen else "t" if text[-1] not in ".!?" else "."
        out.append(fault)
        seen.add(turn)
    return out


def plain_repair(turns, faults):
    """Least (cost, audit), turn by turn; of audits of one length and one last role the least (cost, audit) is enough."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}

    def offer(states, last, cost, audit):
        at = (last, len(audit))
        states[at] = min(states.get(at, (10**9, "")), (cost, audit))

    def grown(states):
        for _ in range(3):
            for (last, _), (cost, audit) in list(states.items()):
                for kind in set("ua") & set(legal[last]):
                    offer(states, kind, cost + 5, audit + "I")
        return states

    states = grown({("", 0): (0, "")})
    for (role, _), fault in zip(turns, faults, strict=True):
        after = {}
        for (last, _), (cost, audit) in states.items():
            offer(after, last, cost + 2, audit + "D")
            if fault in "bd":
                continue
            cost += 5 if fault == "t" else 0
            if role[:1] and role[:1] in legal[last]:
                offer(after, role[:1], cost, audit + "K")
            for kind in set("ua") & set(legal[last]):
                offer(after, kind, cost + 1, audit + "R")
        states = grown(after)
    return min(best for (last, _), best in states.items() if last in ("", "a"))


def plain_result(turns, audit):
    out, source = [], iter(turns)
    for letter in audit:
        wanted = "assistant" if out and out[-1][0][:1] == "u" else "user"
        turn = (wanted, "") if letter == "I" else next(source)
        if letter != "D":
            out.append((wanted, turn[1]) if letter == "R" else turn)
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def plain_row(conv, rows):
    """Result for the damaged rows (turn, role, text) of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    turns = [(role, text) for _, role, text in rows]
    faults = faults_of(turns)
    cost, audit = plain_repair(turns, faults)
    numbers = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    return conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, plain_result(turns, audit)


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 1:
            text = ""
        elif lot == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        elif lot == 4:
            role = "user"
        for _ in range((lot != 0) + (lot == 3)):
            yield conv, turn, role, text


def plain_table(rows):
    groups = defaultdict(list, {row[0]: [] for row in rows})
    for conv, *rest in plain_damage(rows):
        groups[conv].append(tuple(rest))
    return [plain_row(conv, part) for conv, part in groups.items()]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_cells_give_the_cheapest_repair():
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "tool", ""], ["Yes.", "No", "", "a!", "b?", " "]
    for _ in range(400):
        kinds = roles[: rng.choice([2, 3, 5])]
        turns = [(rng.choice(kinds), rng.choice(texts) + str(rng.randint(0, 2)) + rng.choice(["", "."])) for _ in range(rng.randint(0, 7))]
        turns = [(r, t if rng.random() < 0.8 else " ") for r, t in turns]
        faults = faults_of(turns)
        row = C.Intervals()
        for (role, _), fault in zip(turns, faults, strict=True):
            row.add(C.turn_cell(role[:1] if role[:1] in C.STEPS else "x", fault))
        assert C.repair_of(row.whole()) == plain_repair(turns, faults)


def test_audits_that_go_on_are_kept():
    assert C._least(["DK", "DKI", "KD", "DKIK"]) == ("DK", "DKI", "DKIK")
    rng = random.Random(6)
    for _ in range(200):
        # Insertion and role changes tie here, and the audits differ in length.
        turns = [(rng.choice(["user", "assistant"]), f"{i}.") for i in range(rng.randint(6, 11))]
        faults = ["."] * len(turns)
        row = C.Intervals()
        for role, _ in turns:
            row.add(C.turn_cell(role[:1], "."))
        assert C.repair_of(row.whole()) == plain_repair(turns, faults)


def test_whole_table_equals_plain_python(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    got = C.conversation_repairs(C.damage(table), table)
    assert ordered(got.collect()) == ordered(plain_table([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]))


ODD = [
    (None, 0, "user", "Hi."),
    (None, None, "assistant", "Null turn first."),
    (1, None, None, None),
    (1, 2, "user", "One."),
    (1, 2, "user", "One."),
    (1, 2, "user", "One."),
    (1, 2, "assistant", "Same turn."),
    (1, 7, "tool", "x" * 50_000),
    (2, 1, "", ""),
    (3, 1, "system", "Only a system turn."),
    (4, -5, "user", "é Σ 𝒳 ?"),
    (4, 9, "assistant", "Ends in a space. \n"),
    (4, 9, "user", "Is cut"),
    (5, 3, "user", "Repeated."),
    (5, 1, "user", "Repeated."),
    (5, None, "user", "Repeated."),
]


@pytest.fixture(scope="module")
def odd_turns(spark):
    extra = {n: F.lit(1) for n in ("piece", "part", "body", "digest", "copies", "fault", "c", "r", "d", "lot", "time", "audit")}
    return spark.createDataFrame(ODD, SCHEMA).repartition(5).withColumns(extra)


def test_odd_rows(odd_turns):
    got = C.conversation_repairs(C.damage(odd_turns), odd_turns)
    assert ordered(got.collect()) == ordered(plain_table(ODD))
    whole = C.conversation_repairs(odd_turns)
    groups = defaultdict(list)
    for conv, turn, role, text in ODD:
        groups[conv].append((turn, role or " " if role is None else role, " " if text is None else text))
    assert ordered(whole.collect()) == ordered(plain_row(conv, part) for conv, part in groups.items())


def test_empty_table(odd_turns):
    assert C.conversation_repairs(odd_turns.limit(0)).collect() == []
    assert C.repaired_turns(odd_turns.limit(0)).collect() == []


def test_pieces_of_a_long_conversation_join(spark):
    rng = random.Random(7)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", f"{i}.", f"{i}!"])) for i in range(900)]
    frame = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert C._pieces(C._plain(frame)).count() > 1
        (got,) = C.conversation_repairs(frame).collect()
        repaired = sorted(C.repaired_turns(frame).collect(), key=lambda r: r["position"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    turns = sorted(rows, key=lambda r: (r[1], r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    faults = faults_of([r[2:] for r in turns])
    row = C.Intervals()
    for (*_, role, _), fault in zip(turns, faults, strict=True):
        row.add(C.turn_cell(role[0], fault))
    cost, audit = C.repair_of(row.whole())
    assert (got["cost"], got["audit"]) == (cost, audit)
    assert got["repaired_sha256"] == plain_result([r[2:] for r in turns], audit)
    assert (got["gaps"], got["duplicate"]) == (0, faults.count("d"))
    assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in repaired).encode()).hexdigest() == got["repaired_sha256"]
