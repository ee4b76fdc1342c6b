"""Conversations brought into the form ``(system? (user assistant)+)?`` at the least cost.

Each turn is kept, given another role or deleted, and turns without text may be put in anywhere.
The cheapest repair is found by weighted parsing of intervals, bottom up (CYK), with a grammar in
Chomsky normal form: the symbol [p, q] derives the stretches of turns that lead an acceptor of the
form from state p to state q, by the productions [p, q] -> [p, r] [r, q], and by one edit of one
turn. A cell holds, for each symbol, the least (cost, audit). Insertions enter as a closure: any
chain of them may stand behind each turn, and one before the first. As every [p, q] derives
[p, r] [r, q] for every cut of its interval, one cut of each interval is enough: intervals of 2^i
turns are made of two halves, so a conversation of n turns needs n - 1 products of cells, not n^3,
and a long conversation may be parsed in pieces by several tasks.

Audits of one cell that differ in length are not ordered by their first difference alone (``x`` may
be the beginning of ``y``); a cell keeps both then, so that the least audit of the whole is exact.

A turn is faulty if it is blank (no word), else if it repeats role and text of an earlier turn of
the conversation, else if its last character but white space is none of ``.!?``. Blank and
repeated turns must go.

Turns are ordered by number, nulls first, then role and SHA-256 of the text. Null roles and texts
count as one space. Turns of a null conv_id are one conversation. Repeated rows are repeated turns,
of which the first is the original. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import stored

#: States of the acceptor: nothing yet, behind a system turn, behind a user's, behind an assistant's.
STATES = (0, 1, 2, 3)
ACCEPTED = (0, 3)
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: Faults, as a turn's second mark; the first is its role's initial if the form knows it, else "x".
BLANK, DUPLICATE, TRUNCATED, SOUND = "bdt."

#: (start state, end state) -> (cost, audits): the least cost and the audits that may still win.
Cell = dict[tuple[int, int], tuple[int, tuple[str, ...]]]


def _least(audits: Iterable[str]) -> tuple[str, ...]:
    """The audits that may become the least one: the least, and those that go on from it."""
    kept: list[str] = []
    for audit in sorted(set(audits)):
        if not kept or audit.startswith(kept[-1]):
            kept.append(audit)
    return tuple(kept)


def _offer(cell: Cell, at: tuple[int, int], cost: int, audits: Iterable[str]) -> None:
    now = cell.get(at)
    if now is None or cost < now[0]:
        cell[at] = (cost, _least(audits))
    elif cost == now[0]:
        cell[at] = (cost, _least((*now[1], *audits)))


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent intervals."""
    cell: Cell = {}
    for (p, r), (cost, audits) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                _offer(cell, (p, q), cost + more, [a + b for a in audits for b in rest])
    return cell


def _insertions() -> Cell:
    """Chains of insertions between states."""
    cell: Cell = {(p, p): (0, ("",)) for p in STATES}
    for _ in STATES:
        for (p, q), (cost, audits) in list(cell.items()):
            for kind in "ua":
                if q in STEPS[kind]:
                    _offer(cell, (p, STEPS[kind][q]), cost + INSERT_COST, [audit + INSERT for audit in audits])
    return cell


INSERTIONS = _insertions()


@lru_cache(maxsize=64)
def turn_cell(initial: str, fault: str) -> Cell:
    """The cell of one turn with insertions behind it."""
    cell: Cell = {(p, p): (DELETE_COST, (DELETE,)) for p in STATES}
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for p, q in STEPS.get(initial, {}).items():
            _offer(cell, (p, q), extra, [KEEP])
        for kind in "ua":
            for p, q in STEPS[kind].items():
                _offer(cell, (p, q), REROLE_COST + extra, [REROLE])
    return joined(cell, INSERTIONS)


class Intervals:
    """Cells of a growing row of turns, by intervals of 2^i turns; joined at the end."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, turns: int = 1) -> None:
        while self.stack and self.stack[-1][0] <= turns:
            before, left = self.stack.pop()
            cell, turns = joined(left, cell), before + turns
        self.stack.append((turns, cell))

    def whole(self) -> Cell | None:
        cell = None
        for _, left in reversed(self.stack):
            cell = left if cell is None else joined(left, cell)
        return cell


def repair_of(cell: Cell | None) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of the turns whose cell this is; None is no turn."""
    if cell is None:
        return 0, ""
    cell = joined(INSERTIONS, cell)
    return min((cost, audit) for q in ACCEPTED if (0, q) in cell for cost, audit in [(cell[0, q][0], min(cell[0, q][1]))])


def edited(turns: Iterable[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The turns (role, text) after the edits of an audit."""
    state, source = 0, iter(turns)
    for letter in audit:
        wanted = "assistant" if state == 2 else "user"
        role, text = (wanted, "") if letter == INSERT else next(source)
        if letter == DELETE:
            continue
        role = role if letter == KEEP else wanted
        state = STEPS[role[:1]][state]
        yield role, text


def damage(turns: DataFrame) -> DataFrame:
    """The contract's test damage, by crc32 of ``conv_id:turn``; null roles and texts become a space."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("lot"),
    ).where("lot <> 0")
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("lot") == 4, "user").otherwise(F.col("role"))})
    times = F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("time", F.explode(times)).select("conv_id", "turn", "role", "text")


def _digest(column: str) -> Column:
    return F.unhex(F.sha2(F.col(column), 256))


ORDER = ["turn", "role", "digest"]
WHITE = " \t\n\x0b\x0c\r"


def _marked(turns: DataFrame) -> DataFrame:
    """One narrow row for the equal turns of a conversation: place in order, fault and number of copies."""
    text = F.rtrim("text", F.lit(WHITE))
    narrow = turns.select(
        "conv_id",
        "turn",
        "role",
        _digest("text").alias("digest"),
        F.when(text == "", BLANK).when(F.right(text, F.lit(1)).isin(*".!?"), SOUND).otherwise(TRUNCATED).alias("fault"),
    )
    once = narrow.groupBy("conv_id", *ORDER, "fault").agg(F.count(F.lit(1)).alias("copies"))
    # The first of equal texts is found by an aggregate that combines early: one text may fill a conversation.
    first = narrow.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("first_turn")
    )
    keys = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    later = F.when(F.col("untimed"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first_turn"))
    fault = F.when((F.col("fault") != BLANK) & later, DUPLICATE).otherwise(F.col("fault"))
    return once.join(first, keys, "left").select("conv_id", *ORDER, "copies", fault.alias("fault"))


@dataclass
class Piece:
    """What is known of consecutive turns of a conversation; pieces are added in order."""

    row: Intervals = field(default_factory=Intervals)
    counts: Counter = field(default_factory=Counter)
    first: str = ""
    last: str = ""
    low: int | None = None
    high: int | None = None

    def add_turn(self, turn: int | None, role: str, fault: str, copies: int) -> None:
        initial = role[:1] if role[:1] in STEPS else "x"
        repeat = DUPLICATE if fault != BLANK else BLANK
        self.counts[fault] += 1
        self.counts[repeat] += copies - 1
        self.counts["illegal"] += (copies - 1) + (bool(self.last) and self.last + initial not in LEGAL)
        if turn is not None:
            self.counts["distinct"] += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.first, self.last = self.first or initial, initial
        self.row.add(turn_cell(initial, fault))
        for _ in range(copies - 1):
            self.row.add(turn_cell(initial, repeat))

    def add(self, other: Piece, cell: Cell, turns: int) -> None:
        """Add a later piece, whose turns have the given cell."""
        self.counts.update(other.counts)
        self.counts["illegal"] += bool(self.last) and self.last + other.first not in LEGAL
        if other.low is not None:
            self.counts["distinct"] -= other.low == self.high
            self.low, self.high = other.low if self.low is None else self.low, other.high
        self.first, self.last = self.first or other.first, other.last
        self.row.add(cell, turns)

    def packed(self) -> str:
        turns = sum(n for n, _ in self.row.stack)
        cell = [[*at, cost, audits] for at, (cost, audits) in self.row.whole().items()]
        return json.dumps([self.counts, self.first, self.last, self.low, self.high, turns, cell])

    def add_packed(self, text: str) -> None:
        counts, first, last, low, high, turns, cell = json.loads(text)
        cells = {(p, q): (cost, tuple(audits)) for p, q, cost, audits in cell}
        self.add(Piece(Intervals(), Counter(counts), first, last, low, high), cells, turns)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.counts["distinct"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 2_000) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, at_once)):
        yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*part, strict=True), schema.types, strict=True)], schema=schema)


def _streamed(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: StructType) -> DataFrame:
    """Map the rows of each partition, in order and one at a time."""
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _batches(fn(_rows(batches)), arrow), schema)


def _pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, piece, body): each conversation cut where ranges of the ordered turns end."""
    marked = stored(_marked(turns), "turns")
    key = ["conv_id", *ORDER]

    def parse(rows: Iterator[tuple]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId()
        for conv, group in groupby(rows, itemgetter(0)):
            piece = Piece()
            for _, turn, role, _, copies, fault in group:
                piece.add_turn(turn, role, fault, copies)
            yield conv, number, piece.packed()

    schema = StructType([turns.schema["conv_id"], StructField("piece", LongType()), StructField("body", StringType())])
    return _streamed(marked.repartitionByRange(*key).sortWithinPartitions(*key), parse, schema)


def _assembled(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Names, pieces and texts of each conversation, one behind the other in one partition."""
    none = {"piece": F.lit(None).cast("long"), "body": F.lit(None).cast("string")}
    blank = {"turn": F.lit(None).cast("long"), "role": F.lit(""), "digest": F.lit(None).cast("binary")}
    names = conversations.select("conv_id").distinct().withColumns(none | blank | {"part": F.lit(0)})
    pieces = _pieces(turns).withColumns(blank | {"part": F.lit(1)})
    texts = turns.withColumns({"digest": _digest("text"), "piece": none["piece"], "part": F.lit(2)}).withColumnRenamed("text", "body")
    rows = names.unionByName(pieces).unionByName(texts)
    order = ["conv_id", "part", "piece", *ORDER]
    return rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "part", "role", "body")


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple[object, Piece, int, str, Iterator[tuple[str, str]]]]:
    """(conv_id, its piece, cost, audit, repaired turns) of each conversation of a partition."""
    for conv, group in groupby(rows, itemgetter(0)):
        whole, texts = Piece(), iter(())
        for _, part, role, body in group:
            if part == 1:
                whole.add_packed(body)
            elif part == 2:
                texts = chain([(role, body)], ((r, b) for _, _, r, b in group))
                break
        cost, audit = repair_of(whole.row.whole())
        yield conv, whole, cost, audit, edited(texts, audit)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the turns of all conversations after their cheapest repair."""
    turns = _plain(turns)
    kinds = [StructField("position", LongType()), StructField("role", StringType()), StructField("text", StringType())]

    def repair(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, _, _, _, repaired in _repaired(rows):
            for position, (role, text) in enumerate(repaired):
                yield conv, position, role, text

    return _streamed(_assembled(turns, turns), repair, StructType([turns.schema["conv_id"], *kinds]))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def conversation_repairs(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Per conversation its faults, the cost and audit of the cheapest repair, and a digest of the result.

    Conversations are those of ``conversations`` (default: of ``turns``); one without turns gives
    zeros, an empty audit and the digest of nothing. The digest is that of ``role:text`` of the
    repaired turns, joined by line feeds; it is taken while the turns pass by, so no conversation
    is held as a whole, but the turns of one conversation pass through one task.
    """
    turns = _plain(turns)
    conversations = turns if conversations is None else conversations

    def repair(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, piece, cost, audit, repaired in _repaired(rows):
            digest = hashlib.sha256()
            for position, (role, text) in enumerate(repaired):
                digest.update(("\n" if position else "").encode() + f"{role}:{text}".encode())
            faults = (piece.counts[fault] for fault in (BLANK, DUPLICATE, TRUNCATED, "illegal"))
            yield conv, piece.gaps, *faults, cost, audit, digest.hexdigest()

    texts = [StructField("audit", StringType()), StructField("repaired_sha256", StringType())]
    schema = StructType([turns.schema["conv_id"], *(StructField(name, LongType()) for name in COUNTS), *texts])
    return _streamed(_assembled(turns, conversations), repair, schema)


def _plain(turns: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
