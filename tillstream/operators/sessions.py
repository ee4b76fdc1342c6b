"""Cut the events of a visitor into sessions at gaps of inactivity.

Two rules exist and give different sessions:

* ``SessionRule.elapsed(minutes)``: more than ``minutes * 60`` whole seconds between events.
* ``SessionRule.minute_marks(minutes)``: more than ``minutes`` minute boundaries between events.

Both compare whole ticks (seconds or minutes). Ticks in one cell of ``gap + 1`` ticks are never
more than the gap apart, so all events of a visitor in a cell share a session. ``summarize``
therefore first reduces the events to one row per (visitor, cell), combined before the shuffle,
and orders only those rows: their number per visitor is bounded by the time covered, not by the
number of events, so a visitor with a third of all events is no hot spot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.expressions import count_of
from tillstream.operators.ordered import into_ranges

# Rows of one salt group when events without time meet the totals of their visitor.
SALT_ROWS = 1_000_000

COUNTS = {"view_count": "view", "addtocart_count": "addtocart", "transaction_count": "transaction"}
SUMMARY_COLUMNS = [
    "session_key",
    "visitor_id",
    "session_start_ts",
    "session_end_ts",
    "event_count",
    *COUNTS,
    "sample_item_id",
]


@dataclass(frozen=True)
class SessionRule:
    gap: int
    tick_seconds: int
    nulls_first: bool

    @classmethod
    def elapsed(cls, minutes: int = 30, nulls_first: bool = True) -> SessionRule:
        return cls(minutes * 60, 1, nulls_first)

    @classmethod
    def minute_marks(cls, minutes: int = 30, nulls_first: bool = False) -> SessionRule:
        return cls(minutes, 60, nulls_first)

    def tick(self, ts: Column) -> Column:
        seconds = F.unix_timestamp(ts)
        if self.tick_seconds == 1:
            return seconds
        return (seconds - F.pmod(seconds, F.lit(self.tick_seconds))) / self.tick_seconds

    def splits(self, tick: Column, previous: Column) -> Column:
        return previous.isNull() | (tick - previous > self.gap)


def identified(events: DataFrame) -> DataFrame:
    """Drop events lacking an id or a visitor."""
    return events.where(F.col("event_id").isNotNull() & F.col("visitor_id").isNotNull())


def session_key() -> Column:
    return F.concat("visitor_id", F.lit("-"), F.col("session_number").cast("string"))


def summarize(events: DataFrame, rule: SessionRule, times_present: bool = False) -> DataFrame:
    """One row per session.

    Events without a time are numbered by event id: each is a session of its own, except that
    with nulls last the first one continues the visitor's last session. ``times_present`` says
    that no such event exists and saves the look for one.
    """
    needed = events.select("event_id", "visitor_id", "event_type", "item_id", "event_ts")
    timed = needed.where(F.col("event_ts").isNotNull())
    untimed = needed.where(F.col("event_ts").isNull())
    cells = _cells(timed, rule)
    if times_present or untimed.isEmpty():
        return _collect(_number(cells, rule))
    return _with_untimed(cells, untimed, rule)


def label_events(events: DataFrame, rule: SessionRule, ranges: int | None = None) -> DataFrame:
    """Every event with previous event time, new-session flag, session number and key.

    The flags and numbers of single events need the events in order, see ``into_ranges``. Use
    ``summarize`` when only sessions are wanted; it moves far less data.
    """
    late = F.col("event_ts").isNotNull() if rule.nulls_first else F.col("event_ts").isNull()
    tick, previous = rule.tick(F.col("event_ts")), rule.tick(F.col("previous_event_ts"))
    opens = F.when(rule.splits(tick, previous), 1).otherwise(0)
    labelled = (
        into_ranges(events.withColumn("_late", late), "visitor_id", ["_late", "event_ts", "event_id"], ranges)
        .with_previous("event_ts", "previous_event_ts")
        .with_running_sum(opens, "session_number")
    )
    return (
        labelled.rows()
        .drop("_late")
        .withColumn("is_new_session", opens)
        .withColumn("session_key", session_key())
    )


def _measures() -> list[Column]:
    return [
        F.min("event_ts").alias("session_start_ts"),
        F.max("event_ts").alias("session_end_ts"),
        F.count(F.lit(1)).alias("event_count"),
        *(count_of(F.col("event_type") == kind).alias(name) for name, kind in COUNTS.items()),
        F.min("item_id").alias("sample_item_id"),
    ]


def _cells(timed: DataFrame, rule: SessionRule) -> DataFrame:
    ticks = timed.withColumn("tick", rule.tick(F.col("event_ts")).cast("long"))
    return (
        ticks.withColumn("cell", F.col("tick") - F.pmod("tick", F.lit(rule.gap + 1)))
        .groupBy("visitor_id", "cell")
        .agg(F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"), *_measures())
    )


def session_parts(events: DataFrame, rule: SessionRule) -> DataFrame:
    """Rows that each cover events of one session, from events with a time; ``merge_parts`` joins them."""
    return _cells(events, rule).drop("cell")


def merge_parts(parts: DataFrame, rule: SessionRule) -> DataFrame:
    """Sessions from rows that each cover events of one session; the rows may overlap in time.

    Sessions have the form of parts, so they can be merged again with parts of later events: one
    that lies between two sessions joins them. Only such rows are ordered per visitor, never events.
    """
    in_order = Window.partitionBy("visitor_id").orderBy("first_tick", "last_tick")
    reached = F.max("last_tick").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(rule.splits(F.col("first_tick"), reached), 1).otherwise(0)
    placed = parts.withColumn("_opens", opens).withColumn(
        "_place", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        placed.groupBy("visitor_id", "_place")
        .agg(
            F.min("first_tick").alias("first_tick"),
            F.max("last_tick").alias("last_tick"),
            F.min("session_start_ts").alias("session_start_ts"),
            F.max("session_end_ts").alias("session_end_ts"),
            F.sum("event_count").alias("event_count"),
            *(F.sum(name).alias(name) for name in COUNTS),
            F.min("sample_item_id").alias("sample_item_id"),
        )
        .drop("_place")
    )


def _number(cells: DataFrame, rule: SessionRule) -> DataFrame:
    in_order = Window.partitionBy("visitor_id").orderBy("cell")
    opens = rule.splits(F.col("first_tick"), F.lag("last_tick").over(in_order))
    return cells.withColumn("opens", F.when(opens, 1).otherwise(0)).withColumn(
        "session_number", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )


def _collect(numbered: DataFrame) -> DataFrame:
    return (
        numbered.withColumn("session_key", session_key())
        .groupBy("session_key", "visitor_id")
        .agg(
            F.min("session_start_ts").alias("session_start_ts"),
            F.max("session_end_ts").alias("session_end_ts"),
            F.sum("event_count").alias("event_count"),
            *(F.sum(name).alias(name) for name in COUNTS),
            F.min("sample_item_id").alias("sample_item_id"),
        )
        .select(SUMMARY_COLUMNS)
    )


def _with_untimed(cells: DataFrame, untimed: DataFrame, rule: SessionRule) -> DataFrame:
    # The untimed events of a visitor enter the ordering as one row carrying their number.
    totals = untimed.groupBy("visitor_id").agg(F.count(F.lit(1)).alias("untimed_count"))
    merged = cells.unionByName(totals, allowMissingColumns=True)
    is_total = F.col("cell").isNull()
    rank = (~is_total) if rule.nulls_first else is_total
    in_order = Window.partitionBy("visitor_id").orderBy(rank, "cell")
    last_tick = F.lag("last_tick").over(in_order)
    continues = F.lit(False) if rule.nulls_first else last_tick.isNotNull()
    opens = F.when(is_total, F.col("untimed_count") - F.when(continues, 1).otherwise(0)).otherwise(
        F.when(rule.splits(F.col("first_tick"), last_tick), 1).otherwise(0)
    )
    numbered = merged.withColumn("opens", opens).withColumn(
        "session_number", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    ranked = into_ranges(untimed, "visitor_id", ["event_id"]).with_running_sum(F.lit(1), "place").rows()
    if rule.nulls_first:
        placed = ranked.withColumn("session_number", F.col("place"))
    else:
        # Sessions before the untimed events, spread over salts so that no visitor is hot.
        before = (
            numbered.where(is_total)
            .withColumn("sessions_before", F.col("session_number") - F.col("opens"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), _salt(F.col("untimed_count")))))
            .select(F.col("visitor_id").alias("_visitor"), F.col("salt").alias("_salt"), "sessions_before")
        )
        placed = ranked.withColumn("salt", _salt(F.col("place"))).join(
            before,
            F.col("visitor_id").eqNullSafe(F.col("_visitor")) & (F.col("salt") == F.col("_salt")),
            "inner",
        ).withColumn(
            "session_number",
            F.col("sessions_before") + F.col("place") - F.when(F.col("sessions_before") > 0, 1).otherwise(0),
        )
    columns = [c for c in SUMMARY_COLUMNS if c != "session_key"]
    single = placed.select(
        "session_number",
        "visitor_id",
        F.col("event_ts").alias("session_start_ts"),
        F.col("event_ts").alias("session_end_ts"),
        F.lit(1).cast("long").alias("event_count"),
        *(F.when(F.col("event_type") == kind, 1).otherwise(0).cast("long").alias(name) for name, kind in COUNTS.items()),
        F.col("item_id").alias("sample_item_id"),
    )
    timed = numbered.where(~is_total).select("session_number", *columns)
    return _collect(timed.unionByName(single))


def _salt(place: Column) -> Column:
    offset = place - 1
    return ((offset - F.pmod(offset, F.lit(SALT_ROWS))) / SALT_ROWS).cast("long")
