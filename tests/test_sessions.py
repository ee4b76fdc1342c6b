import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillstream.operators import ordered
from tillstream.operators import sessions as S

SCHEMA = "event_id string, visitor_id string, event_type string, item_id string, event_ts timestamp_ntz"


def events_of(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def at(text):
    return datetime.fromisoformat(f"2024-01-01T{text}")


def brute_labels(rows, rule):
    """Session number per event by walking each visitor's events in order."""
    by_visitor = defaultdict(list)
    for row in rows:
        by_visitor[row[1]].append(row)
    labels = {}
    for visitor, own in by_visitor.items():
        def place(row):
            missing = row[4] is None
            return (not missing if rule.nulls_first else missing, row[4] or datetime.min, row[0])

        number, previous = 0, None
        for row in sorted(own, key=place):
            if previous is None:
                opens = True
            elif row[4] is None:
                opens = False
            else:
                epoch = datetime(1970, 1, 1)
                ticks = [int((t - epoch).total_seconds() // rule.tick_seconds) for t in (previous, row[4])]
                opens = ticks[1] - ticks[0] > rule.gap
            number += opens
            labels[row[0]] = (previous, int(opens), number)
            previous = row[4]
    return labels


def brute_summary(rows, rule):
    labels = brute_labels(rows, rule)
    groups = defaultdict(list)
    for row in rows:
        key = None if row[1] is None else f"{row[1]}-{labels[row[0]][2]}"
        groups[(key, row[1])].append(row)
    result = []
    for (key, visitor), own in groups.items():
        times = [row[4] for row in own if row[4] is not None]
        items = [row[3] for row in own if row[3] is not None]
        kinds = [sum(row[2] == kind for row in own) for kind in ("view", "addtocart", "transaction")]
        result.append((key, visitor, min(times, default=None), max(times, default=None), len(own), *kinds, min(items, default=None)))
    return sorted(result, key=repr)


def random_events(seed, count=400, missing_time=0.0, missing_visitor=0.0):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    made = []
    for number in range(count):
        # One visitor holds a third of all events, at few distinct times.
        visitor = "hot" if rng.random() < 0.34 else f"v{rng.randint(1, 12)}"
        ts = start + timedelta(seconds=rng.choice([rng.uniform(0, 200_000), 60 * rng.randint(0, 3000), 1800 * rng.randint(0, 40)]))
        made.append(
            (
                f"e{number}",
                None if rng.random() < missing_visitor else visitor,
                rng.choice(["view", "addtocart", "transaction", "other"]),
                rng.choice([None, "10", "9", "a"]),
                None if rng.random() < missing_time else ts,
            )
        )
    return made


@pytest.mark.parametrize(
    "first,second,seconds,minutes",
    [
        ("10:00:30", "10:30:59", 2, 1),
        ("10:00:59", "10:31:00", 2, 2),
        ("10:00:00", "10:30:00", 1, 1),
        ("10:00:00", "10:30:00.500000", 1, 1),
        ("10:00:00", "10:30:01", 2, 1),
        ("10:00:00", "10:30:59.999999", 2, 1),
    ],
)
def test_the_two_rules_at_their_limits(spark, first, second, seconds, minutes):
    events = events_of(spark, ("1", "v", "view", None, at(first)), ("2", "v", "view", None, at(second)))
    assert S.summarize(events, S.SessionRule.elapsed(30)).count() == seconds
    assert S.summarize(events, S.SessionRule.minute_marks(30)).count() == minutes


@pytest.mark.parametrize("gap", [0, 1, 30])
@pytest.mark.parametrize("make", [S.SessionRule.elapsed, S.SessionRule.minute_marks])
def test_summaries_equal_brute_force(spark, rows, make, gap):
    made = random_events(gap + 1)
    assert rows(S.summarize(events_of(spark, *made), make(gap))) == brute_summary(made, make(gap))


@pytest.mark.parametrize("make", [S.SessionRule.elapsed, S.SessionRule.minute_marks])
def test_missing_times_and_visitors(spark, rows, monkeypatch, make):
    monkeypatch.setattr(S, "SALT_ROWS", 3)
    made = random_events(5, missing_time=0.2, missing_visitor=0.1)
    made += [("n1", "only-untimed", "view", None, None), ("n2", "only-untimed", "view", "x", None)]
    assert rows(S.summarize(events_of(spark, *made), make(30))) == brute_summary(made, make(30))


@pytest.mark.parametrize("make", [S.SessionRule.elapsed, S.SessionRule.minute_marks])
def test_event_labels_equal_brute_force_over_many_ranges(spark, make):
    made = random_events(9, missing_time=0.1)
    got = S.label_events(events_of(spark, *made), make(30), ranges=23).collect()
    expected = brute_labels(made, make(30))
    assert {r.event_id: (r.previous_event_ts, r.is_new_session, r.session_number) for r in got} == expected
    assert all(r.session_key == f"{r.visitor_id}-{r.session_number}" for r in got)


def test_many_copies_of_one_event_are_spread(spark):
    copies = spark.range(3000).select(
        F.lit("e").alias("event_id"),
        F.lit("hot").alias("visitor_id"),
        F.lit("view").alias("event_type"),
        F.lit(None).cast("string").alias("item_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_ts"),
    )
    ranged = ordered.into_ranges(copies, "visitor_id", ["event_ts"], 6).df
    sizes = [row["count"] for row in ranged.groupBy(ordered.BUCKET).count().collect()]
    assert max(sizes) < 1500
    labels = S.label_events(copies, S.SessionRule.elapsed(30), ranges=6)
    assert labels.agg(F.sum("is_new_session"), F.max("session_number"), F.count("previous_event_ts")).first()[:] == (1, 1, 2999)


def test_ties_order_by_text_id(spark):
    events = events_of(spark, ("9", "v", "view", None, at("10:00:00")), ("10", "v", "view", None, at("10:00:00")))
    labels = {r.event_id: r.is_new_session for r in S.label_events(events, S.SessionRule.minute_marks(30)).collect()}
    assert labels == {"10": 1, "9": 0}


def test_sample_item_is_the_smallest_text(spark):
    events = events_of(
        spark,
        ("1", "v", "view", "9", at("10:00:00")),
        ("2", "v", "addtocart", "10", at("10:01:00")),
        ("3", "v", "transaction", None, at("10:02:00")),
    )
    row = S.summarize(events, S.SessionRule.elapsed(30)).first()
    assert row.sample_item_id == "10"
    assert (row.event_count, row.view_count, row.addtocart_count, row.transaction_count) == (3, 1, 1, 1)


def test_events_without_ids_are_dropped_by_the_job_only(spark):
    events = events_of(spark, (None, "v", "view", None, at("10:00:00")), ("2", None, "view", None, at("10:00:00")))
    assert S.identified(events).count() == 0
    assert S.summarize(events, S.SessionRule.minute_marks(30)).count() == 2


def test_empty_input(spark):
    assert S.summarize(events_of(spark), S.SessionRule.elapsed(30)).count() == 0
