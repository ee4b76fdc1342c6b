from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream.functions import expressions as X
from tillstream.settings import TopicPlan


def one(spark, expression, **values):
    frame = spark.range(1).select(*(value.alias(name) for name, value in values.items()))
    return frame.select(expression.alias("x")).first()[0]


@pytest.mark.parametrize(
    "event_type,topic",
    [
        ("VIEW", "retailrocket.events.view"),
        ("addtocart", "retailrocket.events.addtocart"),
        ("transaction", "retailrocket.events.transaction"),
        ("unknown", "retailrocket.events.dlq"),
        (None, "retailrocket.events.dlq"),
    ],
)
def test_topic_of_event_type(spark, event_type, topic):
    assert one(spark, X.topic_of(F.lit(event_type).cast("string"), TopicPlan())) == topic


@pytest.mark.parametrize(
    "usd,brl,rate",
    [("1.10", "4.40", Decimal("0.25")), (None, "4.4", None), ("1.1", None, None), ("1.1", "0", None)],
)
def test_cross_rate_needs_both_legs_and_no_zero(spark, usd, brl, rate):
    as_rate = [F.lit(value).cast("decimal(18,8)") for value in (usd, brl)]
    assert one(spark, X.cross_rate(*as_rate)) == rate


@pytest.mark.parametrize(
    "paid,gross,freight,value",
    [("5", "1", "2", "5"), (None, "1", "2", "3"), (None, "1", None, "0"), (None, None, None, "0"), ("0", "1", "2", "0")],
)
def test_order_value_falls_back_stepwise(spark, paid, gross, freight, value):
    money = [F.lit(amount).cast("decimal(12,2)") for amount in (paid, gross, freight)]
    assert one(spark, X.order_value(*money)) == Decimal(value)


def test_dates_parse_leniently(spark):
    frame = spark.createDataFrame([("2018-01-01",), ("2018-12-31",), ("soon",), (None,)], "d string")
    assert [row[0] for row in frame.select(X.lenient_date(F.col("d"))).collect()] == [
        date(2018, 1, 1),
        date(2018, 12, 31),
        None,
        None,
    ]


def test_periods_start_on_monday_and_on_the_first(spark):
    day = F.lit(date(2024, 2, 4))
    assert one(spark, X.period_start("day", day)) == date(2024, 2, 4)
    assert one(spark, X.period_start("week", day)) == date(2024, 1, 29)
    assert one(spark, X.period_start("month", day)) == date(2024, 2, 1)


def test_ids_and_texts(spark):
    assert one(spark, X.padded_id("cust", 4, F.lit(7))) == "cust-0007"
    assert one(spark, X.batch_id("olist", F.lit("2024-01-02 03:04:05").cast("timestamp"))) == "olist-20240102T030405"
    assert one(spark, X.strip(F.lit(" \t a b \n　"))) == "a b"
    assert one(spark, X.text_or(F.lit(""), "unknown")) == "unknown"
    assert one(spark, X.is_blank(F.lit("  "))) is True
    assert one(spark, X.share_pct(F.lit(None).cast("boolean"))) == 0.0
