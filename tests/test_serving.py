from datetime import date, datetime
from decimal import Decimal

import pytest

from tillstream.plans import insights as I
from tillstream.plans import serving as V

ORDER = (
    "order_id string, customer_id string, order_date date, order_status string, product_category_name string, "
    "customer_state string, payment_type string, item_count bigint, payment_value_brl decimal(22,2), "
    "payment_value_usd decimal(38,6), freight_value decimal(22,2), avg_temperature_c decimal(8,2)"
)
SESSION = (
    "session_key string, visitor_id string, session_start_ts timestamp_ntz, event_count bigint, view_count bigint, "
    "addtocart_count bigint, transaction_count bigint, sample_item_id string"
)


def orders_of(spark, *given):
    """Orders from (id, day, status, category, state, payment type, value)."""
    full = [(o, f"c{o}", d, s, c, st, p, 1, Decimal(v), None, Decimal(1), Decimal(20)) for o, d, s, c, st, p, v in given]
    return spark.createDataFrame(full, ORDER)


@pytest.fixture(scope="module")
def orders(spark):
    return orders_of(
        spark,
        ("ord-1", date(2018, 1, 1), "delivered", "electronics", "SP", "credit_card", 200.0),
        ("ord-2", date(2018, 1, 2), "delivered", "electronics", "SP", "boleto", 150.0),
        ("ord-3", date(2018, 1, 9), "shipped", "toys", "RJ", "boleto", 50.0),
    )


@pytest.fixture(scope="module")
def patchy(spark, orders):
    return orders.unionByName(
        orders_of(spark, ("ord-4", None, None, None, None, None, 10.0), ("ord-5", date(2018, 1, 9), "shipped", "audio", "RJ", None, 350.0))
    )


@pytest.fixture(scope="module")
def sessions(spark):
    return spark.createDataFrame(
        [("v1-1", "v1", datetime(2024, 1, 1), 4, 3, 1, 0, "a"), ("v2-1", "v2", datetime(2024, 1, 2), 3, 1, 1, 1, None)],
        SESSION,
    )


def ids(df):
    return [row.order_id for row in df.collect()]


def test_filters_combine(orders, patchy):
    chosen = dict(start=date(2018, 1, 1), end=date(2018, 1, 3), statuses=["delivered"], categories=["electronics"], states=["SP"], payment_types=["credit_card"])
    assert ids(V.filter_orders(orders, **chosen)) == ["ord-1"]
    assert len(ids(V.filter_orders(patchy))) == 5
    # A list of all known values still leaves out rows without a value.
    assert "ord-4" not in ids(V.filter_orders(patchy, statuses=["delivered", "shipped"]))
    assert V.filtered_share(patchy, **chosen).first()[:] == (1, 5)


def test_pages_are_ordered_and_continue(patchy):
    everything = ids(V.list_orders(patchy))
    assert everything == ["ord-3", "ord-5", "ord-2", "ord-1", "ord-4"]
    assert ids(V.list_orders(patchy, limit=2, offset=2)) == everything[2:4]
    assert ids(V.list_orders(patchy, after=(date(2018, 1, 9), "ord-3"))) == everything[1:]
    assert ids(V.list_orders(patchy, after=(date(2018, 1, 1), "ord-1"))) == everything[4:]
    assert ids(V.list_orders(patchy, after=(None, "ord-4"))) == []
    assert ids(V.list_orders(patchy, status="delivered", state="SP", end=date(2018, 1, 1))) == ["ord-1"]


def test_session_pages(sessions):
    keys = [row.session_key for row in V.list_sessions(sessions).collect()]
    assert keys == ["v2-1", "v1-1"]
    assert V.list_sessions(sessions, after=(datetime(2024, 1, 2), "v2-1")).first().session_key == "v1-1"


def test_session_pages_ignore_the_zone_of_the_session(spark, sessions):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert V.list_sessions(sessions, after=(datetime(2024, 1, 2), "v2-1")).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_kpis(orders):
    kpis = V.order_kpis(orders).first()
    assert (kpis.total_orders, kpis.total_revenue_brl, kpis.total_revenue_usd) == (3, 400.0, 0.0)
    assert kpis.avg_order_value_brl == pytest.approx(400 / 3)
    assert kpis.delivery_rate_pct == pytest.approx(200 / 3)
    assert V.order_kpis(orders, start=date(2018, 1, 2)).first().total_orders == 2


def test_empty_input_gives_zeros_or_no_rows(orders, sessions):
    nothing, none = orders.where("false"), sessions.where("false")
    assert V.order_kpis(nothing).first()[:] == (0, 0.0, 0.0, 0.0, 0, 0, 0.0, 0.0)
    assert V.session_funnel(none).first()[:] == (0, 0, 0, 0, 0.0)
    assert I.commerce_insights(nothing).count() == 0
    assert I.session_insights(none).count() == 0
    assert I.event_histogram(none).count() == 0
    assert I.order_trend(nothing, "week").count() == 0
    assert I.category_state_matrix(nothing, ["SP"]).count() == 0
    assert [row.total for row in I.funnel_steps(none).collect()] == [0, 0, 0]


def test_commerce_insights(orders, patchy):
    found = I.commerce_insights(orders).first()
    assert (found.top_category, found.top_category_revenue_brl) == ("electronics", 350.0)
    assert (found.top_state, found.top_state_orders) == ("SP", 2)
    assert round(found.delivered_pct, 1) == 66.7
    tied = I.commerce_insights(patchy).first()
    assert (tied.top_category, tied.top_state) == ("audio", "RJ")
    assert tied.delivered_pct == 40.0


def test_session_reports(sessions):
    found = I.session_insights(sessions).first()
    assert (found.conversion_rate_pct, found.avg_events, found.top_sample_item_id) == (50.0, 3.5, "a")
    assert I.session_metrics(sessions).first()[:] == (2, 2, 3.5, 50.0)
    assert V.session_funnel(sessions).first()[:] == (2, 4, 2, 1, 50.0)
    assert [row[1:] for row in I.funnel_steps(sessions).collect()] == [
        ("Views", 4, 100.0),
        ("Add to Cart", 2, 50.0),
        ("Transactions", 1, 25.0),
    ]
    assert [row[:] for row in I.event_histogram(sessions, 2).collect()] == [(1, 1), (2, 1)]
    parts = [row[:] for row in I.event_histogram(sessions, 20).collect()]
    assert [place for place, _ in parts] == list(range(1, 21))
    assert sum(n for _, n in parts) == 2 and max(n for _, n in parts) == 1


def test_counts_and_tops_leave_out_null(patchy):
    assert [row[:] for row in I.value_counts(patchy, "order_status").collect()] == [("delivered", 2), ("shipped", 2)]
    assert [row[:] for row in I.counts_by_value(patchy, "payment_type").collect()] == [("boleto", 2), ("credit_card", 1)]
    assert [row[0] for row in I.top_categories(patchy, 2).collect()] == ["audio", "electronics"]
    assert [row[:] for row in I.top_states(patchy).collect()] == [("RJ", 2), ("SP", 2)]
    assert [row[0] for row in V.filter_options(patchy, "product_category_name").collect()] == ["audio", "electronics", "toys"]


def test_trends_and_matrix(patchy, rows):
    assert rows(I.order_trend(patchy, "week")) == [
        (date(2018, 1, 1), 2, 350.0, 1.0),
        (date(2018, 1, 8), 2, 400.0, 1.0),
    ]
    assert I.order_trend(patchy, "month").count() == 1
    assert rows(I.category_trend(patchy, "month"))[0] == (date(2018, 1, 1), "audio", 350.0)
    wide = I.category_state_matrix(patchy, ["RJ", "SP"])
    assert wide.columns == ["product_category_name", "RJ", "SP"]
    assert rows(wide) == [("audio", 350.0, 0.0), ("electronics", 0.0, 350.0), ("toys", 50.0, 0.0)]
    assert I.category_state_matrix(patchy, ["SP", "MG"]).columns[1:] == ["SP", "MG"]


def test_serving_frames_are_completed(spark, sessions):
    products = spark.createDataFrame([("k", "toys")], "product_key string, category string")
    assert V.serving_products(products).first().product_category_name == "toys"
    assert V.serving_products(V.serving_products(products)).columns == V.serving_products(products).columns
    assert V.serving_sessions(sessions.drop("sample_item_id")).first().sample_item_id is None
    assert V.serving_sessions(sessions).columns == sessions.columns
    texts = spark.createDataFrame([("2018-01-02 03:04:05", float("nan"))], "t string, x double")
    assert V.as_days(texts, "t").first().t == date(2018, 1, 2)
    assert V.as_times(texts, "t").first().t == datetime(2018, 1, 2, 3, 4, 5)
    assert V.nan_to_null(texts).first().x is None


def test_table_stats(orders, sessions, spark):
    stats = {r.table_name: (r.row_count, r.column_count) for r in I.table_stats({"orders": orders, "sessions": sessions}).collect()}
    assert stats == {"orders": (3, 12), "sessions": (2, 8)}
    absent = I.catalog_stats(spark, {"fct_commerce_orders": "nowhere.fct_commerce_orders"})
    assert absent.first()[:] == ("fct_commerce_orders", 0, 0)


def test_enrichment_lists(spark):
    weather = spark.createDataFrame([(date(2018, 1, 2), "b"), (date(2018, 1, 2), "a"), (date(2018, 1, 1), "b")], "weather_date date, city string")
    assert [row[1] for row in V.list_weather(weather).collect()] == ["b", "a", "b"]
    assert V.list_weather(weather, city="b", start=date(2018, 1, 2)).count() == 1
    rates = spark.createDataFrame([(date(2018, 1, 2), "USD", 1.0), (date(2018, 1, 2), "BRL", 4.0)], "rate_date date, quote_currency string, fx_rate double")
    assert [row[1] for row in V.list_fx_rates(rates).collect()] == ["BRL", "USD"]
    assert V.list_fx_rates(rates, quote_currency="USD", end=date(2018, 1, 1)).count() == 0
