from datetime import date, datetime
from decimal import Decimal

import pytest

from tillstream.plans import marts as M
from tillstream.plans.staging import RAW_SOURCES, Staging
from tillstream.schemas import RAW_SCHEMAS, column_names
from tillstream.sources.catalog import empty_table

DAY = datetime(2018, 1, 2, 9)


def shop(spark, **tables):
    """Staging over the given raw rows; other tables are absent."""
    raw = {}
    for name in RAW_SOURCES:
        if name in tables:
            raw[name] = spark.createDataFrame(tables[name], RAW_SCHEMAS[name])
        else:
            raw[name] = empty_table(spark, name)
    return Staging.of(raw)


@pytest.fixture
def sample(spark):
    money = Decimal
    return shop(
        spark,
        olist_orders=[
            ("o1", "c1", "delivered", DAY, None, None),
            ("o2", "c1", "shipped", DAY, None, None),
            ("o3", "nobody", "shipped", DAY, None, None),
            ("o4", None, "shipped", datetime(2018, 1, 3), None, None),
            ("o5", "c2", "shipped", datetime(2018, 1, 4), None, None),
        ],
        olist_order_items=[
            ("o1", 1, "p9", "s", money("10.00"), money("1.00")),
            ("o1", 2, "p10", "s", money("5.50"), money("0.50")),
            ("o2", 1, "p9", "s", money("7.00"), money("2.00")),
            ("o5", 1, "gone", "s", money("3.00"), None),
            (None, 1, "p9", "s", money("99.00"), money("9.00")),
        ],
        olist_order_payments=[
            ("o1", 1, "voucher", 1, money("4.00")),
            ("o1", 2, "boleto", 1, money("13.00")),
        ],
        olist_customers=[("c1", "sao_paulo", "SP"), ("c2", "rio", "RJ")],
        olist_products=[("p10", "toys", 1, 1, 1, 300), ("p9", "books", 1, 1, 1, 100)],
        open_meteo_weather=[(date(2018, 1, 2), "sao_paulo", money("21.00"), money("2.00"), None)],
        frankfurter_fx_rates=[
            (date(2018, 1, 2), "EUR", "USD", money("1.2"), None),
            (date(2018, 1, 2), "EUR", "BRL", money("4.0"), None),
            (date(2018, 1, 3), "EUR", "USD", money("1.2"), None),
            (date(2018, 1, 4), "EUR", "USD", money("1.2"), None),
            (date(2018, 1, 4), "EUR", "BRL", money("0"), None),
        ],
    )


def by_id(df):
    return {row.order_id: row for row in df.collect()}


def test_orders_get_their_context(sample):
    orders = by_id(M.commerce_orders(M.orders_with_context(sample)))
    assert len(orders) == 5
    first = orders["o1"]
    assert (first.item_count, first.gross_item_value, first.freight_value) == (2, Decimal("15.50"), Decimal("1.50"))
    assert (first.payment_value_brl, first.payment_type) == (Decimal("17.00"), "boleto")
    # The main product is the smallest id as text.
    assert (first.product_id, first.product_category_name, first.product_weight_g) == ("p10", "toys", 300)
    assert (first.avg_temperature_c, first.precipitation_mm) == (Decimal("21.00"), Decimal("2.00"))
    assert float(first.brl_to_usd_fx_rate) == 0.3
    assert float(first.payment_value_usd) == 5.1
    second = orders["o2"]
    assert (second.payment_value_brl, second.payment_type) == (Decimal("9.00"), None)


def test_missing_sides_stay_null_or_zero(sample):
    orders = by_id(M.commerce_orders(M.orders_with_context(sample)))
    third = orders["o3"]
    assert (third.item_count, third.payment_value_brl, third.product_id) == (0, Decimal("0.00"), None)
    # Without a customer there is no city and so no weather, but the day still has a rate.
    assert (third.customer_city, third.avg_temperature_c) == (None, None)
    assert third.brl_to_usd_fx_rate is not None
    assert orders["o4"].brl_to_usd_fx_rate is None
    # Goods without a freight value add up to nothing known; a zero rate converts nothing.
    fifth = orders["o5"]
    assert (fifth.gross_item_value, fifth.payment_value_brl) == (Decimal("3.00"), Decimal("0.00"))
    assert (fifth.brl_to_usd_fx_rate, fifth.payment_value_usd) == (None, None)
    assert (fifth.product_id, fifth.product_category_name) == ("gone", None)


def test_absent_tables_leave_the_plan(spark):
    staging = shop(spark, olist_orders=[("o1", "c1", "delivered", DAY, None, None)])
    context = M.orders_with_context(staging)
    assert "Join" not in context._jdf.queryExecution().optimizedPlan().toString()
    assert context.first().payment_value_brl == Decimal("0.00")


def test_staging_keeps_every_schema_when_tables_are_absent(spark):
    staging = Staging.from_catalog(spark, "nowhere")
    assert all(frame.count() == 0 for frame in staging.named().values())
    assert len(staging.orders.columns) == 7
    assert column_names("olist_order_items")[-1] == "freight_value"


def test_event_types_are_lower_case(spark):
    staging = shop(spark, retailrocket_events=[("1", "v", "VIEW", None, None, DAY, "t")])
    assert staging.events.first().event_type == "view"
    assert dict(staging.events.dtypes)["event_ts"] == "timestamp_ntz"


def test_product_dimension_stacks_both_sources(spark, rows):
    staging = shop(
        spark,
        olist_products=[("p1", "toys", 1, 1, 1, 1)],
        open_food_facts_products=[("77", "Tea", "B", "drinks", "u", "a", None)],
    )
    assert rows(M.product_dimension(staging.products, staging.food_products)) == [
        ("olist:p1", "p1", None, None, "toys", None, None, None, "olist"),
        ("open_food_facts:77", "77", "Tea", "B", "drinks", None, "a", "u", "open_food_facts"),
    ]
