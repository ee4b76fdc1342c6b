import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream.settings import COMMERCE_FILES, DayRange, TopicPlan
from tillstream.sources import clicks, files, generators, payloads


def loaded():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_has_explicit_types_and_lenient_times(spark, tmp_path):
    path = write(
        tmp_path / "orders.csv",
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_estimated_delivery_date",
        "o1,c1,delivered,2018-01-01 08:00:00+00:00,never,2018-01-05",
    )
    frame = files.read_table_csv(spark, path, "olist_orders")
    row = frame.first()
    assert frame.schema["order_purchase_timestamp"].dataType.typeName() == "timestamp"
    assert row.order_purchase_timestamp == datetime(2018, 1, 1, 8)
    assert row.order_approved_at is None
    assert row.order_estimated_delivery_date == datetime(2018, 1, 5)


def test_file_list_is_narrowed_and_falls_back(spark):
    assert files.wanted_files(["olist_orders_dataset.csv", "other.csv"]) == {"olist_orders_dataset.csv": "olist_orders"}
    assert files.wanted_files(["other.csv"]) == COMMERCE_FILES
    assert files.wanted_files(None) == COMMERCE_FILES


def test_json_lines_skip_blanks_and_fail_on_broken_lines(spark, tmp_path):
    good = write(tmp_path / "good.jsonl", '{"event_id": "1"}', "", '{"event_id": "2"}')
    assert files.read_json_lines(spark, good).count() == 2
    broken = write(tmp_path / "broken.jsonl", '{"event_id": "1"}', "{oops")
    with pytest.raises(Exception):
        files.read_json_lines(spark, broken).collect()
    assert clicks.job_clicks(files.read_click_lines(spark, broken)).count() == 0
    with pytest.raises(Exception):
        files.read_click_lines(spark, str(tmp_path / "absent.jsonl"))


def test_fx_entries(spark, tmp_path, rows):
    whole = {"date": "2030-06-30", "base": "CHF", "quote": "SEK", "rate": 11.25}
    entries = [whole, whole | {"quote": "NOK", "rate": 0}, whole | {"date": "2030-07-01", "rate": 0.1, "note": "kept apart"}]
    # An entry lacking any of its fields is dropped, and so is one with an empty or null field.
    entries += [{k: v for k, v in whole.items() if k != gone} for gone in whole]
    entries += [whole | {name: None} for name in whole] + [whole | {name: ""} for name in ("date", "base", "quote")]
    path = write(tmp_path / "fx.json", json.dumps(entries))
    got = payloads.normalize_fx(payloads.read_fx_payloads(spark, path), loaded()).drop("ingested_at")
    assert rows(got) == [
        (date(2030, 6, 30), "CHF", "NOK", Decimal("0E-8")),
        (date(2030, 6, 30), "CHF", "SEK", Decimal("11.25000000")),
        (date(2030, 7, 1), "CHF", "SEK", Decimal("0.10000000")),
    ]
    none = write(tmp_path / "none.json", "[]")
    assert payloads.normalize_fx(payloads.read_fx_payloads(spark, none), loaded()).count() == 0


def test_weather_series_follow_the_listed_days(spark, tmp_path, rows):
    short = {"daily": {"time": ["2018-01-01", "2018-01-02"], "temperature_2m_mean": [20.5], "precipitation_sum": [1, 2, 3]}}
    none = {"daily": {"time": [], "temperature_2m_mean": [1.0], "precipitation_sum": []}}
    paths = {"a": write(tmp_path / "a.json", json.dumps(short)), "b": write(tmp_path / "b.json", json.dumps(none))}
    got = payloads.normalize_weather(payloads.read_weather_payloads(spark, paths), loaded()).drop("ingested_at")
    assert rows(got) == [
        (date(2018, 1, 1), "a", Decimal("20.50"), Decimal("1.00")),
        (date(2018, 1, 2), "a", None, Decimal("2.00")),
    ]
    merged = payloads.normalize_weather(payloads.read_weather_folder(spark, str(tmp_path)), loaded())
    assert rows(merged.drop("ingested_at")) == rows(got)


def test_products_from_answers(spark, tmp_path, rows):
    folder = tmp_path / "answers"
    folder.mkdir()
    answers = [
        {"status": 1, "product": {"code": " 1 ", "product_name": " Tea ", "brands": "B", "categories": "", "ecoscore_grade": "a"}},
        {"status": 1, "product": {"code": "2", "product_name": "", "generic_name": "Generic"}},
        {"status": 1, "product": {"code": "3", "product_name": "  ", "generic_name": "Hidden", "image_front_url": "u"}},
        {"status": 1, "product": {"code": "  "}},
        {"status": 1, "product": {"product_name": "no code"}},
        {"status": 0, "product": {"code": "4"}},
        {"status": 1},
    ]
    for number, answer in enumerate(answers):
        write(folder / f"{number}.json", json.dumps(answer, indent=1))
    got = payloads.normalize_products(payloads.read_product_payloads(spark, str(folder)), loaded()).drop("ingested_at")
    assert rows(got) == [
        ("1", "Tea", "B", "unknown", "", "a"),
        ("2", "Generic", "unknown", "unknown", "", "unknown"),
        ("3", "unknown", "unknown", "unknown", "u", "unknown"),
    ]
    sample = write(tmp_path / "sample.json", json.dumps({"products": [{"code": "9", "product_name": "N"}]}))
    assert payloads.normalize_products(payloads.read_product_sample(spark, sample), loaded()).first().product_code == "9"


def test_clicks_are_normalized_and_routed(spark):
    kinds = {"TRANSACTION": "transaction", "addToCart": "addtocart", "view": "view", "scroll": "dlq", "": "dlq"}
    raw = spark.createDataFrame(
        [(100 + n, -n, kind, 900 + n if n % 2 else None, None, f"2031-0{n + 1}-05T06:07:08+01:00") for n, kind in enumerate(kinds)],
        "event_id int, visitor_id int, event_type string, item_id int, transaction_id string, event_ts string",
    )
    normalized = clicks.normalize_clicks(raw, TopicPlan())
    got = {row.event_type: row for row in normalized.collect()}
    assert {row.event_type: row.kafka_topic.rsplit(".", 1)[1] for row in got.values()} == {k.lower(): v for k, v in kinds.items()}
    assert (got["addtocart"].event_id, got["addtocart"].visitor_id, got["addtocart"].item_id) == ("101", "-1", "901")
    assert got["view"].item_id is None and got["view"].event_ts == "2031-03-05T06:07:08+01:00"
    messages = clicks.fan_out(normalized, TopicPlan())
    assert messages.count() == 2 * len(kinds)
    assert messages.where("topic = 'retailrocket.events.raw'").count() == len(kinds)
    assert json.loads(messages.where("key = '103'").first().value)["transaction_id"] is None


def test_click_without_visitor_fails(spark):
    raw = spark.createDataFrame([("1", None, "view", None, None, "t")], "event_id string, visitor_id string, event_type string, item_id string, transaction_id string, event_ts string")
    with pytest.raises(Exception, match="visitor_id"):
        clicks.normalize_clicks(raw, TopicPlan()).collect()


def test_fallback_rows(spark, rows):
    dates = DayRange(date(2018, 1, 1), date(2018, 12, 31))
    weather = generators.fallback_weather(spark, ["a", "b"], dates, loaded())
    assert weather.count() == 28
    assert weather.where("city = 'a' and weather_date = '2018-01-12'").first()[2:4] == (Decimal("20.00"), Decimal("0.00"))
    short = DayRange(date(2018, 1, 1), date(2018, 1, 3))
    assert generators.fallback_weather(spark, ["a"], short, loaded()).count() == 3
    rates = generators.fallback_fx(spark, "EUR", dates, loaded())
    assert rates.count() == 28
    assert rows(rates.where("rate_date = '2018-01-09'").select("quote_currency", "fx_rate")) == [
        ("BRL", Decimal("4.40000000")),
        ("USD", Decimal("1.14000000")),
    ]


def test_commerce_sample_sizes_and_repeatability(spark, rows):
    sample = generators.commerce_sample(spark)
    counts = {name: frame.count() for name, frame in sample.items()}
    assert counts == {
        "olist_orders": 500,
        "olist_order_items": 1001,
        "olist_customers": 250,
        "olist_products": 150,
        "olist_order_payments": 500,
    }
    again = generators.commerce_sample(spark)
    for name, frame in sample.items():
        assert rows(frame) == rows(again[name].repartition(3))
    assert rows(generators.commerce_sample(spark, seed=7)["olist_orders"]) != rows(sample["olist_orders"])
    paid = sample["olist_order_payments"].select("order_id", "payment_value")
    owed = sample["olist_order_items"].groupBy("order_id").agg((F.sum("price") + F.sum("freight_value")).alias("v"))
    assert paid.join(owed, "order_id").where("payment_value <> v").count() == 0
    prices = sample["olist_order_items"].agg(F.min("price"), F.max("price")).first()
    assert Decimal("4.90") <= prices[0] < prices[1] <= 899


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "customer_state,customer_id,customer_zip_code_prefix,customer_city\nSP,c1,14409,franca\nRJ,c2,,\n"
    )
    rows = [tuple(r) for r in files.read_table_csv(spark, str(tmp_path / "c.csv"), "olist_customers").collect()]
    assert rows == [("c1", "franca", "SP"), ("c2", None, "RJ")]
    (tmp_path / "d.csv").write_text("customer_id,customer_city\nc1,franca\n")
    with pytest.raises(ValueError, match="customer_state"):
        files.read_table_csv(spark, str(tmp_path / "d.csv"), "olist_customers")


def test_progress_is_the_latest_time_not_the_last_text(spark):
    from tillstream.sinks.files import progress_of

    events = spark.createDataFrame([("2026-04-03T23:00:00-05:00",), ("2026-04-04T01:00:00Z",), ("bad",)], "event_ts string")
    latest = progress_of(events, "replay", "x").selectExpr("cast(last_event_ts as string)").first()[0]
    assert latest == "2026-04-04 04:00:00"


def test_csv_cells_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text('customer_id,customer_city,customer_state\nc1,"sao ""p"", x",SP\n"c2","two\nlines",RJ\nc3,short\nc4,a,b,c\nc5,"",MG\n')
    rows = [tuple(r) for r in files.read_table_csv(spark, str(path), "olist_customers", misfits=True).collect()]
    assert rows == [
        ("c1", 'sao "p", x', "SP", None),
        ("c2", "two\nlines", "RJ", None),
        ("c3", "short", None, "c3,short"),
        ("c4", "a", "b", "c4,a,b,c"),
        ("c5", None, "MG", None),
    ]
    assert [tuple(r) for r in files.misfit_records(spark, str(path)).collect()] == [("customers.csv", "c3,short"), ("customers.csv", "c4,a,b,c")]
    split = files.read_table_csv(spark, str(path), "olist_customers", multi_line=False)
    assert split.where("customer_city = 'sao \"p\", x'").count() == 1


def test_manifest_prunes_the_files(spark, tmp_path):
    (tmp_path / "olist_orders_dataset.csv").write_text("order_id,customer_id\n1,a\n2\n3,c\n")
    (tmp_path / "olist_customers_dataset.csv").write_text("customer_id,customer_city\n")
    (tmp_path / "list.txt").write_text("olist_orders_dataset.csv\r\n\nolist_customers_dataset.csv\nother.csv\nolist_orders_dataset.csv\n")
    listed = files.manifest_files(spark, str(tmp_path / "list.txt"))
    assert listed == ["olist_customers_dataset.csv", "olist_orders_dataset.csv"]
    found = files.listed_counts(spark, str(tmp_path), listed).collect()
    assert sorted(tuple(row) for row in found) == [("olist_customers", 0, 0, 0), ("olist_orders", 1, 3, 1)]
    (tmp_path / "none.txt").write_text("other.csv\n")
    assert files.manifest_files(spark, str(tmp_path / "none.txt")) == []
