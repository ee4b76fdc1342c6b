"""Landing, warehouse build and replay against a catalog."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillstream.__main__ import parse, run
from tillstream.operators import quality as Q
from tillstream.operators import upserts as U
from tillstream.plans import insights as I
from tillstream.plans import checks, jobs
from tillstream.settings import COMMERCE_FILES, DayRange, ReplayPlan
from tillstream.sinks import files as sink_files
from tillstream.sinks import tables
from tillstream.sources import generators, payloads
from tillstream.sources.catalog import list_tables
from tillstream.streaming import replay

CLICKS = [
    {"event_id": "e-7", "visitor_id": "ann", "event_type": "view", "item_id": "hat", "transaction_id": None, "event_ts": "2031-02-11T23:50:00Z"},
    {"event_id": "e-8", "visitor_id": "ann", "event_type": "AddToCart", "item_id": "hat", "transaction_id": None, "event_ts": "2031-02-12T00:04:00Z"},
    {"event_id": "e-9", "visitor_id": "bo", "event_type": "transaction", "item_id": "mug", "transaction_id": "t1", "event_ts": "2031-02-12T02:30:00+02:00"},
]


@pytest.fixture(scope="module")
def layers(spark):
    tables.create_layers(spark)
    return spark


@pytest.fixture
def click_folder(tmp_path):
    folder = tmp_path / "clicks"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join(json.dumps(click) for click in CLICKS) + "\n\n")
    return folder


def test_layers_list_their_tables(layers):
    listed = [row[:] for row in list_tables(layers).collect()]
    assert len([name for schema, name in listed if schema == "raw"]) == 10
    assert listed == sorted(listed)
    tables.create_layers(layers)


def test_manifest_loads_its_files_alone(layers, tmp_path):
    (tmp_path / "olist_customers_dataset.csv").write_text("customer_id,customer_city,customer_state\n1,a,SP\n2,b,RJ\n")
    (tmp_path / "list").write_text("olist_customers_dataset.csv\nunknown.csv\n")
    (tmp_path / "none").write_text("unknown.csv\n")
    assert jobs.load_manifest(layers, str(tmp_path), str(tmp_path / "list")) == {"olist_customers": 2}
    assert layers.table("raw.olist_customers").count() == 2
    assert jobs.load_manifest(layers, str(tmp_path), str(tmp_path / "none")) == {}
    assert layers.table("raw.olist_customers").count() == 2


def test_commerce_files_to_marts(layers, tmp_path):
    spark = layers
    sample = generators.commerce_sample(spark)
    for name, table in COMMERCE_FILES.items():
        sample[table].coalesce(1).write.option("header", True).csv(str(tmp_path / name))
    counts = jobs.load_commerce(spark, str(tmp_path))
    assert sum(counts.values()) == 2401
    assert tables.load_counts(counts, spark).where("table_name = 'total'").first().row_count == 2401
    # Made-up weather covers the first days only; orders of other days have none.
    dates = DayRange(date(2018, 1, 1), date(2018, 12, 31))
    cities = [city for city, _ in generators.PLACES]
    jobs.load_fallback(generators.fallback_weather(spark, cities, dates, F.current_timestamp()), "open_meteo", "open_meteo_weather", ["city"], str(tmp_path / "bronze-w"))
    jobs.load_fallback(generators.fallback_fx(spark, "EUR", dates, F.current_timestamp()), "frankfurter", "frankfurter_fx_rates", [], str(tmp_path / "bronze-f"))
    jobs.build_warehouse(spark)
    orders = spark.table("marts.fct_commerce_orders")
    assert orders.count() == 500
    early = orders.where("order_date <= '2018-01-14'")
    assert early.where("avg_temperature_c is null or payment_value_usd is null").count() == 0
    assert orders.where("order_date > '2018-01-14' and avg_temperature_c is not null").count() == 0
    assert spark.table("marts.dim_products").count() == 150
    assert spark.sql("select count(*) from stg_olist_orders").first()[0] == 500
    stats = {r.table_name: r.row_count for r in I.catalog_stats(spark, {"o": "marts.fct_commerce_orders", "x": "marts.none"}).collect()}
    assert stats == {"o": 500, "x": 0}
    audit = tables.current_audit(spark)
    assert {r.source_name: r.row_count for r in U.latest_audit(audit).collect()}["olist"] == 2401
    results = Q.check_suite(spark, Q.catalog_tables(spark, list(Q.SUITE)))
    failed = {(r.table_name, r.expectation) for r in results.where("status = 'failed'").collect()}
    assert failed <= {("raw.retailrocket_events", "row_count_above")}


def test_payload_loads_keep_documents(layers, tmp_path):
    spark = layers
    (tmp_path / "p.json").write_text(json.dumps({"status": 1, "product": {"code": "77", "product_name": "Tea"}}))
    answers = payloads.read_product_payloads(spark, str(tmp_path / "p.json"))
    assert jobs.load_products(answers, str(tmp_path / "bronze"), store=str(tmp_path / "store")) == 1
    document = spark.read.parquet(str(tmp_path / "store")).first()
    assert document.product_code == "77" and document.fallback is False
    assert json.loads(document.payload)["product"]["brands"] is None
    assert spark.table("raw.open_food_facts_products").first().brands == "unknown"
    (tmp_path / "w.json").write_text(json.dumps({"daily": {"time": ["2018-01-01"], "temperature_2m_mean": [1.5], "precipitation_sum": []}}))
    assert jobs.load_weather(payloads.read_weather_payloads(spark, {"x": str(tmp_path / "w.json")}), str(tmp_path / "bw")) == 1
    (tmp_path / "f.json").write_text(json.dumps([{"date": "2018-01-01", "base": "EUR", "quote": "USD", "rate": 1.2}, {"date": "2018-01-01"}]))
    assert jobs.load_fx(payloads.read_fx_payloads(spark, str(tmp_path / "f.json")), str(tmp_path / "bf")) == 1


def test_refresh_of_empty_input(layers):
    spark = layers
    one = spark.createDataFrame([("c", "x", "X")], "customer_id string, customer_city string, customer_state string")
    assert tables.refresh_raw(one, "olist_customers") == 1
    assert tables.refresh_raw(one.where("false"), "olist_customers", keep_if_empty=True) == 0
    assert spark.table("raw.olist_customers").count() == 1
    assert tables.refresh_raw(one.where("false"), "olist_customers") == 0
    assert spark.table("raw.olist_customers").count() == 0


def test_audit_rows_are_upserted(layers):
    spark = layers
    before = tables.current_audit(spark).count()
    tables.append_audit(spark, "test", "b1", 1)
    tables.append_audit(spark, "test", "b1", 2)
    current = tables.current_audit(spark)
    assert current.count() == before + 1
    assert current.where("source_name = 'test'").first().row_count == 2


def test_replay_loads_routes_and_archives(layers, click_folder, tmp_path):
    spark = layers
    plan = ReplayPlan(source=str(click_folder), output=str(tmp_path / "replay"))
    summary = replay.run_replay(spark, plan)
    assert summary == {
        "record_count": 3,
        "table_rows": 3,
        "document_rows": 3,
        "topic_counts": {
            "retailrocket.events.view": 1,
            "retailrocket.events.addtocart": 1,
            "retailrocket.events.transaction": 1,
        },
    }
    assert spark.table("raw.retailrocket_events").where("event_type = 'addtocart'").count() == 1
    topics = spark.read.parquet(f"{plan.output}/topics")
    assert topics.count() == 6 and topics.where("topic = 'retailrocket.events.raw'").count() == 3
    progress = spark.read.json(f"{plan.output}/progress").first()
    assert (progress.record_count, progress.last_event_ts, progress.mode) == (3, "2031-02-12T00:30:00.000Z", "replay")
    assert spark.read.json(f"{plan.output}/replays/0_raw").where("event_type = 'AddToCart'").count() == 1
    # A second replay takes up only new files, and documents seen before are not added again.
    late = dict(CLICKS[0], event_id="e-10", event_type="banner")
    (click_folder / "b.jsonl").write_text(json.dumps(late) + "\n" + json.dumps(CLICKS[0]) + "\n")
    again = replay.run_replay(spark, plan)
    assert (again["record_count"], again["document_rows"]) == (5, 1)
    assert replay.dead_letters(spark, plan).count() == 1


def test_replay_archive_is_whole_and_small(layers, tmp_path):
    spark = layers
    (tmp_path / "clicks").mkdir()
    clicks = [dict(CLICKS[0], event_id=f"e-{i}") for i in range(2_000)]
    (tmp_path / "clicks" / "a.jsonl").write_text("".join(json.dumps(click) + "\n" for click in clicks))
    plan = ReplayPlan(source=str(tmp_path / "clicks"), output=str(tmp_path / "replay"))
    replay.run_replay(spark, plan)
    for name in ("raw", "normalized"):
        archive = tmp_path / "replay" / "replays" / f"0_{name}"
        lines = spark.read.json(str(archive))
        assert {row.event_id for row in lines.select("event_id").collect()} == {click["event_id"] for click in clicks} and lines.count() == 2_000
        size = sum(len("".join(row)) for row in spark.read.text(str(archive)).collect())
        assert 4 * sum(file.stat().st_size for file in archive.glob("part-*")) < size


def test_session_job(layers, click_folder, tmp_path):
    spark = layers
    written = jobs.session_job(spark, str(click_folder), str(tmp_path / "sessions"))
    assert written == 2
    got = {r.session_key: (r.event_count, r.view_count, r.addtocart_count, r.transaction_count) for r in spark.read.parquet(str(tmp_path / "sessions")).collect()}
    assert got == {"ann-1": (2, 1, 1, 0), "bo-1": (1, 0, 0, 1)}


def test_documents_are_best_effort(spark, tmp_path):
    frame = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "b")], "event_id string, body string")
    store = str(tmp_path / "store")
    assert sink_files.add_documents(frame, store, key="event_id") == 2
    assert sink_files.add_documents(frame, store, key="event_id") == 0
    (tmp_path / "blocked").write_text("a file")
    assert sink_files.add_documents(frame, str(tmp_path / "blocked" / "x")) == 0


def test_documents_keep_fields_no_schema_names(layers, tmp_path):
    spark = layers
    product = {"status": 1, "product": {"code": "77", "nutriments": {"fat": 1}}, "extra": "p"}
    for name, text in {
        "p.json": product, "s.json": {"products": [product["product"]]}, "w/x.json": {"daily": {"time": ["2018-01-01"], "wind": [3]}, "elevation": 4},
        "f.json": [{"date": "2018-01-01", "base": "EUR", "quote": "USD", "rate": 1.2, "extra": "f"}], "c/a.jsonl": dict(CLICKS[0], page="/home"),
    }.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps(text, indent=None if name.endswith("l") else 1))
    at = lambda name: str(tmp_path / name)
    jobs.load_products(payloads.read_product_payloads(spark, at("p.json")), at("bp"), store=at("sp"))
    jobs.load_products(payloads.read_product_sample(spark, at("s.json")), at("bs"), store=at("ss"))
    jobs.load_weather(payloads.read_weather_folder(spark, at("w")), at("bw"), store=at("sw"))
    jobs.load_fx(payloads.read_fx_payloads(spark, at("f.json")), at("bf"), store=at("sf"))
    replay.run_replay(spark, ReplayPlan(source=at("c"), output=at("r")))
    received = {name: json.loads(spark.read.parquet(at(name)).first().received) for name in ("sp", "ss", "sw", "sf", "r/documents")}
    assert received["sp"] == product and received["ss"] == product["product"]
    assert received["sw"]["elevation"] == 4 and received["sw"]["daily"]["wind"] == [3]
    assert received["sf"]["extra"] == "f" and received["r/documents"]["page"] == "/home"
    assert json.loads(spark.read.json(f"{at('r')}/replays/0_raw").first().received)["page"] == "/home"


def test_a_failed_job_is_not_an_unreachable_store(spark, tmp_path):
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("body"))
    with pytest.raises(Exception, match="lost"):
        sink_files.add_documents(broken, str(tmp_path / "store"))


def test_bucketed_tables_join_without_shuffle(layers):
    spark = layers
    left = spark.range(100).select(F.col("id").cast("string").alias("order_id"))
    tables.materialize(left, "bucketed_a", "staging", bucket_by=(4, "order_id"))
    tables.materialize(left, "bucketed_b", "staging", bucket_by=(4, "order_id"))
    joined = spark.table("staging.bucketed_a").join(spark.table("staging.bucketed_b").hint("merge"), "order_id")
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100


def test_jobs_from_the_command_line(layers, click_folder, tmp_path):
    written = run(layers, parse(["sessions", "--input-path", str(click_folder), "--output-path", str(tmp_path / "s"), "--gap-minutes", "1"]))
    assert written == 3
    (tmp_path / "f.json").write_text(json.dumps([{"date": "2018-01-01", "base": "EUR", "quote": "USD", "rate": -1}]))
    assert run(layers, parse(["fx", str(tmp_path / "f.json"), "--bronze", str(tmp_path / "b")])) == 1
    results = {r.name: r.status for r in checks.run_violation_queries(layers).collect()}
    assert results["reference_fx_positive"] == results["positive_fx_rates"] == "failed"
    assert results["raw_olist_orders_not_null"] == "passed"
    with pytest.raises(RuntimeError, match="violations"):
        run(layers, parse(["quality", str(tmp_path / "report")]))
    run(layers, parse(["quality", str(tmp_path / "report"), "--non-strict"]))
    document = json.loads(next((tmp_path / "report" / "suite").glob("part-*.json")).read_text())
    assert len(document["results"]) == 19


def test_replay_of_no_events_keeps_the_table(layers, tmp_path):
    (tmp_path / "none").mkdir()
    plan = ReplayPlan(source=str(tmp_path / "none"), output=str(tmp_path / "out"))
    before = layers.table("raw.retailrocket_events").count()
    assert replay.run_replay(layers, plan) == {"record_count": 0, "table_rows": 0, "document_rows": 0, "topic_counts": {}}
    assert layers.table("raw.retailrocket_events").count() == before


def event_rows(spark, *ids):
    columns = "event_id string, visitor_id string, event_type string, item_id string, transaction_id string, event_ts timestamp, kafka_topic string"
    return spark.createDataFrame([(i, "v", "view", None, None, None, "t") for i in ids], columns)


def ids_of(table):
    return sorted(row["event_id"] for row in table.collect())


def test_a_load_that_fails_leaves_the_old_rows(layers):
    spark = layers
    assert tables.refresh_raw(event_rows(spark, "a", "b"), "retailrocket_events") == 2
    reader = spark.table("raw.retailrocket_events")
    broken = event_rows(spark, "c", "d").withColumn("item_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.refresh_raw(broken, "retailrocket_events")
    assert ids_of(spark.table("raw.retailrocket_events")) == ["a", "b"]
    assert tables.refresh_raw(event_rows(spark, "e"), "retailrocket_events") == 1
    assert ids_of(spark.table("raw.retailrocket_events")) == ["e"]
    # Who began to read before sees what was there then.
    assert ids_of(reader) == ["a", "b"]
    event_rows(spark, "f").write.insertInto("raw.retailrocket_events")
    assert ids_of(spark.table("raw.retailrocket_events")) == ["e", "f"]


def test_batches_of_a_replay_are_loaded_once(layers, tmp_path):
    spark = layers
    target, folder = "raw.retailrocket_events", str(tmp_path / "table")
    for number, ids in ((0, "ab"), (1, "c"), (1, "c"), (0, "ab")):
        assert tables.load_batch(event_rows(spark, *ids), target, folder, number) == len(ids)
    assert ids_of(spark.table(target)) == ["a", "b", "c"]
    broken = event_rows(spark, "x").withColumn("item_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.load_batch(broken, target, folder, 1)
    assert ids_of(spark.table(target)) == ["a", "b", "c"]
    assert tables.refresh_raw(event_rows(spark, "z"), "retailrocket_events") == 1
    assert ids_of(spark.table(target)) == ["z"] and len(list((tmp_path / "table").glob("batch-*/*.parquet"))) >= 2


def test_a_replay_fills_the_table_batch_by_batch_and_goes_on_without_a_broker(layers, click_folder, tmp_path):
    spark = layers
    (click_folder / "b.jsonl").write_text(json.dumps(dict(CLICKS[0], event_id="e-11")) + "\n")
    plan = ReplayPlan(source=str(click_folder), output=str(tmp_path / "replay"), kafka_servers="nowhere:1")
    query = replay.start_replay(spark, plan, files_per_batch=1, table="raw.retailrocket_events")
    query.awaitTermination()
    assert ids_of(spark.table("raw.retailrocket_events")) == ["e-11", "e-7", "e-8", "e-9"]
    assert spark.read.json(f"{plan.output}/progress").count() == 2


def test_a_store_reads_the_buckets_of_its_load_only(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    many = spark.range(2_000).select(F.col("id").cast("string").alias("event_id"), F.lit("x").alias("body"))
    assert sink_files.add_documents(many, store, key="event_id") == 2_000
    seen = []
    monkeypatch.setattr(sink_files, "unseen", lambda new, stored, keys: seen.append(stored) or U.unseen(new, stored, keys))
    one = spark.createDataFrame([("7", "y"), ("new", "y")], "event_id string, body string")
    assert sink_files.add_documents(one, store, key="event_id") == 1
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert seen[0].count() < 100 and seen[0].columns == ["event_id"]
    assert spark.read.parquet(store).count() == 2_001
