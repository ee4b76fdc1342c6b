"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions import expressions as X
from tillstream.operators import quality as Q
from tillstream.operators import sessions as S
from tillstream.operators import upserts as U
from tillstream.plans import insights as I
from tillstream.plans import marts as M
from tillstream.plans import serving as V
from tillstream.plans import staging as G
from tillstream.plans.jobs import product_documents
from tillstream.session import shared_folder
from tillstream.schemas import RAW_SCHEMAS
from tillstream.settings import COMMERCE_FILES, WAREHOUSE_STATUSES, ReplayPlan, TopicPlan
from tillstream.sinks.files import add_documents, progress_of
from tillstream.sinks.tables import create_table, switch_rows, with_total
from tillstream.sources import clicks as C
from tillstream.sources import payloads as P
from tillstream.sources import testbed as T
from tillstream.sources.catalog import empty_table
from tillstream.sources.files import listed_counts, manifest_files, misfit_records, read_table_csv
from tillstream.streaming.archive import SessionArchive
from tillstream.streaming.replay import start_replay
from tillstream.streaming.sessions import click_stream, session_stream, write_closed_sessions

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

def loaded_at():
    return F.to_timestamp_ntz(F.lit(T.LOADED_AT))

CHOSEN = {
    "start": date(1996, 1, 1),
    "end": date(1999, 12, 31),
    "statuses": ["delivered", "shipped"],
    "categories": ["SMALL", "MEDIUM", "ECONOMY"],
    "states": ["ASIA", "EUROPE"],
    "payment_types": [],
}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and whole numbers as bigint, for comparison across engines."""
    def cast(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return F.col(name).cast("bigint").alias(name)
        return F.col(name)

    return df.select(*(cast(name, kind) for name, kind in df.dtypes))


def orders_mart(spark: SparkSession, folder: str) -> DataFrame:
    return M.commerce_orders(M.orders_with_context(T.staged(spark, folder)))


def sessions_mart(spark: SparkSession, folder: str) -> DataFrame:
    return M.click_sessions(G.stage_events(T.raw_events(spark, folder)))


def products_mart(spark: SparkSession, folder: str) -> DataFrame:
    return M.product_dimension(
        G.stage_products(T.raw_products(spark, folder)), G.stage_food_products(T.raw_food_products(spark, folder))
    )


def rounded_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("brl_to_usd_fx_rate", F.round("brl_to_usd_fx_rate", 12))


# Staging


@query
def stg_orders(spark, folder):
    return G.stage_orders(T.raw_orders(spark, folder))


@query
def csv_orders(spark, folder):
    """Orders written as CSV with other and further columns, read back by name."""
    orders = T.raw_orders(spark, folder).withColumn("note", F.lit("x, y")).withColumn("order_channel", F.lit(7))
    path = f"{shared_folder(spark)}/csv-orders-{uuid.uuid4().hex}"
    orders.select(*sorted(orders.columns, reverse=True)).write.option("header", True).csv(path)
    return read_table_csv(spark, path, "olist_orders").select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "order_status",
        F.col("order_purchase_timestamp").cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )


def odd_cells(spark, folder):
    """Customers as CSV text of our own making: quotes, separators and line breaks in cells, and records that do not fit."""
    number = F.col("c_custkey").cast("string")
    name = (
        F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit('"'), F.col("c_name"), F.lit(' ""the"" 2nd, of\n x"')))
        .when(F.col("c_custkey") % 4 == 1, F.concat(F.lit('"a, '), F.col("c_name"), F.lit('"')))
        .otherwise(F.col("c_name"))
    )
    record = (
        F.when(F.col("c_custkey") % 10 == 3, F.concat_ws(",", number, name))
        .when(F.col("c_custkey") % 10 == 7, F.concat_ws(",", number, name, "c_mktsegment", F.lit("more")))
        .otherwise(F.concat_ws(",", number, name, "c_mktsegment"))
    )
    path = f"{shared_folder(spark)}/odd-cells-{uuid.uuid4().hex}"
    dealt = T.table(spark, folder, "customer").select("c_custkey", record.alias("record")).repartition(8, "c_custkey")
    # Each partition becomes a file, whose first record follows the header.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit("customer_id,customer_city,customer_state\n")
    dealt.select(F.when(first, F.concat(header, "record")).otherwise(F.col("record")).alias("value")).write.text(path)
    return path


@query
def csv_odd_cells(spark, folder):
    """Records of such files as the table of customers."""
    rows = read_table_csv(spark, odd_cells(spark, folder), "olist_customers")
    return rows.withColumn("customer_id", F.col("customer_id").cast("bigint"))


@query
def csv_misfits(spark, folder):
    """Records of such files that do not fit the header."""
    return misfit_records(spark, odd_cells(spark, folder)).select("misfit_record")


@query
def manifest_counts(spark, folder):
    """Counts of the files that a manifest names, of five written ones; one name in it is unknown."""
    path = f"{shared_folder(spark)}/listed-{uuid.uuid4().hex}"
    raw = T.raw_tables(spark, folder)
    for name, table in COMMERCE_FILES.items():
        raw[table].write.option("header", True).option("escape", '"').csv(f"{path}/{name}")
    names = ["olist_orders_dataset.csv", " olist_products_dataset.csv", "", "unknown.csv", "olist_order_payments_dataset.csv"]
    spark.range(1).select(F.explode(F.array(*map(F.lit, names)))).write.text(f"{path}/manifest")
    return listed_counts(spark, path, manifest_files(spark, f"{path}/manifest")).drop("file_count")


@query
def stg_order_items(spark, folder):
    return plain(G.stage_order_items(T.raw_order_items(spark, folder)))


@query
def stg_customers(spark, folder):
    return G.stage_customers(T.raw_customers(spark, folder))


@query
def stg_products(spark, folder):
    return plain(G.stage_products(T.raw_products(spark, folder)))


@query
def stg_order_payments(spark, folder):
    return plain(G.stage_order_payments(T.raw_order_payments(spark, folder)))


@query
def stg_events(spark, folder):
    return G.stage_events(T.raw_events(spark, folder))


@query
def stg_food_products(spark, folder):
    return G.stage_food_products(T.raw_food_products(spark, folder))


@query
def weather_spine(spark, folder):
    return plain(G.stage_weather(T.raw_weather(spark, folder)))


@query
def fx_spine(spark, folder):
    return plain(G.stage_fx_rates(T.raw_fx_rates(spark, folder)))


# Payloads and click events


def product_payloads(spark, folder):
    """Product answers with every defect, one per part."""
    key = F.col("p_partkey")
    product = F.struct(
        F.when(key % 11 == 0, "  ").otherwise(F.concat(F.lit(" "), key.cast("string"))).alias("code"),
        F.when(key % 5 == 0, "").when(key % 7 == 0, "  ").otherwise(F.col("p_name")).alias("product_name"),
        F.when(key % 3 != 0, F.col("p_type")).alias("generic_name"),
        F.when(key % 4 != 0, F.col("p_brand")).alias("brands"),
        F.when(key % 6 == 0, "").otherwise(F.col("p_type")).alias("categories"),
        F.lit(None).cast("string").alias("image_front_url"),
        F.when(key % 2 == 0, F.lit("b")).alias("ecoscore_grade"),
    )
    return T.table(spark, folder, "part").select(
        (key % 13 != 0).cast("int").alias("status"), F.when(key % 17 != 0, product).alias("product")
    )


@query
def product_payload_normalize(spark, folder):
    return P.normalize_products(product_payloads(spark, folder), loaded_at())


@query
def bronze_envelope(spark, folder):
    """The documents that a load of products keeps."""
    return product_documents(product_payloads(spark, folder), F.lit("open-food-facts-20240101T000000"), loaded_at())


@query
def fx_payload_normalize(spark, folder):
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    def entry(quote, rate):
        return F.struct(
            F.when(key % 11 == 0, "").otherwise(day).alias("date"),
            F.when(key % 7 != 0, F.lit("EUR")).alias("base"),
            F.lit(quote).alias("quote"),
            F.when(key % 13 != 0, rate.cast(X.RATE)).alias("rate"),
        )
    payloads = T.table(spark, folder, "orders").select(
        F.array(entry("USD", key % 5), entry("BRL", key % 9 + 1)).alias("rates")
    )
    return plain(P.normalize_fx(P.explode_entries(payloads, "rates"), loaded_at()))


@query
def weather_payload_reshape(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    listed = F.array(F.date_format(day, "yyyy-MM-dd"), F.date_format(day + F.expr("interval 1 day"), "yyyy-MM-dd"))
    temperatures = F.sequence(F.lit(1).cast("bigint"), key % 4 + 1).cast("array<double>")
    payloads = T.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("city"),
        F.struct(
            F.when(key % 10 == 0, F.array(F.lit("no date"))).otherwise(listed).alias("time"),
            temperatures.alias("temperature_2m_mean"),
            F.array(F.lit(0.25)).alias("precipitation_sum"),
        ).alias("daily"),
    )
    return plain(P.normalize_weather(payloads, loaded_at()))


@query
def lenient_dates(spark, folder):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.concat(day, F.lit("-x"))).otherwise(day)
    return T.table(spark, folder, "orders").select("o_orderkey", X.lenient_date(text).alias("parsed"))


def raw_clicks(spark, folder):
    shout = F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    return T.raw_events(spark, folder).withColumn("event_type", shout).drop("kafka_topic")


@query
def click_normalize(spark, folder):
    return C.normalize_clicks(raw_clicks(spark, folder), TopicPlan())


@query
def topic_fanout(spark, folder):
    normalized = C.normalize_clicks(raw_clicks(spark, folder), TopicPlan())
    as_text = normalized.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return C.fan_out(as_text, TopicPlan())


@query
def event_routing_counts(spark, folder):
    return I.topic_counts(C.normalize_clicks(raw_clicks(spark, folder), TopicPlan()))


@query
def dead_letter_events(spark, folder):
    topics = TopicPlan()
    return C.normalize_clicks(raw_clicks(spark, folder), topics).where(F.col("kafka_topic") == topics.default)


@query
def replay_documents(spark, folder):
    return C.replay_documents(raw_clicks(spark, folder), TopicPlan()).drop("replayed_at")


@query
def replay_progress(spark, folder):
    normalized = C.normalize_clicks(raw_clicks(spark, folder), TopicPlan())
    return progress_of(normalized, "replay", "events").drop("updated_at")


@query
def bronze_dedup(spark, folder):
    events = raw_clicks(spark, folder)
    return U.one_per_key(events.unionByName(events), ["event_id"], ["event_ts"])


@query
def bronze_unseen(spark, folder):
    events = raw_clicks(spark, folder)
    stored = events.where(F.col("event_id") % 4 == 0)
    return U.unseen(U.one_per_key(events, ["event_id"], ["event_ts"]), stored, ["event_id"])


def click_files(spark, folder, files):
    """Events as JSON lines in files that each cover all of the time."""
    path = f"{shared_folder(spark)}/clicks-{uuid.uuid4().hex}"
    text = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    raw_clicks(spark, folder).withColumn("event_ts", text).repartition(files, "event_id").write.json(path)
    return path


def own_table(spark, name):
    """An empty table of events beside the layers."""
    target = f"checks.{name}_{uuid.uuid4().hex}"
    spark.sql("CREATE DATABASE IF NOT EXISTS checks")
    create_table(spark, target, RAW_SCHEMAS["retailrocket_events"])
    return target


@query
def table_reload(spark, folder):
    """A table after a load of half of the events, a load of all, and an empty load that keeps them."""
    events = C.normalize_clicks(raw_clicks(spark, folder), TopicPlan())
    target = own_table(spark, "reload")
    switch_rows(events.where(F.col("event_id") % 2 == 0), target)
    switch_rows(events, target)
    switch_rows(events.where("false"), target, keep_if_empty=True)
    return V.as_times(spark.table(target), "event_ts")


@query
def replay_loaded_twice(spark, folder):
    """The table of a replay whose batches all ran twice."""
    target = own_table(spark, "replay")
    plan = ReplayPlan(click_files(spark, folder, 3), f"{shared_folder(spark)}/replay-{uuid.uuid4().hex}")
    for attempt in ("first", "second"):
        start_replay(spark, plan, table=target, checkpoint=f"{plan.output}/checkpoint-{attempt}").awaitTermination()
    return V.as_times(spark.table(target), "event_ts")


@query
def document_store_inserts(spark, folder):
    """A document store after three loads that overlap."""
    events = raw_clicks(spark, folder).drop("event_ts")
    store = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    for part in (events.where(F.col("event_id") % 3 == 0), events.where(F.col("event_id") % 2 == 0), events.unionByName(events)):
        add_documents(part, store, key="event_id")
    return spark.read.parquet(store).drop("bucket")


# Audit


@query
def audit_state(spark, folder):
    return U.audit_state(T.audit_log(spark, folder))


@query
def latest_audit(spark, folder):
    return U.latest_audit(U.audit_state(T.audit_log(spark, folder)))


@query
def audit_newest(spark, folder):
    return V.list_audit(U.audit_state(T.audit_log(spark, folder)))


@query
def load_counts(spark, folder):
    return with_total(I.table_stats(T.raw_tables(spark, folder)))


# Intermediate relations and marts


@query
def items_per_order(spark, folder):
    return plain(M.items_per_order(G.stage_order_items(T.raw_order_items(spark, folder))))


@query
def payments_per_order(spark, folder):
    return plain(M.payments_per_order(G.stage_order_payments(T.raw_order_payments(spark, folder))))


@query
def fx_by_day(spark, folder):
    return plain(M.fx_by_day(G.stage_fx_rates(T.raw_fx_rates(spark, folder))))


@query
def fx_cross_rate(spark, folder):
    return plain(rounded_rate(M.cross_rates(G.stage_fx_rates(T.raw_fx_rates(spark, folder)))))


@query
def int_orders_with_context(spark, folder):
    return plain(rounded_rate(M.orders_with_context(T.staged(spark, folder))))


@query
def fct_commerce_orders(spark, folder):
    return plain(rounded_rate(orders_mart(spark, folder)))


@query
def orders_without_enrichment(spark, folder):
    raw = T.raw_tables(spark, folder)
    for absent in ("open_meteo_weather", "frankfurter_fx_rates"):
        raw[absent] = empty_table(spark, absent)
    return plain(M.commerce_orders(M.orders_with_context(G.Staging.of(raw))))


@query
def dim_products(spark, folder):
    return plain(products_mart(spark, folder))


@query
def sessions_seconds(spark, folder):
    return S.summarize(S.identified(G.stage_events(T.raw_events(spark, folder))), S.SessionRule.elapsed(30))


@query
def sessions_minute_boundary(spark, folder):
    return sessions_mart(spark, folder)


@query
def sessions_gap_360(spark, folder):
    return S.summarize(S.identified(G.stage_events(T.raw_events(spark, folder))), S.SessionRule.elapsed(360))


def patchy_events(spark, folder):
    """Events of which some have no time and some no visitor."""
    key = F.col("event_id").cast("bigint")
    return G.stage_events(T.raw_events(spark, folder)).withColumns(
        {
            "event_ts": F.when(key % 10 != 3, F.col("event_ts")),
            "visitor_id": F.when(key % 25 != 7, F.col("visitor_id")),
        }
    )


@query
def sessions_patchy_seconds(spark, folder):
    return S.summarize(S.identified(patchy_events(spark, folder)), S.SessionRule.elapsed(30))


@query
def sessions_patchy_minutes(spark, folder):
    return S.summarize(patchy_events(spark, folder), S.SessionRule.minute_marks(30))


@query
def session_events_seconds(spark, folder):
    return plain(S.label_events(G.stage_events(T.raw_events(spark, folder)), S.SessionRule.elapsed(360))).drop("kafka_topic")


@query
def session_events_minutes(spark, folder):
    return plain(S.label_events(G.stage_events(T.raw_events(spark, folder)), S.SessionRule.minute_marks(360))).drop("kafka_topic")


@query
def streaming_sessions_closed(spark, folder):
    """Sessions a stream over the events has closed by its watermark."""
    arriving = (
        spark.readStream.schema(T.table(spark, folder, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )
    events = arriving.select(
        F.col("event_id").cast("string"),
        F.col("user_id").cast("string").alias("visitor_id"),
        F.when(F.col("event_type") == "click", "addtocart")
        .when(F.col("event_type") == "purchase", "transaction")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.get_json_object("props", "$.k").alias("item_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
    )
    target = f"{shared_folder(spark)}/closed-sessions-{uuid.uuid4().hex}"
    write_closed_sessions(session_stream(events), f"{target}/data", f"{target}/progress").awaitTermination()
    return V.as_times(spark.read.parquet(f"{target}/data"), "session_start_ts", "session_end_ts")


@query
def streaming_sessions_all(spark, folder):
    """All sessions of a stream whose files each cover all of the time, so that most events are late."""
    archive = SessionArchive(f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}", buckets=8)
    clicks = click_stream(spark, click_files(spark, folder, 4), files_per_batch=1)
    archive.start(clicks, f"{archive.path}/checkpoint").awaitTermination()
    return archive.sessions(spark).drop("closed")


# Serving reads


@query
def orders_page(spark, folder):
    page = V.list_orders(
        orders_mart(spark, folder),
        status="delivered",
        state="ASIA",
        start=date(1995, 6, 1),
        end=date(2000, 12, 31),
        limit=100,
        offset=50,
    )
    return plain(rounded_rate(page))


@query
def orders_page_keyset(spark, folder):
    page = V.list_orders(orders_mart(spark, folder), category="SMALL", limit=200, after=(date(1999, 6, 1), "5"))
    return plain(rounded_rate(page))


@query
def sessions_page(spark, folder):
    return V.list_sessions(sessions_mart(spark, folder), limit=100, offset=20)


@query
def sessions_page_keyset(spark, folder):
    return V.list_sessions(sessions_mart(spark, folder), after=(datetime(2024, 1, 15), "1-1"))


@query
def products_page(spark, folder):
    return plain(V.list_products(products_mart(spark, folder), source="open_food_facts"))


@query
def weather_page(spark, folder):
    weather = G.stage_weather(T.raw_weather(spark, folder))
    return plain(V.list_weather(weather, city="NATION_3", start=date(1996, 2, 1), end=date(1999, 2, 1)))


@query
def fx_page(spark, folder):
    rates = G.stage_fx_rates(T.raw_fx_rates(spark, folder))
    return plain(V.list_fx_rates(rates, quote_currency="BRL", start=date(1996, 2, 1)))


@query
def order_kpis(spark, folder):
    return V.order_kpis(orders_mart(spark, folder))


@query
def order_kpis_range(spark, folder):
    return V.order_kpis(orders_mart(spark, folder), start=date(1996, 1, 1), end=date(1998, 12, 31))


@query
def session_funnel(spark, folder):
    return V.session_funnel(sessions_mart(spark, folder))


@query
def orders_multi_filter(spark, folder):
    return plain(rounded_rate(V.filter_orders(orders_mart(spark, folder), **CHOSEN)))


@query
def filtered_row_share(spark, folder):
    return V.filtered_share(orders_mart(spark, folder), **CHOSEN)


@query
def filter_options_status(spark, folder):
    return V.filter_options(orders_mart(spark, folder), "order_status")


@query
def filter_options_category(spark, folder):
    return V.filter_options(orders_mart(spark, folder), "product_category_name")


@query
def filter_options_state(spark, folder):
    return V.filter_options(orders_mart(spark, folder), "customer_state")


@query
def filter_options_payment_type(spark, folder):
    return V.filter_options(orders_mart(spark, folder), "payment_type")


@query
def order_date_bounds(spark, folder):
    return V.day_bounds(orders_mart(spark, folder))


@query
def serving_products(spark, folder):
    return plain(V.serving_products(products_mart(spark, folder)))


# Report aggregates


@query
def kpi_block(spark, folder):
    return I.kpi_block(V.filter_orders(orders_mart(spark, folder), **CHOSEN))


@query
def value_counts_status(spark, folder):
    return I.value_counts(orders_mart(spark, folder), "order_status")


@query
def value_counts_payment_type(spark, folder):
    return I.value_counts(orders_mart(spark, folder), "payment_type")


@query
def value_counts_source(spark, folder):
    return I.value_counts(products_mart(spark, folder), "source_system")


@query
def top_product_categories(spark, folder):
    return I.top_counts(products_mart(spark, folder), "category", 15)


@query
def ecoscore_by_grade(spark, folder):
    return I.counts_by_value(products_mart(spark, folder), "ecoscore_grade")


@query
def trend_day(spark, folder):
    return I.order_trend(orders_mart(spark, folder), "day")


@query
def trend_week(spark, folder):
    return I.order_trend(orders_mart(spark, folder), "week")


@query
def trend_month(spark, folder):
    return I.order_trend(orders_mart(spark, folder), "month")


@query
def trend_category(spark, folder):
    return I.category_trend(orders_mart(spark, folder), "month")


@query
def category_state_long(spark, folder):
    return I.category_state_long(orders_mart(spark, folder))


@query
def category_state_matrix(spark, folder):
    """The regions of the test tables take the place of states."""
    return I.category_state_matrix(orders_mart(spark, folder), ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])


@query
def top_categories(spark, folder):
    return I.top_categories(orders_mart(spark, folder))


@query
def top_states(spark, folder):
    return I.top_states(orders_mart(spark, folder))


@query
def commerce_insights(spark, folder):
    return I.commerce_insights(orders_mart(spark, folder))


@query
def session_insights(spark, folder):
    return I.session_insights(sessions_mart(spark, folder))


@query
def session_metrics(spark, folder):
    return I.session_metrics(sessions_mart(spark, folder))


@query
def session_funnel_long(spark, folder):
    return plain(I.funnel_steps(sessions_mart(spark, folder)))


@query
def event_histogram(spark, folder):
    events = S.identified(G.stage_events(T.raw_events(spark, folder)))
    return I.event_histogram(S.summarize(events, S.SessionRule.elapsed(360)))


@query
def product_metrics(spark, folder):
    return I.product_metrics(products_mart(spark, folder))


@query
def table_stats(spark, folder):
    staging = T.staged(spark, folder)
    return plain(
        I.table_stats(
            {
                "fct_commerce_orders": orders_mart(spark, folder),
                "fct_retailrocket_sessions": sessions_mart(spark, folder),
                "dim_products": products_mart(spark, folder),
                "open_meteo_weather": staging.weather,
                "frankfurter_fx_rates": staging.fx_rates,
            }
        )
    )


@query
def weather_series(spark, folder):
    return plain(I.weather_series(G.stage_weather(T.raw_weather(spark, folder))))


@query
def fx_series(spark, folder):
    return plain(I.fx_series(G.stage_fx_rates(T.raw_fx_rates(spark, folder))))


@query
def temperature_vs_value(spark, folder):
    return plain(I.temperature_vs_value(orders_mart(spark, folder)))


# Data quality


@query
def dq_null_rows(spark, folder):
    return Q.null_rows(orders_mart(spark, folder), "payment_type").select("order_id", "payment_type")


@query
def dq_duplicates(spark, folder):
    items = G.stage_order_items(T.raw_order_items(spark, folder))
    return Q.duplicate_keys(items.select(F.concat_ws("-", "order_id", "order_item_id").alias("item_key")), "item_key")


@query
def dq_duplicate_orders(spark, folder):
    return Q.duplicate_keys(orders_mart(spark, folder), "order_id")


@query
def dq_event_domain(spark, folder):
    return Q.outside_domain(G.stage_events(T.raw_events(spark, folder)), "event_type", ["view", "addtocart", "transaction"])


@query
def dq_status_domain(spark, folder):
    """Shipped orders take the place of a status outside the domain."""
    domain = [status for status in WAREHOUSE_STATUSES if status != "shipped"]
    return Q.outside_domain(G.stage_orders(T.raw_orders(spark, folder)), "order_status", domain).select("order_id", "order_status")


@query
def dq_not_positive(spark, folder):
    return Q.not_positive(T.table(spark, folder, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query
def dq_fx_positive(spark, folder):
    return plain(Q.not_positive(G.stage_fx_rates(T.raw_fx_rates(spark, folder)), "fx_rate"))


@query
def dq_blank_rows(spark, folder):
    key = F.col("p_partkey")
    named = T.table(spark, folder, "part").select(
        key.cast("string").alias("product_code"),
        F.when(key % 8 == 0, "   ").when(key % 8 != 1, F.col("p_name")).alias("product_name"),
    )
    return Q.blank_rows(named, "product_code", "product_name")


def suite_tables(spark, folder):
    raw = T.raw_tables(spark, folder)
    return {
        "raw.olist_orders": raw["olist_orders"],
        "raw.retailrocket_events": raw["retailrocket_events"],
        "raw.frankfurter_fx_rates": raw["frankfurter_fx_rates"],
        "raw.open_meteo_weather": raw["open_meteo_weather"],
        "marts.fct_commerce_orders": orders_mart(spark, folder),
    }


@query
def dq_suite(spark, folder):
    return Q.check_suite(spark, suite_tables(spark, folder))


@query
def dq_suite_skips(spark, folder):
    """The suite with one table absent."""
    return Q.check_suite(spark, suite_tables(spark, folder) | {"raw.open_meteo_weather": None})


@query
def dq_suite_unreadable(spark, folder):
    """The suite with a table that lacks a checked column: its checks are skipped, the others run."""
    tables = suite_tables(spark, folder)
    weather = tables["raw.open_meteo_weather"].select(F.lit(1).alias("other"))
    return Q.run_suite(spark, tables | {"raw.open_meteo_weather": weather}).drop("error")


@query
def dq_summary(spark, folder):
    return Q.summarize_results(Q.check_suite(spark, suite_tables(spark, folder)))


@query
def dq_model_tests(spark, folder):
    staging = T.staged(spark, folder)
    context = M.orders_with_context(staging)
    sessions = M.click_sessions(staging.events)
    models = {
        **staging.named(),
        "int_orders_with_context": context,
        "int_retailrocket_sessions": sessions,
        "fct_commerce_orders": M.commerce_orders(context),
        "fct_retailrocket_sessions": sessions,
        "dim_products": M.product_dimension(staging.products, staging.food_products),
    }
    return Q.check_suite(spark, models, Q.MODEL_TESTS)
