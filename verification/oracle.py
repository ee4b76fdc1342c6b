"""SQL giving the expected result of each query, for an engine other than Spark."""

from __future__ import annotations

import re

# Shared relations, each only on the tables and the relations before it.
RELATIONS = {
    "s_orders": """
        select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
                                  when 'P' then 'processing' else o_orderstatus end as order_status,
               o_orderdate as order_purchase_ts,
               o_orderdate + interval 12 hour as order_approved_ts,
               o_orderdate + interval 10 day as order_estimated_delivery_ts,
               'olist' as source_system
        from orders""",
    "s_items": """
        select cast(l_orderkey as varchar) as order_id, l_linenumber as order_item_id,
               cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
               cast(l_extendedprice as decimal(12,2)) as item_price,
               cast(round(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)), 2)
                    as decimal(12,2)) as freight_value
        from lineitem""",
    "s_customers": """
        select cast(c_custkey as varchar) as customer_id, n_name as customer_city, r_name as customer_state
        from customer left join nation on c_nationkey = n_nationkey
                      left join region on n_regionkey = r_regionkey""",
    "s_products": """
        select cast(p_partkey as varchar) as product_id, p_type as product_category_name,
               cast(length(p_name) as bigint) as product_name_length,
               cast(length(p_brand) as bigint) as product_description_length,
               cast(1 as bigint) as product_photos_qty, cast(p_size as bigint) as product_weight_g
        from part""",
    "s_payments": """
        select cast(l_orderkey as varchar) as order_id, l_linenumber as payment_sequential,
               l_returnflag as payment_type, 1 as payment_installments,
               cast(l_extendedprice as decimal(12,2)) as payment_value
        from lineitem where l_linestatus = 'F'""",
    "s_events": """
        select *, case event_type when 'view' then 'retailrocket.events.view'
                                  when 'addtocart' then 'retailrocket.events.addtocart'
                                  when 'transaction' then 'retailrocket.events.transaction'
                                  else 'retailrocket.events.dlq' end as kafka_topic
        from (select cast(event_id as varchar) as event_id, cast(user_id as varchar) as visitor_id,
                     case event_type when 'click' then 'addtocart' when 'purchase' then 'transaction'
                                     else event_type end as event_type,
                     json_extract_string(props, '$.k') as item_id,
                     case when event_type = 'purchase' then cast(event_id as varchar) end as transaction_id,
                     ts as event_ts
              from events)""",
    "s_food": """
        select cast(s_suppkey as varchar) as product_id, s_name as product_name,
               'brand-' || s_nationkey as brand, 'category-' || (s_nationkey % 7) as category,
               case s_nationkey % 6 when 0 then 'a' when 1 then 'b' when 2 then 'c' when 3 then 'd'
                                    when 4 then 'e' end as ecoscore_grade,
               '' as image_front_url, timestamp '2024-01-01 00:00:00' as ingested_at
        from supplier""",
    "days": """
        select cast(unnest(generate_series(cast(min(o_orderdate) as timestamp), max(o_orderdate), interval 1 day))
                    as date) as day
        from orders""",
    "s_weather": """
        select day as weather_date, n_name as city,
               cast(18 + day(day) % 10 as decimal(8,2)) as avg_temperature_c,
               cast(day(day) % 6 as decimal(8,2)) as precipitation_mm,
               timestamp '2024-01-01 00:00:00' as ingested_at
        from days, nation""",
    "s_fx": """
        select day as rate_date, 'EUR' as base_currency, quote_currency,
               case quote_currency
                   when 'USD' then cast(cast(110 + day(day) % 5 as decimal(18,8)) / 100 as decimal(18,8))
                   else cast(cast(42 + day(day) % 7 as decimal(18,8)) / 10 as decimal(18,8)) end as fx_rate,
               timestamp '2024-01-01 00:00:00' as ingested_at
        from days, (values ('USD'), ('BRL')) quotes(quote_currency)
        where dayofweek(day) <> 0""",
    "fx_pivot": """
        select rate_date,
               max(case when quote_currency = 'USD' then fx_rate end) as eur_to_usd_fx_rate,
               max(case when quote_currency = 'BRL' then fx_rate end) as eur_to_brl_fx_rate
        from s_fx group by rate_date""",
    # The rate as a whole number of 10^-20, rounded half up.
    "rates": """
        select rate_date, (2 * usd * 100000000000000000000::hugeint + brl) // (2 * brl) as rate20
        from (select rate_date, cast(eur_to_usd_fx_rate * 100000000 as hugeint) as usd,
                     cast(eur_to_brl_fx_rate * 100000000 as hugeint) as brl
              from fx_pivot
              where eur_to_usd_fx_rate is not null and eur_to_brl_fx_rate is not null and eur_to_brl_fx_rate <> 0)""",
    "item_sums": """
        select order_id, count(*) as item_count, sum(item_price) as gross_item_value,
               sum(freight_value) as freight_value, min(product_id) as primary_product_id
        from s_items group by order_id""",
    "payment_sums": """
        select order_id, sum(payment_value) as payment_value_brl, min(payment_type) as payment_type
        from s_payments group by order_id""",
    "context": """
        select o.order_id, o.customer_id, c.customer_city, c.customer_state, o.order_purchase_ts,
               cast(o.order_purchase_ts as date) as order_date, o.order_status,
               coalesce(i.item_count, 0) as item_count,
               coalesce(i.gross_item_value, 0) as gross_item_value,
               coalesce(i.freight_value, 0) as freight_value,
               coalesce(p.payment_value_brl, i.gross_item_value + i.freight_value, 0) as payment_value_brl,
               p.payment_type, i.primary_product_id as product_id, d.product_category_name,
               d.product_weight_g, w.avg_temperature_c, w.precipitation_mm, r.rate20
        from s_orders o
        left join s_customers c on o.customer_id = c.customer_id
        left join item_sums i on o.order_id = i.order_id
        left join payment_sums p on o.order_id = p.order_id
        left join s_products d on i.primary_product_id = d.product_id
        left join s_weather w on cast(o.order_purchase_ts as date) = w.weather_date and c.customer_city = w.city
        left join rates r on cast(o.order_purchase_ts as date) = r.rate_date""",
    # Cents times the rate is a whole number of 10^-22; USD values have six places.
    "mart": """
        select *, (cents * rate20 + 5000000000000000::hugeint) // 10000000000000000::hugeint as usd_micros
        from (select *, cast(payment_value_brl * 100 as hugeint) as cents from context)""",
    "order_rows": """
        select order_id, customer_id, customer_city, customer_state, order_purchase_ts, order_date, order_status,
               item_count, cast(gross_item_value as double) as gross_item_value,
               cast(freight_value as double) as freight_value,
               cast(payment_value_brl as double) as payment_value_brl,
               cast(usd_micros as double) / 1000000 as payment_value_usd,
               payment_type, product_id, product_category_name, product_weight_g,
               cast(avg_temperature_c as double) as avg_temperature_c,
               cast(precipitation_mm as double) as precipitation_mm,
               round(cast(rate20 as double) / 1e20, 12) as brl_to_usd_fx_rate
        from mart""",
    "chosen": """
        select * from mart
        where order_date between date '1996-01-01' and date '1999-12-31'
          and order_status in ('delivered', 'shipped')
          and product_category_name in ('SMALL', 'MEDIUM', 'ECONOMY')
          and customer_state in ('ASIA', 'EUROPE')""",
    "products": """
        select 'olist:' || product_id as product_key, product_id, cast(null as varchar) as product_name,
               cast(null as varchar) as brand, product_category_name as category,
               cast(null as double) as price_usd, cast(null as varchar) as ecoscore_grade,
               cast(null as varchar) as image_front_url, 'olist' as source_system
        from s_products
        union all
        select 'open_food_facts:' || product_id, product_id, product_name, brand, category, null,
               ecoscore_grade, image_front_url, 'open_food_facts'
        from s_food""",
    "clicks": """
        select event_id, visitor_id,
               case when cast(event_id as bigint) % 3 = 0 then upper(event_type) else event_type end as event_type,
               item_id, transaction_id, event_ts, kafka_topic
        from s_events""",
    "patchy": """
        select event_id, case when cast(event_id as bigint) % 25 <> 7 then visitor_id end as visitor_id,
               event_type, item_id, case when cast(event_id as bigint) % 10 <> 3 then event_ts end as event_ts
        from s_events""",
    "audits": """
        select o_orderpriority as source_name, strftime(o_orderdate, '%Y%m') as batch_id,
               max(o_orderdate) as loaded_at, arg_max(n, o_orderdate) as row_count
        from (select o_orderpriority, o_orderdate, count(*) as n from orders group by 1, 2)
        group by 1, 2""",
    "offers": """
        select case when p_partkey % 11 = 0 then '' else cast(p_partkey as varchar) end as code,
               case when p_partkey % 5 = 0 then '' when p_partkey % 7 = 0 then '  ' else p_name end as product_name,
               case when p_partkey % 3 <> 0 then p_type end as generic_name,
               case when p_partkey % 4 <> 0 then p_brand end as brands,
               case when p_partkey % 6 = 0 then '' else p_type end as categories,
               case when p_partkey % 2 = 0 then 'b' end as ecoscore_grade, p_partkey
        from part where p_partkey % 13 <> 0 and p_partkey % 17 <> 0""",
}


def _labels(source: str, unit: str, gap: int, nulls: str) -> str:
    """Events with previous time, flag, number and key, by windows over whole visitors."""
    return f"""
        select *, visitor_id || '-' || cast(session_number as varchar) as session_key
        from (select *, cast(sum(is_new_session) over (
                         partition by visitor_id order by event_ts nulls {nulls}, event_id
                         rows between unbounded preceding and current row) as bigint) as session_number
              from (select *, case when previous_event_ts is null then 1
                                   when date_diff('{unit}', previous_event_ts, event_ts) > {gap} then 1
                                   else 0 end as is_new_session
                    from (select *, lag(event_ts) over (
                                 partition by visitor_id order by event_ts nulls {nulls}, event_id) as previous_event_ts
                          from {source})))"""


def _sessions(source: str, unit: str, gap: int, nulls: str) -> str:
    return f"""
        select session_key, visitor_id, min(event_ts) as session_start_ts, max(event_ts) as session_end_ts,
               count(*) as event_count,
               cast(sum(case when event_type = 'view' then 1 else 0 end) as bigint) as view_count,
               cast(sum(case when event_type = 'addtocart' then 1 else 0 end) as bigint) as addtocart_count,
               cast(sum(case when event_type = 'transaction' then 1 else 0 end) as bigint) as transaction_count,
               min(item_id) as sample_item_id
        from ({_labels(source, unit, gap, nulls)}) group by session_key, visitor_id"""


RELATIONS["sessions"] = _sessions("s_events", "minute", 30, "last")
RELATIONS["sessions_wide"] = _sessions("s_events", "second", 21600, "first")

KPIS = """
    select count(*) as total_orders, coalesce(cast(sum(payment_value_brl) as double), 0.0) as total_revenue_brl,
           coalesce(cast(sum(usd_micros) as double) / 1000000, 0.0) as total_revenue_usd,
           coalesce(cast(sum(payment_value_brl) as double) / count(payment_value_brl), 0.0) as avg_order_value_brl,
           cast(coalesce(sum(item_count), 0) as bigint) as total_items,
           count(distinct customer_id) as unique_customers,
           coalesce(cast(sum(freight_value) as double) / count(freight_value), 0.0) as avg_freight,
           coalesce(avg(case when order_status = 'delivered' then 1.0::double else 0.0::double end) * 100, 0.0)
               as delivery_rate_pct
    from {source}"""

TREND = """
    select {period} as period, count(order_id) as order_count,
           cast(sum(payment_value_brl) as double) as revenue_brl,
           cast(sum(item_count) as double) / count(item_count) as avg_items
    from mart group by 1"""

CELLS = """
    select product_category_name, customer_state, cast(sum(payment_value_brl) as double) as revenue_brl
    from mart where product_category_name is not null and customer_state is not null group by 1, 2"""

EVENT_COLUMNS = "event_id, visitor_id, lower(event_type) as event_type, item_id, transaction_id, event_ts, kafka_topic"


def _counts(source: str, column: str) -> str:
    return f"select {column}, count(*) as row_count from {source} where {column} is not null group by 1"


def _options(column: str) -> str:
    return f"select distinct {column} from mart where {column} is not null"


def _state_cell(state: str) -> str:
    return f"""coalesce(cast(sum(case when customer_state = '{state}' then payment_value_brl end) as double), 0.0)
               as "{state}" """


def _check(table: str, kind: str, column: str | None, failures: str, source: str) -> str:
    named = f"'{column}'" if column else "cast(null as varchar)"
    return f"""select '{table}' as table_name, '{kind}' as expectation, {named} as column_name,
               case when n > 0 then 'failed' else 'passed' end as status, n as failures
               from (select cast({failures} as bigint) as n from {source})"""


def _not_null(table: str, column: str, source: str, actual: str | None = None) -> str:
    return _check(table, "not_null", column, f"count(*) filter (where {actual or column} is null)", source)


def _unique(table: str, column: str, source: str, actual: str | None = None) -> str:
    key = actual or column
    return _check(
        table, "unique", column, "coalesce(sum(c), 0)",
        f"(select count(*) as c from {source} where {key} is not null group by {key} having count(*) > 1)",
    )


def _in_set(table: str, column: str, values: str, source: str) -> str:
    return _check(table, "accepted_values", column, f"count(*) filter (where {column} not in ({values}))", source)


def _filled(table: str, source: str) -> str:
    return _check(table, "row_count_above", None, "case when count(*) > 0 then 0 else 1 end", source)


def _skipped(table: str, kind: str, column: str | None) -> str:
    named = f"'{column}'" if column else "cast(null as varchar)"
    return f"""select '{table}' as table_name, '{kind}' as expectation, {named} as column_name,
               'skipped' as status, cast(0 as bigint) as failures"""


SUITE_BUT_WEATHER = "\nunion all\n".join(
    [
        _not_null("raw.olist_orders", "order_id", "s_orders"),
        _unique("raw.olist_orders", "order_id", "s_orders"),
        _not_null("raw.olist_orders", "order_purchase_timestamp", "s_orders", "order_purchase_ts"),
        _in_set(
            "raw.olist_orders", "order_status",
            "'delivered','shipped','processing','invoiced','approved','created','canceled','unavailable'", "s_orders",
        ),
        _not_null("raw.retailrocket_events", "event_id", "s_events"),
        _not_null("raw.retailrocket_events", "visitor_id", "s_events"),
        _in_set("raw.retailrocket_events", "event_type", "'view','addtocart','transaction'", "s_events"),
        _filled("raw.retailrocket_events", "s_events"),
        _not_null("raw.frankfurter_fx_rates", "rate_date", "s_fx"),
        _not_null("raw.frankfurter_fx_rates", "fx_rate", "s_fx"),
        _filled("raw.frankfurter_fx_rates", "s_fx"),
        _not_null("marts.fct_commerce_orders", "order_id", "mart"),
        _unique("marts.fct_commerce_orders", "order_id", "mart"),
        _not_null("marts.fct_commerce_orders", "customer_id", "mart"),
        _not_null("marts.fct_commerce_orders", "payment_value_brl", "mart"),
        _filled("marts.fct_commerce_orders", "mart"),
    ]
)
SUITE = "\nunion all\n".join(
    [
        SUITE_BUT_WEATHER,
        _not_null("raw.open_meteo_weather", "weather_date", "s_weather"),
        _not_null("raw.open_meteo_weather", "city", "s_weather"),
        _filled("raw.open_meteo_weather", "s_weather"),
    ]
)
SUITE_SKIPS = "\nunion all\n".join(
    [
        SUITE_BUT_WEATHER,
        _skipped("raw.open_meteo_weather", "not_null", "weather_date"),
        _skipped("raw.open_meteo_weather", "not_null", "city"),
        _skipped("raw.open_meteo_weather", "row_count_above", None),
    ]
)

MODELS = {
    "stg_olist_orders": ("s_orders", "order_id!", "customer_id", "order_status"),
    "stg_olist_order_items": ("s_items", "order_id", "order_item_id"),
    "stg_olist_customers": ("s_customers", "customer_id!"),
    "stg_olist_products": ("s_products", "product_id!"),
    "stg_olist_order_payments": ("s_payments", "order_id"),
    "stg_retailrocket_events": ("s_events", "event_id!", "visitor_id", "event_type"),
    "stg_open_food_facts_products": ("s_food", "product_id!"),
    "stg_open_meteo_weather": ("s_weather", "weather_date", "city"),
    "stg_frankfurter_fx_rates": ("s_fx", "rate_date", "quote_currency"),
    "int_orders_with_context": ("context", "order_id!"),
    "int_retailrocket_sessions": ("sessions", "session_key!"),
    "fct_commerce_orders": ("mart", "order_id!", "customer_id"),
    "fct_retailrocket_sessions": ("sessions", "session_key!"),
    "dim_products": ("products", "product_key!", "product_id"),
}
MODEL_TESTS = "\nunion all\n".join(
    check
    for model, (source, *columns) in MODELS.items()
    for column in columns
    for check in (
        [_not_null(model, column.rstrip("!"), source)]
        + ([_unique(model, column.rstrip("!"), source)] if column.endswith("!") else [])
    )
)

QUERIES = {
    "csv_orders": """
        select o_orderkey as order_id, o_custkey as customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' when 'P' then 'processing'
                    else o_orderstatus end as order_status,
               o_orderdate as order_purchase_timestamp
        from orders""",
    "csv_odd_cells": """
        select c_custkey as customer_id,
               case c_custkey % 4 when 0 then c_name || ' "the" 2nd, of' || chr(10) || ' x' when 1 then 'a, ' || c_name
                    else c_name end as customer_city,
               case when c_custkey % 10 <> 3 then c_mktsegment end as customer_state
        from customer""",
    "csv_misfits": """
        select c_custkey || ',' || case c_custkey % 4 when 1 then '"a, ' || c_name || '"' else c_name end
               || case c_custkey % 10 when 7 then ',' || c_mktsegment || ',more' else '' end as misfit_record
        from customer where c_custkey % 10 in (3, 7)""",
    "manifest_counts": """
        select 'olist_orders' as table_name, count(*) as record_count, 0::bigint as misfit_count from orders
        union all select 'olist_products', count(*), 0 from part
        union all select 'olist_order_payments', count(*), 0 from lineitem where l_linestatus = 'F'""",
    "stg_orders": "select * from s_orders",
    "stg_order_items": """
        select order_id, cast(order_item_id as bigint) as order_item_id, product_id, seller_id,
               cast(item_price as double) as item_price, cast(freight_value as double) as freight_value
        from s_items""",
    "stg_customers": "select * from s_customers",
    "stg_products": "select * from s_products",
    "stg_order_payments": """
        select order_id, cast(payment_sequential as bigint) as payment_sequential, payment_type,
               cast(payment_installments as bigint) as payment_installments,
               cast(payment_value as double) as payment_value
        from s_payments""",
    "stg_events": "select * from s_events",
    "stg_food_products": "select * from s_food",
    "weather_spine": """
        select weather_date, city, cast(avg_temperature_c as double) as avg_temperature_c,
               cast(precipitation_mm as double) as precipitation_mm, ingested_at
        from s_weather""",
    "fx_spine": """
        select rate_date, base_currency, quote_currency, cast(fx_rate as double) as fx_rate, ingested_at
        from s_fx""",
    "product_payload_normalize": """
        select code as product_code,
               coalesce(nullif(trim(coalesce(nullif(product_name, ''), nullif(generic_name, ''), '')), ''), 'unknown')
                   as product_name,
               coalesce(nullif(brands, ''), 'unknown') as brands,
               coalesce(nullif(categories, ''), 'unknown') as categories, '' as image_front_url,
               coalesce(ecoscore_grade, 'unknown') as ecoscore_grade,
               timestamp '2024-01-01 00:00:00' as ingested_at
        from offers where code <> ''""",
    "bronze_envelope": """
        select code as product_code, 'open-food-facts-20240101T000000' as batch_id,
               timestamp '2024-01-01 00:00:00' as ingested_at,
               '{"status":1,"product":{"code":" ' || code || '","product_name":"' || product_name || '","generic_name":'
               || coalesce('"' || generic_name || '"', 'null') || ',"brands":' || coalesce('"' || brands || '"', 'null')
               || ',"categories":"' || categories || '","image_front_url":null,"ecoscore_grade":'
               || coalesce('"' || ecoscore_grade || '"', 'null') || '}}' as payload,
               'open_food_facts' as source_system, false as fallback
        from offers where code <> ''""",
    "fx_payload_normalize": """
        select cast(o_orderdate as date) as rate_date, 'EUR' as base_currency, quote_currency,
               cast(case quote_currency when 'USD' then o_orderkey % 5 else o_orderkey % 9 + 1 end as double) as fx_rate,
               timestamp '2024-01-01 00:00:00' as ingested_at
        from orders, (values ('USD'), ('BRL')) quotes(quote_currency)
        where o_orderkey % 11 <> 0 and o_orderkey % 7 <> 0 and o_orderkey % 13 <> 0""",
    "weather_payload_reshape": """
        select case when o_orderkey % 10 <> 0 then cast(o_orderdate as date) + place end as weather_date,
               o_orderpriority as city,
               case when place + 1 <= o_orderkey % 4 + 1 then cast(place + 1 as double) end as avg_temperature_c,
               case when place = 0 then cast(0.25 as double) end as precipitation_mm,
               timestamp '2024-01-01 00:00:00' as ingested_at
        from orders, (values (0), (1)) places(place)
        where place = 0 or o_orderkey % 10 <> 0""",
    "lenient_dates": """
        select o_orderkey, case when o_orderkey % 9 <> 0 then cast(o_orderdate as date) end as parsed from orders""",
    "click_normalize": f"select {EVENT_COLUMNS} from clicks",
    "topic_fanout": """
        select topic, event_id as key,
               '{"event_id":"' || event_id || '","visitor_id":"' || visitor_id || '","event_type":"' || lower(event_type)
               || '","item_id":' || coalesce('"' || item_id || '"', 'null')
               || ',"transaction_id":' || coalesce('"' || transaction_id || '"', 'null')
               || ',"event_ts":"' || strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f')
               || '","kafka_topic":"' || kafka_topic || '"}' as value
        from (select *, 'retailrocket.events.raw' as topic from clicks
              union all select *, kafka_topic from clicks)""",
    "event_routing_counts": "select kafka_topic, count(*) as row_count from clicks group by 1",
    "dead_letter_events": f"select {EVENT_COLUMNS} from clicks where kafka_topic = 'retailrocket.events.dlq'",
    "replay_documents": """
        select cast(event_id as bigint) as event_id, cast(visitor_id as bigint) as visitor_id, event_type, item_id,
               cast(transaction_id as bigint) as transaction_id, event_ts, kafka_topic as normalized_topic
        from clicks""",
    "replay_progress": """
        select 'replay' as mode, 'events' as replay_source, count(*) as record_count, max(event_ts) as last_event_ts
        from clicks""",
    "bronze_dedup": """
        select cast(event_id as bigint) as event_id, cast(visitor_id as bigint) as visitor_id, event_type, item_id,
               cast(transaction_id as bigint) as transaction_id, event_ts
        from clicks""",
    "bronze_unseen": """
        select cast(event_id as bigint) as event_id, cast(visitor_id as bigint) as visitor_id, event_type, item_id,
               cast(transaction_id as bigint) as transaction_id, event_ts
        from clicks where cast(event_id as bigint) % 4 <> 0""",
    "table_reload": f"select {EVENT_COLUMNS} from clicks",
    "replay_loaded_twice": f"select {EVENT_COLUMNS} from clicks",
    "document_store_inserts": """
        select cast(event_id as bigint) as event_id, cast(visitor_id as bigint) as visitor_id, event_type, item_id,
               cast(transaction_id as bigint) as transaction_id
        from clicks""",
    "audit_state": "select * from audits",
    "latest_audit": """
        select source_name, batch_id, loaded_at, row_count from audits
        qualify row_number() over (partition by source_name order by loaded_at desc, batch_id desc) = 1""",
    "audit_newest": """
        select source_name, batch_id, row_count, loaded_at from audits
        order by loaded_at desc, source_name, batch_id limit 50""",
    "load_counts": """
        select coalesce(table_name, 'total') as table_name, cast(sum(n) as bigint) as row_count
        from (select 'olist_orders' as table_name, count(*) as n from s_orders
              union all select 'olist_order_items', count(*) from s_items
              union all select 'olist_customers', count(*) from s_customers
              union all select 'olist_products', count(*) from s_products
              union all select 'olist_order_payments', count(*) from s_payments
              union all select 'retailrocket_events', count(*) from s_events
              union all select 'open_food_facts_products', count(*) from s_food
              union all select 'open_meteo_weather', count(*) from s_weather
              union all select 'frankfurter_fx_rates', count(*) from s_fx)
        group by rollup (table_name)""",
    "items_per_order": """
        select order_id, item_count, cast(gross_item_value as double) as gross_item_value,
               cast(freight_value as double) as freight_value, primary_product_id
        from item_sums""",
    "payments_per_order": """
        select order_id, cast(payment_value_brl as double) as payment_value_brl, payment_type from payment_sums""",
    "fx_by_day": """
        select rate_date, cast(eur_to_usd_fx_rate as double) as eur_to_usd_fx_rate,
               cast(eur_to_brl_fx_rate as double) as eur_to_brl_fx_rate
        from fx_pivot""",
    "fx_cross_rate": "select rate_date, round(cast(rate20 as double) / 1e20, 12) as brl_to_usd_fx_rate from rates",
    "int_orders_with_context": "select * exclude (payment_value_usd) from order_rows",
    "fct_commerce_orders": "select * from order_rows",
    "orders_without_enrichment": """
        select * replace (cast(null as double) as payment_value_usd, cast(null as double) as avg_temperature_c,
                          cast(null as double) as precipitation_mm, cast(null as double) as brl_to_usd_fx_rate)
        from order_rows""",
    "dim_products": "select * from products",
    "sessions_seconds": _sessions("s_events", "second", 1800, "first"),
    "sessions_minute_boundary": "select * from sessions",
    "sessions_gap_360": "select * from sessions_wide",
    "sessions_patchy_seconds": _sessions("(select * from patchy where visitor_id is not null)", "second", 1800, "first"),
    "sessions_patchy_minutes": _sessions("patchy", "minute", 30, "last"),
    "session_events_seconds": f"""
        select event_id, visitor_id, event_type, item_id, transaction_id, event_ts, previous_event_ts,
               cast(is_new_session as bigint) as is_new_session, session_number, session_key
        from ({_labels("s_events", "second", 21600, "first")})""",
    "session_events_minutes": f"""
        select event_id, visitor_id, event_type, item_id, transaction_id, event_ts, previous_event_ts,
               cast(is_new_session as bigint) as is_new_session, session_number, session_key
        from ({_labels("s_events", "minute", 360, "last")})""",
    "streaming_sessions_closed": f"""
        select visitor_id, session_start_ts, session_end_ts, event_count, view_count, addtocart_count,
               transaction_count, sample_item_id
        from ({_sessions("s_events", "second", 1800, "first")})
        where date_trunc('second', session_end_ts) + interval 30 minute
              <= (select date_trunc('second', max(event_ts)) - interval 1 hour from s_events)""",
    "streaming_sessions_all": _sessions("s_events", "second", 1800, "first"),
    "orders_page": """
        select * from order_rows
        where order_status = 'delivered' and customer_state = 'ASIA'
          and order_date between date '1995-06-01' and date '2000-12-31'
        order by order_date desc nulls last, order_id limit 100 offset 50""",
    "orders_page_keyset": """
        select * from order_rows
        where product_category_name = 'SMALL'
          and (order_date < date '1999-06-01' or (order_date = date '1999-06-01' and order_id > '5'))
        order by order_date desc nulls last, order_id limit 200""",
    "sessions_page": """
        select * from sessions order by session_start_ts desc nulls last, session_key limit 100 offset 20""",
    "sessions_page_keyset": """
        select * from sessions
        where session_start_ts < timestamp '2024-01-15'
           or (session_start_ts = timestamp '2024-01-15' and session_key > '1-1')
        order by session_start_ts desc nulls last, session_key limit 100""",
    "products_page": """
        select * from products where source_system = 'open_food_facts' order by product_key limit 200""",
    "weather_page": """
        select weather_date, city, cast(avg_temperature_c as double) as avg_temperature_c,
               cast(precipitation_mm as double) as precipitation_mm, ingested_at
        from s_weather
        where city = 'NATION_3' and weather_date between date '1996-02-01' and date '1999-02-01'
        order by weather_date, city limit 500""",
    "fx_page": """
        select rate_date, base_currency, quote_currency, cast(fx_rate as double) as fx_rate, ingested_at
        from s_fx where quote_currency = 'BRL' and rate_date >= date '1996-02-01'
        order by rate_date, quote_currency limit 500""",
    "order_kpis": KPIS.format(source="mart"),
    "order_kpis_range": KPIS.format(
        source="(select * from mart where order_date between date '1996-01-01' and date '1998-12-31')"
    ),
    "session_funnel": """
        select count(*) as total_sessions, cast(coalesce(sum(view_count), 0) as bigint) as total_views,
               cast(coalesce(sum(addtocart_count), 0) as bigint) as total_addtocart,
               cast(coalesce(sum(transaction_count), 0) as bigint) as total_transactions,
               coalesce(avg(case when transaction_count > 0 then 1.0::double else 0.0::double end) * 100, 0.0)
                   as conversion_rate_pct
        from sessions""",
    "orders_multi_filter": "select * from order_rows where order_id in (select order_id from chosen)",
    "filtered_row_share": """
        select (select count(*) from chosen) as filtered_rows, (select count(*) from mart) as total_rows""",
    "filter_options_status": _options("order_status"),
    "filter_options_category": _options("product_category_name"),
    "filter_options_state": _options("customer_state"),
    "filter_options_payment_type": _options("payment_type"),
    "order_date_bounds": "select min(order_date) as min_date, max(order_date) as max_date from mart",
    "serving_products": "select *, category as product_category_name from products",
    "kpi_block": KPIS.format(source="chosen"),
    "value_counts_status": _counts("mart", "order_status"),
    "value_counts_payment_type": _counts("mart", "payment_type"),
    "value_counts_source": _counts("products", "source_system"),
    "top_product_categories": _counts("products", "category") + " order by row_count desc, category limit 15",
    "ecoscore_by_grade": _counts("products", "ecoscore_grade"),
    "trend_day": TREND.format(period="order_date"),
    "trend_week": TREND.format(period="cast(date_trunc('week', order_date) as date)"),
    "trend_month": TREND.format(period="cast(date_trunc('month', order_date) as date)"),
    "trend_category": """
        select cast(date_trunc('month', order_date) as date) as period, product_category_name,
               cast(sum(payment_value_brl) as double) as revenue_brl
        from mart where product_category_name is not null group by 1, 2""",
    "category_state_long": CELLS,
    "category_state_matrix": f"""
        select product_category_name,
               {", ".join(_state_cell(state) for state in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))}
        from mart where product_category_name is not null and customer_state is not null group by 1""",
    "top_categories": """
        select product_category_name, cast(sum(payment_value_brl) as double) as revenue_brl
        from mart where product_category_name is not null group by 1
        order by 2 desc, 1 limit 10""",
    "top_states": """
        select customer_state, count(order_id) as order_count from mart where customer_state is not null group by 1
        order by 2 desc, 1 limit 10""",
    "commerce_insights": """
        select c.product_category_name as top_category, cast(c.v as double) as top_category_revenue_brl,
               s.customer_state as top_state, s.n as top_state_orders,
               (select count(*) filter (where order_status = 'delivered') / count(*) * 100 from mart) as delivered_pct
        from (select product_category_name, sum(payment_value_brl) as v from mart
              where product_category_name is not null group by 1 order by 2 desc, 1 limit 1) c,
             (select customer_state, count(*) as n from mart
              where customer_state is not null group by 1 order by 2 desc, 1 limit 1) s""",
    "session_insights": """
        select (select count(*) filter (where transaction_count > 0) / count(*) * 100 from sessions)
                   as conversion_rate_pct,
               (select cast(sum(event_count) as double) / count(*) from sessions) as avg_events,
               (select sample_item_id from sessions where sample_item_id is not null
                group by 1 order by count(*) desc, 1 limit 1) as top_sample_item_id""",
    "session_metrics": """
        select count(*) as session_count, count(distinct visitor_id) as unique_visitors,
               cast(sum(event_count) as double) / count(*) as avg_events,
               avg(case when transaction_count > 0 then 1.0::double else 0.0::double end) * 100 as conversion_rate_pct
        from sessions""",
    "session_funnel_long": """
        select cast(step as bigint) as step, event_type, total, total / first_total * 100 as pct_of_first
        from (select cast(sum(view_count) as bigint) as v, cast(sum(addtocart_count) as bigint) as a,
                     cast(sum(transaction_count) as bigint) as t from sessions) x,
             lateral (values (1, 'Views', x.v, x.v), (2, 'Add to Cart', x.a, x.v), (3, 'Transactions', x.t, x.v))
                 steps(step, event_type, total, first_total)""",
    "event_histogram": """
        select bins.bin, coalesce(counted.n, 0) as session_count
        from (select unnest(generate_series(1, 20)) as bin) bins
        left join (
            select cast(floor((event_count - lo) / cast(hi + 1 - lo as double) * 20) as bigint) + 1 as bin,
                   count(*) as n
            from sessions_wide, (select min(event_count) as lo, max(event_count) as hi from sessions_wide)
            group by 1) counted on bins.bin = counted.bin""",
    "product_metrics": """
        select count(*) as total_products, count(distinct source_system) as source_count from products""",
    "table_stats": """
        select 'fct_commerce_orders' as table_name, count(*) as row_count, cast(19 as bigint) as column_count from mart
        union all select 'fct_retailrocket_sessions', count(*), 9 from sessions
        union all select 'dim_products', count(*), 9 from products
        union all select 'open_meteo_weather', count(*), 5 from s_weather
        union all select 'frankfurter_fx_rates', count(*), 5 from s_fx""",
    "weather_series": """
        select weather_date, city, cast(avg_temperature_c as double) as avg_temperature_c,
               cast(precipitation_mm as double) as precipitation_mm
        from s_weather""",
    "fx_series": "select rate_date, quote_currency, cast(fx_rate as double) as fx_rate from s_fx",
    "temperature_vs_value": """
        select order_id, customer_state, avg_temperature_c, payment_value_brl from order_rows
        where avg_temperature_c is not null and payment_value_brl is not null""",
    "dq_null_rows": "select order_id, payment_type from mart where payment_type is null",
    "dq_duplicates": """
        select order_id || '-' || cast(order_item_id as varchar) as item_key, count(*) as duplicate_count
        from s_items group by 1 having count(*) > 1""",
    "dq_duplicate_orders": """
        select order_id, count(*) as duplicate_count from mart group by 1 having count(*) > 1""",
    "dq_event_domain": """
        select * from s_events where lower(event_type) not in ('view', 'addtocart', 'transaction')""",
    "dq_status_domain": """
        select order_id, order_status from s_orders
        where lower(order_status) not in ('delivered', 'processing', 'invoiced', 'approved')""",
    "dq_not_positive": "select c_custkey, c_acctbal from customer where c_acctbal <= 0",
    "dq_fx_positive": """
        select rate_date, base_currency, quote_currency, cast(fx_rate as double) as fx_rate, ingested_at
        from s_fx where fx_rate <= 0""",
    "dq_blank_rows": """
        select product_code, product_name
        from (select cast(p_partkey as varchar) as product_code,
                     case when p_partkey % 8 = 0 then '   ' when p_partkey % 8 <> 1 then p_name end as product_name
              from part)
        where product_code is null or nullif(trim(product_code), '') is null
           or product_name is null or nullif(trim(product_name), '') is null""",
    "dq_suite": SUITE,
    "dq_suite_skips": SUITE_SKIPS,
    "dq_suite_unreadable": SUITE_SKIPS,
    "dq_summary": f"""
        select count(*) filter (where status = 'passed') as passed, count(*) filter (where status = 'failed') as failed,
               count(*) filter (where status = 'skipped') as skipped
        from ({SUITE})""",
    "dq_model_tests": MODEL_TESTS,
}


def with_relations(sql: str) -> str:
    """Put the shared relations a query needs in front of it."""
    def used(text: str) -> set[str]:
        words = set(re.findall(r"\w+", text))
        return {name for name in RELATIONS if name in words and re.search(rf"\b(from|join|,)\s*\(*\s*{name}\b", text)}

    needed: set[str] = set()
    open_names = used(sql)
    while open_names:
        name = open_names.pop()
        needed.add(name)
        open_names |= used(RELATIONS[name]) - needed
    if not needed:
        return sql.strip()
    parts = [f"{name} as ({RELATIONS[name]})" for name in RELATIONS if name in needed]
    return "with " + ",\n".join(parts) + "\n" + sql.strip()


def all_sql() -> dict[str, str]:
    return {name: with_relations(sql) for name, sql in QUERIES.items()}
