"""The warehouse in DuckDB SQL: an independent statement of every relation.

``RELATIONS`` maps a relation to its SELECT over the given tables or over other
relations; ``sql`` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

RAW = {
    "raw_customers": """
        select c_custkey as customer_id, '  ' || c_name || ' ' as full_name,
               case when c_custkey % 89 = 3 then '   ' when c_custkey % 97 = 5 then c_name
                    else ' ' || lower(c_name) || '@mail.test' end as email,
               case when c_custkey % 3 = 0 then ' ' else '+' || c_custkey end as phone,
               case when c_custkey % 10 = 7 then 'unknown'
                    else printf('2019-%02d-%02d 10:30:00', c_custkey % 12 + 1, c_custkey % 28 + 1) end as created_at
        from customer""",
    "raw_customer_addresses": """
        select c_custkey * 2 + i as address_id, c_custkey as customer_id,
               case when i = 0 then ' home ' when c_custkey % 50 = 9 then 'depot'
                    when c_custkey % 3 = 0 then 'Work' else 'other' end as label,
               c_custkey || ' High St' as line_1, case when i = 0 then '' else ' Unit 2' end as line_2,
               ' City ' || c_nationkey as city,
               case when c_nationkey % 2 = 0 then 'S' || c_nationkey else ' ' end as state,
               'Country ' || c_nationkey as country, printf('%05d', c_custkey % 10000) as postal_code,
               c_nationkey || '.1234567' as latitude, '-' || (c_custkey % 180) || '.5' as longitude,
               i = 0 or c_custkey % 61 = 0 as is_default, '2019-01-01 00:00:00' as created_at
        from customer, range(2) as copies(i)""",
    "raw_restaurant_brands": """
        select n_nationkey as brand_id, n_name || ' ' as brand_name,
               case when n_regionkey = 3 then 'false' else 'true' end as is_active,
               '2018-01-01 00:00:00' as created_at
        from nation""",
    "raw_restaurant_outlets": """
        select s_suppkey as restaurant_id, case when s_suppkey % 40 = 39 then 999 else s_nationkey end as brand_id,
               ' ' || s_name as outlet_name, 'City ' || (s_nationkey % 7) as city,
               'Z' || (s_suppkey % 10) as delivery_zone,
               case when s_suppkey % 4 = 0 then '' else s_suppkey || ' Main Rd' end as address_line1,
               printf('%05d', s_suppkey % 10000) as postal_code, s_acctbal >= 0 as is_active,
               '2018-06-01 00:00:00' as created_at
        from supplier""",
    "raw_menu_items": """
        select p_partkey as menu_item_id, p_partkey // 20 as restaurant_id,
               ' ' || p_name || ' ' || p_partkey as item_name, p_type || '  ' as category,
               p_retailprice as price, p_size > 5 as is_available, '2018-07-01 00:00:00' as created_at
        from part""",
    "raw_couriers": """
        select s_suppkey as courier_id, ' City ' || (s_nationkey % 7) as city,
               case s_suppkey % 8 when 0 then ' bike' when 1 then 'Scooter' when 2 then 'CAR '
                    when 3 then 'boat' else 'car' end as vehicle,
               s_acctbal >= 0 as is_active,
               case when s_suppkey % 9 = 4 then '' else '2018-08-01 12:00:00' end as created_at
        from supplier""",
    "raw_currencies": """
        select r_regionkey as currency_id,
               case r_regionkey when 0 then 'aud ' when 1 then ' inr' when 2 then 'usd'
                    else lower(r_name)[1:3] end as currency_code,
               r_name || ' dollar ' as currency_name, r_regionkey < 3 as is_active,
               '2018-01-01 00:00:00' as created_at
        from region""",
    "raw_fx_rates": """
        select cast(event_id as varchar) as fx_rate_id, user_id % 5 as base_currency_id,
               event_id % 6 as quote_currency_id, date_trunc('hour', ts) as rate_ts,
               case when event_id % 50 = 1 then 'n/a' when event_id % 53 = 2 then '0'
                    when event_id % 59 = 3 then '250000'
                    else printf('%d.%04d', event_id % 90 + 1, user_id % 10000) end as rate,
               case when user_id % 2 = 0 then 'SIMULATED' else ' feed' end as source,
               cast(date_trunc('hour', ts) as date) as rate_day
        from events""",
    "raw_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, o_custkey * 2 + o_orderkey % 2 as delivery_address_id,
               o_custkey // 15 as restaurant_id, o_orderdate as order_placed_at,
               case when o_orderkey % 4 <> 0 then o_orderdate + interval 45 minute end as scheduled_delivery,
               o_totalprice as subtotal, o_orderkey % 1000 as tax, o_custkey % 10 as delivery_fee,
               o_orderkey % 7 as discount,
               cast(o_totalprice as decimal(12,2)) + o_orderkey % 1000 + o_custkey % 10 - o_orderkey % 7
                   + case when o_orderkey % 50 = 0 then 1 else 0 end as total_amount,
               case o_orderpriority when '1-URGENT' then ' card' when '2-HIGH' then 'Paypal '
                    when '3-MEDIUM' then 'cash' when '4-NOT SPECIFIED' then 'bank_transfer'
                    else 'voucher' end as payment_method,
               case o_orderstatus when 'F' then 'paid' when 'O' then ' pending' else 'Authorized' end as payment_status,
               case when o_orderkey % 10 <> 0 then o_custkey % 5 end as currency_id,
               cast(o_orderdate as date) as order_day
        from orders""",
    "raw_order_items": """
        select l_orderkey * 10 + l_linenumber as order_item_id, l_orderkey as order_id, l_partkey as menu_item_id,
               l_quantity as quantity,
               cast(floor(round(l_extendedprice * 100) / l_quantity) as decimal(12,0)) * 0.01 as unit_price,
               l_extendedprice as line_total, cast(o_orderdate as date) as order_day
        from lineitem join orders on o_orderkey = l_orderkey""",
    "raw_order_status_events": """
        select event_id, user_id as order_id, if(event_id % 53 = 0 or user_id % 50 = 7, null, ts) as event_ts,
               case when event_id % 101 = 0 then ' ' when event_type = 'signup' then ' placed'
                    when event_type = 'view' then 'Accepted' when event_type = 'click' then 'picked_up'
                    when event_type = 'purchase' then 'DELIVERED ' when event_id % 3 = 0 then 'canceled'
                    when event_id % 3 = 1 then 'prep_start' else ' ready_for_pickup' end as status,
               case event_id % 4 when 0 then 'system' when 1 then 'Restaurant ' when 2 then 'courier'
                    else 'bot' end as actor,
               case when event_id % 2 = 0 then ' ' else ' ' || props end as notes,
               if(event_id % 53 = 0 or user_id % 50 = 7, null, cast(ts as date)) as event_day
        from events""",
    "raw_delivery_assignments": """
        select o_orderkey as order_id, o_custkey // 15 as courier_id,
               o_orderdate + interval 10 minute as assigned_at,
               case when o_orderkey % 6 = 0 then 'soon'
                    else cast(cast(o_orderdate as date) as varchar) || ' 00:20:00' end as pickup_eta,
               case when o_orderkey % 9 <> 0 then o_orderdate + interval 40 minute end as dropoff_eta
        from orders where o_orderstatus = 'F'""",
    "raw_refunds": """
        select cast(l_orderkey * 10 + l_linenumber as varchar) as refund_id, l_orderkey as order_id,
               l_shipdate as refund_ts,
               case l_linenumber % 6 when 0 then 'late_delivery' when 1 then ' missing_item'
                    when 2 then 'wrong_item ' when 3 then 'quality_issue' when 4 then 'Other'
                    else 'goodwill' end as refund_reason,
               case when l_partkey % 100 = 0 then 'tbc'
                    else cast(cast(l_extendedprice as decimal(12,2)) as varchar) end as refund_amount,
               l_suppkey % 6 as currency_id, cast(l_shipdate as date) as refund_day
        from lineitem where l_returnflag = 'R'""",
    "raw_ratings": """
        select doc_id as rating_id, doc_id as order_id, doc_id as customer_id, quality * 4 + 1 as restaurant_rating,
               case when doc_id % 3 <> 0 then toxic * 6 end as courier_rating,
               case when toxic = 1 then ' ' else ' fine ' end as comment,
               case when doc_id % 5 = 0 then 'n/a' else '2024-02-01 08:00:00' end as created_at
        from labels""",
}


def _text(*columns: str) -> str:
    return ", ".join(f"nullif(trim({c}::varchar), '') as {c}" for c in columns)


def _upper(*columns: str) -> str:
    return ", ".join(f"upper(nullif(trim({c}::varchar), '')) as {c}" for c in columns)


def _cast(dtype: str, *columns: str) -> str:
    return ", ".join(f"{c}::{dtype} as {c}" for c in columns)


def _try(dtype: str, *columns: str) -> str:
    return ", ".join(f"try_cast({c} as {dtype}) as {c}" for c in columns)


STAGED = {
    "stg_customers": f"select {_cast('bigint', 'customer_id')}, {_text('full_name', 'email', 'phone')},"
    f" {_try('timestamp', 'created_at')} from raw_customers",
    "stg_customer_addresses": f"select {_cast('bigint', 'address_id', 'customer_id')}, {_upper('label')},"
    f" {_text('line_1', 'line_2', 'city', 'state', 'country', 'postal_code')},"
    f" {_cast('decimal(9,6)', 'latitude', 'longitude')}, {_cast('boolean', 'is_default')},"
    f" {_try('timestamp', 'created_at')} from raw_customer_addresses",
    "stg_restaurant_brands": f"select {_cast('bigint', 'brand_id')}, {_text('brand_name')},"
    f" {_cast('boolean', 'is_active')}, {_try('timestamp', 'created_at')} from raw_restaurant_brands",
    "stg_restaurant_outlets": f"select {_cast('bigint', 'restaurant_id', 'brand_id')},"
    f" {_text('outlet_name', 'city', 'delivery_zone', 'address_line1', 'postal_code')},"
    f" {_cast('boolean', 'is_active')}, {_try('timestamp', 'created_at')} from raw_restaurant_outlets",
    "stg_menu_items": f"select {_cast('bigint', 'menu_item_id', 'restaurant_id')}, {_text('item_name', 'category')},"
    f" price::decimal(10,2) as price_amount, {_cast('boolean', 'is_available')},"
    f" {_try('timestamp', 'created_at')} from raw_menu_items",
    "stg_couriers": f"select {_cast('bigint', 'courier_id')}, {_text('city')}, {_upper('vehicle')},"
    f" {_cast('boolean', 'is_active')}, {_try('timestamp', 'created_at')} from raw_couriers",
    "stg_currencies": f"select {_cast('bigint', 'currency_id')}, {_upper('currency_code')},"
    f" {_text('currency_name')}, {_cast('boolean', 'is_active')}, {_try('timestamp', 'created_at')}"
    " from raw_currencies",
    "stg_fx_rates": f"select {_try('bigint', 'fx_rate_id', 'base_currency_id', 'quote_currency_id')},"
    f" {_try('timestamp', 'rate_ts')}, {_try('decimal(18,8)', 'rate')}, source, rate_day as rate_date_utc"
    " from raw_fx_rates",
    "stg_orders": f"select {_cast('bigint', 'order_id', 'customer_id', 'delivery_address_id', 'restaurant_id')},"
    f" {_cast('timestamp', 'order_placed_at')}, scheduled_delivery::timestamp as scheduled_delivery_at,"
    f" {_cast('decimal(12,2)', 'subtotal', 'tax', 'delivery_fee', 'discount', 'total_amount')},"
    f" {_upper('payment_method', 'payment_status')}, {_cast('bigint', 'currency_id')},"
    " order_day as order_date_utc from raw_orders",
    "stg_order_items": f"select {_cast('bigint', 'order_item_id', 'order_id', 'menu_item_id')},"
    f" {_cast('integer', 'quantity')}, {_cast('decimal(10,2)', 'unit_price')},"
    f" {_cast('decimal(12,2)', 'line_total')}, order_day as order_date_utc from raw_order_items",
    "stg_order_status_events": f"select {_try('bigint', 'event_id', 'order_id')}, {_try('timestamp', 'event_ts')},"
    f" {_upper('status', 'actor')}, {_text('notes')}, event_day as event_date_utc from raw_order_status_events",
    "stg_delivery_assignments": f"select {_cast('bigint', 'order_id', 'courier_id')},"
    f" {_try('timestamp', 'assigned_at', 'pickup_eta', 'dropoff_eta')} from raw_delivery_assignments",
    "stg_refunds": f"select {_try('bigint', 'refund_id', 'order_id')}, {_try('timestamp', 'refund_ts')},"
    f" {_upper('refund_reason')}, {_try('decimal(12,2)', 'refund_amount')}, {_try('bigint', 'currency_id')},"
    " refund_day as refund_date_utc from raw_refunds",
    "stg_ratings": f"select {_cast('bigint', 'rating_id', 'order_id', 'customer_id')},"
    f" {_cast('integer', 'restaurant_rating', 'courier_rating')}, {_text('comment')},"
    f" {_try('timestamp', 'created_at')} from raw_ratings",
}


def _first(column: str, status: str) -> str:
    return f"min(event_ts) filter (status = '{status}') as {column}"


def _minutes(start: str, end: str, name: str) -> str:
    return f"date_diff('minute', {start}, {end}) as {name}"


MODELS = {
    "int_items_rollup": """
        select order_id, sum(line_total)::decimal(22,2) as items_subtotal, sum(quantity)::bigint as items_total_qty,
               count(*) as item_lines, count(distinct menu_item_id) as distinct_menu_items
        from stg_order_items group by order_id""",
    "int_status_rollup": f"""
        select *, delivered_at is not null as is_delivered, canceled_at is not null as is_canceled,
               {_minutes('placed_at', 'accepted_at', 'minutes_to_accept')},
               {_minutes('placed_at', 'picked_up_at', 'minutes_to_pickup')},
               {_minutes('placed_at', 'delivered_at', 'minutes_to_deliver')},
               {_minutes('picked_up_at', 'delivered_at', 'minutes_pickup_to_deliver')}
        from (select order_id, {_first('placed_at', 'PLACED')}, {_first('accepted_at', 'ACCEPTED')},
                     {_first('prep_start_at', 'PREP_START')}, {_first('ready_for_pickup_at', 'READY_FOR_PICKUP')},
                     {_first('picked_up_at', 'PICKED_UP')}, {_first('delivered_at', 'DELIVERED')},
                     {_first('canceled_at', 'CANCELED')},
                     arg_max(status, (event_ts, event_id)) filter (status is not null and event_ts is not null) as latest_status,
                     max(event_ts) as latest_status_at
              from stg_order_status_events group by order_id)""",
    "int_delivery_enriched": "select order_id, courier_id, assigned_at, pickup_eta, dropoff_eta"
    " from stg_delivery_assignments",
    "int_orders_reconciliation": """
        select order_id, subtotal as orders_subtotal, items::decimal(22,2) as items_subtotal,
               (subtotal - items)::decimal(24,2) as subtotal_minus_items,
               tax, delivery_fee, discount, total_amount,
               (items + tax + delivery_fee - discount)::decimal(24,2) as expected_total_from_items,
               (items + tax + delivery_fee - discount - total_amount)::decimal(24,2)
                   as expected_total_minus_total_amount
        from (select o.*, ifnull(r.items_subtotal, 0)::decimal(22,2) as items
              from stg_orders o left join int_items_rollup r using (order_id))""",
    "int_orders_enriched": """
        select o.*, i.* exclude (order_id), s.* exclude (order_id), d.* exclude (order_id),
               r.subtotal_minus_items, r.expected_total_from_items, r.expected_total_minus_total_amount
        from stg_orders o
        left join int_items_rollup i on i.order_id = o.order_id
        left join int_status_rollup s on s.order_id = o.order_id
        left join int_delivery_enriched d on d.order_id = o.order_id
        left join int_orders_reconciliation r on r.order_id = o.order_id""",
    "int_order_items_enriched": """
        select l.* exclude (order_date_utc), o.customer_id, o.restaurant_id, o.currency_id, o.order_placed_at,
               o.order_date_utc, m.item_name, m.category, m.price_amount as menu_price, m.is_available,
               m.restaurant_id = o.restaurant_id as is_menu_item_from_order_restaurant
        from stg_order_items l
        left join stg_orders o on o.order_id = l.order_id
        left join stg_menu_items m on m.menu_item_id = l.menu_item_id""",
    "int_refunds_enriched": """
        select r.*, o.customer_id, o.restaurant_id, o.courier_id, o.order_placed_at, o.order_date_utc,
               o.latest_status, o.delivered_at, o.canceled_at, o.total_amount, o.items_subtotal,
               o.expected_total_minus_total_amount,
               r.refund_amount <= o.total_amount as is_refund_not_exceed_total
        from stg_refunds r left join int_orders_enriched o on o.order_id = r.order_id""",
    "int_menu_items_snapshot_source": "select menu_item_id, restaurant_id, item_name, category from stg_menu_items",
    "int_restaurants_snapshot_source": """
        select o.restaurant_id, o.brand_id, b.brand_name, b.is_active as brand_is_active, o.outlet_name, o.city,
               o.delivery_zone, o.address_line1, o.postal_code, o.is_active
        from stg_restaurant_outlets o left join stg_restaurant_brands b on b.brand_id = o.brand_id""",
    "menu_batches": """
        select timestamp '1996-01-01' as taken, * from int_menu_items_snapshot_source where menu_item_id % 13 <> 1
        union all
        select timestamp '1998-01-01', menu_item_id,
               restaurant_id + (menu_item_id % 11 = 0)::int, item_name,
               case when menu_item_id % 5 = 0 then category || ' 2' else category end
        from int_menu_items_snapshot_source where menu_item_id % 13 <> 1 and menu_item_id % 97 <> 0
        union all
        select timestamp '2000-01-01', menu_item_id,
               restaurant_id + (menu_item_id % 11 = 0)::int, item_name,
               case when menu_item_id % 7 = 0 then null when menu_item_id % 5 = 0 then category || ' 2'
                    else category end
        from int_menu_items_snapshot_source""",
    "restaurant_batches": """
        select timestamp '1996-01-01' as taken, * from int_restaurants_snapshot_source where restaurant_id % 13 <> 1
        union all
        select timestamp '1998-01-01', * replace (brand_id + (restaurant_id % 11 = 0)::int as brand_id,
               case when restaurant_id % 5 = 0 then not is_active else is_active end as is_active)
        from int_restaurants_snapshot_source where restaurant_id % 13 <> 1 and restaurant_id % 97 <> 0
        union all
        select timestamp '2000-01-01', * replace (brand_id + (restaurant_id % 11 = 0)::int as brand_id,
               case when restaurant_id % 7 = 0 then null else city end as city,
               case when restaurant_id % 5 = 0 then not is_active else is_active end as is_active)
        from int_restaurants_snapshot_source""",
}


def _history(batches: str, key: str, check: str) -> str:
    """Versions from stacked batches: keep the first row of a key and those that changed."""
    return f"""
        select * exclude (taken, previous, seen), md5({key} || '|' || taken) as scd_id, taken as updated_at, taken as valid_from,
               lead(taken) over (partition by {key} order by taken) as valid_to
        from (select *, lag(row({check})) over w as previous, row_number() over w as seen
              from {batches} window w as (partition by {key} order by taken))
        where seen = 1 or row({check}) is distinct from previous"""


def _backfill(dimension: str, key: str) -> str:
    return f"""
        select * replace (if(row_number() over (partition by {key} order by valid_from) = 1,
                             timestamp '1900-01-01', valid_from) as valid_from)
        from {dimension}"""


RESTAURANT_CHECK = "brand_name, brand_is_active, outlet_name, city, delivery_zone, address_line1, postal_code, is_active"
SNAPSHOTS = {
    "snap_menu_items": _history("menu_batches", "menu_item_id", "item_name, category"),
    "snap_restaurants": _history("restaurant_batches", "restaurant_id", RESTAURANT_CHECK),
}


def _asof(facts: str, columns: str, dimension: str, key: str, sk: str, current: str) -> str:
    return f"""
        select {columns}, v.{sk}, v.is_current as {current}
        from {facts} f left join {dimension} v
          on v.{key} = f.{key} and f.order_placed_at >= v.valid_from
         and (v.valid_to is null or f.order_placed_at < v.valid_to)"""


GOLD = {
    "dim_customers": "select * from stg_customers",
    "dim_customer_addresses": "select * from stg_customer_addresses",
    "dim_couriers": "select * from stg_couriers",
    "dim_currencies": "select * from stg_currencies",
    "dim_date": """
        select date_utc, year(date_utc)::int as year_utc, month(date_utc)::int as month_utc,
               day(date_utc)::int as day_utc, dayofweek(date_utc)::int as day_of_week,
               weekofyear(date_utc)::int as week_of_year
        from (select order_date_utc as date_utc from stg_orders
              union select event_date_utc from stg_order_status_events
              union select refund_date_utc from stg_refunds
              union select rate_date_utc from stg_fx_rates)
        where date_utc is not null""",
    "dim_restaurants": f"select scd_id as restaurant_sk, restaurant_id, brand_id, {RESTAURANT_CHECK}, valid_from,"
    " valid_to, valid_to is null as is_current from snap_restaurants",
    "dim_menu_items": "select scd_id as menu_item_sk, menu_item_id, restaurant_id, item_name, category, valid_from,"
    " valid_to, valid_to is null as is_current from snap_menu_items",
    "dim_restaurants_backfill": _backfill("dim_restaurants", "restaurant_id"),
    "dim_menu_items_backfill": _backfill("dim_menu_items", "menu_item_id"),
    "fct_orders": _asof(
        "int_orders_enriched",
        "f.*",
        "dim_restaurants_backfill",
        "restaurant_id",
        "restaurant_sk",
        "is_current_restaurant_details",
    ),
    "fct_order_items": _asof(
        "int_order_items_enriched",
        "f.* exclude (item_name, category, menu_price, is_available, is_menu_item_from_order_restaurant)",
        "dim_menu_items_backfill",
        "menu_item_id",
        "menu_item_sk",
        "is_current_menu_item_details",
    ),
    "fct_refunds": """
        select r.refund_id, r.order_id, r.customer_id, r.restaurant_id, o.restaurant_sk, r.currency_id, r.refund_ts,
               r.refund_date_utc, r.refund_reason, r.refund_amount, o.payment_method, o.payment_status,
               i.items_subtotal, i.items_total_qty, i.item_lines, i.distinct_menu_items,
               r.is_refund_not_exceed_total
        from int_refunds_enriched r
        left join fct_orders o on o.order_id = r.order_id
        left join int_items_rollup i on i.order_id = r.order_id""",
    "fct_fx_rates": """
        select f.fx_rate_id, f.base_currency_id, b.currency_code as base_currency_code, f.quote_currency_id,
               q.currency_code as quote_currency_code, f.rate_ts, f.rate_date_utc, f.rate, f.source
        from stg_fx_rates f
        left join dim_currencies b on b.currency_id = f.base_currency_id
        left join dim_currencies q on q.currency_id = f.quote_currency_id""",
}

RELATIONS = RAW | STAGED | MODELS | SNAPSHOTS | GOLD


def _mentioned(text: str) -> list[str]:
    return [w for w in dict.fromkeys(re.findall(r"\w+", text)) if w in RELATIONS]


def sql(query: str) -> str:
    """The query with every relation it needs, in order of definition, as WITH entries."""
    needed: set[str] = set()
    todo = _mentioned(query)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _mentioned(RELATIONS[name])
    if not needed:
        return query
    entries = ", ".join(f"{name} as ({body})" for name, body in RELATIONS.items() if name in needed)
    return f"with {entries} {query}"
