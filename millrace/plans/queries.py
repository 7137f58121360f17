"""Registered queries: every operator over whole tables, each with its DuckDB oracle."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import cleaning
from millrace.functions.temporal import minutes_between
from millrace.operators import quality
from millrace.operators.enrich import enrich_orders
from millrace.operators.joins import orphan_rows
from millrace.operators.rollup import key_ranges, ordered_children
from millrace.operators.scd2 import asof_join
from millrace.plans import checks
from millrace.plans.build import DIMENSIONS, FACTS, INTERMEDIATE, StoredWarehouse, build, build_gold, export_bronze, run_checks
from millrace.plans.oracle_relations import sql
from millrace.plans.published import keep_by_order, publish
from millrace.plans.roles import (
    GIVEN,
    SNAPSHOTS,
    DerivedWarehouse,
    given,
    menu_batches,
    restaurant_batches,
    source_table,
)
from millrace.plans.staging import DAY_COLUMNS, STAGED
from millrace.plans.warehouse import MENU_CHECK, RESTAURANT_CHECK, Warehouse
from millrace.session import STORED_CODEC, configure, input_bytes, is_written, new_path, size_shuffles, write_out
from millrace.sources import bronze
from millrace.sources.catalog import relation_counts
from millrace.sources.history import compact, drop_replaced, read_history, record_snapshot

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            size_shuffles(configure(spark), input_bytes(spark, sf_dir))
            return build(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = sql(oracle)
        return build

    return add


# Sources, sinks and views


@register("raw_scan", "select * from lineitem")
def raw_scan(spark, sf_dir):
    return given(spark, sf_dir, "lineitem")


@register(
    "raw_catalog",
    " union all ".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in GIVEN),
)
def raw_catalog(spark, sf_dir):
    for t in GIVEN:
        given(spark, sf_dir, t).createOrReplaceTempView(f"raw_{t}")
    return bronze.view_counts(spark, GIVEN)


def _full_export(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = new_path(spark, "bronze")
        bronze.export_table(source_table(spark, sf_dir, table), f"{base}/{table}")
        return bronze.register_raw(spark, base, [table])[table]

    return run


register("bronze_full_export", "select * from raw_customers")(_full_export("customers"))
for _table in STAGED:
    if _table not in DAY_COLUMNS and _table != "customers":
        register(f"bronze_full_export_{_table}", f"select * from raw_{_table}")(_full_export(_table))


def _exported_by_day(spark, sf_dir, table: str) -> DataFrame:
    ts, day = DAY_COLUMNS[table]
    base = new_path(spark, "bronze")
    dated = bronze.with_day(source_table(spark, sf_dir, table), ts, day)
    bronze.export_by_day(dated, f"{base}/{table}", day)
    return bronze.register_raw(spark, base, [table])[table]


@register(
    "bronze_partitioned_export",
    "select * replace (total_amount::decimal(12,2) as total_amount) from raw_orders",
)
def bronze_partitioned_export(spark, sf_dir):
    return _exported_by_day(spark, sf_dir, "orders").withColumn(
        "total_amount", cleaning.money("total_amount")
    )


@register(
    "raw_partitioned_scan",
    "select event_day, count(*) as n_events, count(distinct order_id) as n_orders from raw_order_status_events"
    " group by event_day",
)
def raw_partitioned_scan(spark, sf_dir):
    events = _exported_by_day(spark, sf_dir, "order_status_events")
    return events.groupBy("event_day").agg(
        F.count("*").alias("n_events"), F.count_distinct("order_id").alias("n_orders")
    )


@register(
    "bronze_changed_days",
    "select * replace (total_amount::decimal(12,2) as total_amount) from raw_orders",
)
def bronze_changed_days(spark, sf_dir):
    # An earlier state, without some orders of one year, is brought up to date: their days alone are written again.
    ts, day = DAY_COLUMNS["orders"]
    orders = bronze.with_day(source_table(spark, sf_dir, "orders"), ts, day)
    path = f"{new_path(spark, 'bronze')}/orders"
    late = (F.year(day) == 1996) & (F.col("order_id") % 7 == 0)
    bronze.export_changed_days(orders.where(~late), path, day)
    bronze.export_changed_days(orders, path, day)
    return spark.read.parquet(path).withColumn("total_amount", cleaning.money("total_amount"))


@register("bronze_child_export", "select * replace (unit_price::decimal(10,2) as unit_price) from raw_order_items")
def bronze_child_export(spark, sf_dir):
    ts, day = DAY_COLUMNS["order_items"]
    items = source_table(spark, sf_dir, "order_items")
    dated = bronze.with_parent_day(items, source_table(spark, sf_dir, "orders"), "order_id", ts, day)
    base = new_path(spark, "bronze")
    bronze.export_by_day(dated, f"{base}/order_items", day)
    back = bronze.register_raw(spark, base, ["order_items"])["order_items"]
    return back.withColumn("unit_price", cleaning.money("unit_price", 10))


@register(
    "append_if_absent",
    """with staged as (select * replace (o_custkey + 1000000 as o_custkey) from orders union all select * from orders),
            target as (select * from orders where o_orderstatus <> 'P')
       select * from target
       union all
       (select distinct on (o_orderkey) * from staged where o_orderkey not in (select o_orderkey from target)
        order by o_orderkey, o_custkey)""",
)
def append_if_absent(spark, sf_dir):
    # Every order is staged twice, and two of three statuses are already there.
    orders = given(spark, sf_dir, "orders")
    staged = orders.withColumn("o_custkey", F.col("o_custkey") + 1000000).unionByName(orders)
    target = orders.where("o_orderstatus <> 'P'")
    return bronze.append_if_absent(staged, target, "o_orderkey", ["o_custkey"])


RANGED = {
    "customer": "c_custkey",
    "nation": "n_nationkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
}


@register(
    "key_ranges",
    " union all ".join(
        f"select '{t}' as relation, min({k})::bigint as lo, max({k})::bigint as hi,"
        f" ifnull(max({k}), 0)::bigint + 1 as next_key from {t}"
        for t, k in RANGED.items()
    ),
)
def ranges(spark, sf_dir):
    return key_ranges({t: (given(spark, sf_dir, t), k) for t, k in RANGED.items()})


# Cleaning


@register(
    "safe_cast",
    """select event_id, try_cast(trim(substr(props, 7, 3)) as bigint) as as_long,
              try_cast(case when event_id % 3 = 0 then 'x' else value::varchar end as decimal(12,1)) as as_decimal,
              try_cast(case when event_id % 4 = 0 then '2024-13-01' else ts::date::varchar end as timestamp) as as_ts,
              try_cast(case when event_id % 2 = 0 then 'true' else event_type end as boolean) as as_flag
       from events""",
)
def safe_cast(spark, sf_dir):
    text = {
        "as_long": ("trim(substr(props, 7, 3))", "bigint"),
        "as_decimal": ("case when event_id % 3 = 0 then 'x' else string(value) end", "decimal(12,1)"),
        "as_flag": ("case when event_id % 2 = 0 then 'true' else event_type end", "boolean"),
    }
    day = F.expr("case when event_id % 4 = 0 then '2024-13-01' else string(date(ts)) end")
    return given(spark, sf_dir, "events").select(
        "event_id",
        *[cleaning.safe_cast(F.expr(e), t).alias(n) for n, (e, t) in text.items()],
        cleaning.utc_timestamp(day, safe=True).alias("as_ts"),
    )


@register(
    "clean_text",
    "select doc_id, nullif(trim(text), '') as text, nullif(trim(chr(160) || '  ' || lang || chr(8195)), '') as lang,"
    " nullif(trim(case when doc_id % 4 = 0 then chr(160) || ' ' else source end), '') as source from documents",
)
def clean_text(spark, sf_dir):
    blank = F.when(F.col("doc_id") % 4 == 0, F.lit("  ")).otherwise(F.col("source"))
    padded = F.concat(F.lit("   "), F.col("lang"), F.lit(" "))
    return given(spark, sf_dir, "documents").select(
        "doc_id",
        cleaning.clean_text("text").alias("text"),
        cleaning.clean_text(padded).alias("lang"),
        cleaning.clean_text(blank).alias("source"),
    )


@register(
    "clean_category",
    "select p_partkey, upper(nullif(trim('  ' || lower(p_type) || ' '), '')) as p_type,"
    " upper(nullif(trim(case when p_size < 10 then '  ' else p_name end), '')) as p_name from part",
)
def clean_category(spark, sf_dir):
    return given(spark, sf_dir, "part").select(
        "p_partkey",
        cleaning.clean_category(F.expr("concat('  ', lower(p_type), ' ')")).alias("p_type"),
        cleaning.clean_category(F.expr("case when p_size < 10 then '  ' else p_name end")).alias("p_name"),
    )


@register(
    "utc_day",
    "select event_id, cast(ts as date) as day, cast(ts + interval 10 hour as date) as shifted_day from events",
)
def utc_day(spark, sf_dir):
    # The second day reads the time as one given with the offset -10:00.
    zoned = F.concat(F.col("ts").cast("string"), F.lit("-10:00"))
    return given(spark, sf_dir, "events").select(
        "event_id", cleaning.utc_day("ts").alias("day"), cleaning.utc_day(zoned).alias("shifted_day")
    )


@register(
    "minute_boundaries",
    "select user_id, date_diff('minute', s, p) as minutes_to_purchase, date_diff('minute', p, s) as minutes_back"
    " from (select user_id, min(ts) filter (event_type = 'signup') as s,"
    " min(ts) filter (event_type = 'purchase') as p from events group by user_id)",
)
def minute_boundaries(spark, sf_dir):
    firsts = (
        given(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("s"),
            F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("p"),
        )
    )
    return firsts.select(
        "user_id",
        minutes_between("s", "p").alias("minutes_to_purchase"),
        minutes_between("p", "s").alias("minutes_back"),
    )


def _staged(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return DerivedWarehouse(spark, sf_dir).staged(table)


for _table in STAGED:
    register(f"stg_{_table}", f"select * from stg_{_table}")(partial(_staged, _table))


# Models of the warehouse: query name -> (model, oracle relation)

MODELS = {
    "items_rollup": ("items_rollup", "int_items_rollup"),
    "status_rollup": ("status_rollup", "int_status_rollup"),
    "delivery_enriched": ("delivery_enriched", "int_delivery_enriched"),
    "order_reconciliation": ("orders_reconciliation", "int_orders_reconciliation"),
    "order_enriched": ("orders_enriched", "int_orders_enriched"),
    "line_enriched": ("order_items_enriched", "int_order_items_enriched"),
    "refund_enriched": ("refunds_enriched", "int_refunds_enriched"),
    "outlet_brand_lookup": ("restaurants_snapshot_source", "int_restaurants_snapshot_source"),
    "menu_snapshot_source": ("menu_items_snapshot_source", "int_menu_items_snapshot_source"),
    "scd2_merge_part": ("merged_menu", "snap_menu_items"),
    "scd2_merge_supplier": ("merged_restaurants", "snap_restaurants"),
    "scd2_dim": ("dim_menu_items", "dim_menu_items"),
    "scd2_dim_restaurants": ("dim_restaurants", "dim_restaurants"),
    "scd2_backfill": ("dim_menu_items_backfill", "dim_menu_items_backfill"),
    "scd2_backfill_restaurants": ("dim_restaurants_backfill", "dim_restaurants_backfill"),
    "dim_passthrough": ("dim_customers", "dim_customers"),
    "dim_customer_addresses": ("dim_customer_addresses", "dim_customer_addresses"),
    "dim_couriers": ("dim_couriers", "dim_couriers"),
    "dim_currencies": ("dim_currencies", "dim_currencies"),
    "dim_date": ("dim_date", "dim_date"),
    "asof_orders": ("fct_orders", "fct_orders"),
    "asof_lines": ("fct_order_items", "fct_order_items"),
    "fct_refunds": ("fct_refunds", "fct_refunds"),
    "role_playing_join": ("fct_fx_rates", "fct_fx_rates"),
}


def _model(model: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    found = getattr(DerivedWarehouse(spark, sf_dir), model)
    return found() if callable(found) else found


for _name, (_attribute, _relation) in MODELS.items():
    register(_name, f"select * from {_relation}")(partial(_model, _attribute))


@register(
    "ordered_children",
    "select o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as position, o_orderkey,"
    " o_orderstatus, o_orderdate from orders",
)
def children(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    return ordered_children(orders, "o_custkey", "o_orderkey", ["o_orderstatus", "o_orderdate"])


@register(
    "asof_long_history",
    "select f.event_id, f.user_id, f.ts, v.event_id as version_id, v.event_type from events f left join"
    " (select *, lead(ts) over (partition by user_id order by ts, event_id) as ended from events"
    "  where event_type <> 'purchase') v"
    " on v.user_id = f.user_id and f.ts >= v.ts and (v.ended is null or f.ts < v.ended)"
    " where f.event_type = 'purchase'",
)
def asof_long_history(spark, sf_dir):
    # Purchases with the state of their user: each other event of a user is a version.
    events = given(spark, sf_dir, "events")
    ended = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    versions = events.where("event_type <> 'purchase'").select(
        "user_id", F.col("event_id").alias("version_id"), "event_type", F.col("ts").alias("valid_from"), ended.alias("valid_to")
    )
    facts = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    # The versions are read several times; the window behind them is computed once.
    return asof_join(facts, write_out(versions, "versions"), "user_id", "ts", ["version_id", "event_type"], long_history=4)


@register("scd2_history_runs", "select * from snap_restaurants")
def scd2_history_runs(spark, sf_dir):
    source = DerivedWarehouse(spark, sf_dir).restaurants_snapshot_source
    base = new_path(spark, "history")
    for batch, at in zip(restaurant_batches(source), SNAPSHOTS):
        kept = record_snapshot(batch, base, "restaurant_id", RESTAURANT_CHECK, at)
    return kept


@register(
    "scd2_rerun_is_stable",
    "select * from snap_menu_items",
)
def scd2_rerun(spark, sf_dir):
    # Every batch is merged twice; the second merge must add nothing.
    source = DerivedWarehouse(spark, sf_dir).menu_items_snapshot_source
    base = new_path(spark, "history")
    for batch, at in zip(menu_batches(source), SNAPSHOTS):
        for _ in range(2):
            kept = record_snapshot(batch, base, "menu_item_id", MENU_CHECK, at)
    return kept


# Checks


def check_query(name: str, oracle: str, build: Callable[[DerivedWarehouse], DataFrame]) -> None:
    register(name, oracle)(lambda spark, sf_dir: build(DerivedWarehouse(spark, sf_dir)))


def one_check(kind: str, relation: str, *columns: str, where: str | None = None) -> Callable:
    """Violations of one declared check."""

    def build(w: DerivedWarehouse) -> DataFrame:
        found = [
            c
            for c in checks.declared_checks()
            if c.kind == kind and c.relation == relation and c.columns == columns and c.where == where
        ]
        return quality.violations(found[0], checks.relations(w, found[0]))

    return build


def _listed(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


check_query(
    "dq_not_null",
    "select * from stg_customers where email is null",
    one_check("not_null", "stg_customers", "email"),
)
check_query(
    "dq_unique",
    "select order_item_id, count(*) as n_rows from stg_order_items group by 1 having count(*) > 1",
    one_check("unique", "stg_order_items", "order_item_id"),
)
check_query(
    "dq_unique_combo",
    "select base_currency_id, quote_currency_id, rate_ts, count(*) as n_rows from fct_fx_rates"
    " group by all having count(*) > 1",
    lambda w: checks.repeated_rate(w.fct_fx_rates),
)
check_query(
    "dq_relationships",
    "select quote_currency_id, count(*) as n_rows from raw_fx_rates where quote_currency_id is not null"
    " and quote_currency_id not in (select currency_id from raw_currencies) group by 1",
    one_check("relationships", "raw_fx_rates", "quote_currency_id"),
)
check_query(
    "dq_relationships_rows",
    "select * from raw_fx_rates where quote_currency_id is not null"
    " and quote_currency_id not in (select currency_id from raw_currencies)",
    lambda w: orphan_rows(w.raw["fx_rates"], "quote_currency_id", w.raw["currencies"], "currency_id"),
)
check_query(
    "dq_accepted_values",
    f"select * from fct_orders where payment_method not in {_listed(checks.METHODS)}",
    one_check("accepted_values", "fct_orders", "payment_method"),
)
check_query(
    "dq_expression",
    "select * from dim_customers where not (email like '%@%')",
    one_check("expression_is_true", "dim_customers"),
)
check_query(
    "dq_range",
    "select * from dim_date where year_utc not between 2000 and 2100",
    one_check("accepted_range", "dim_date", "year_utc"),
)
check_query(
    "dq_rate_range",
    "select fx_rate_id, rate from fct_fx_rates where rate <= 0 or rate > 100000",
    lambda w: checks.unreasonable_rate(w.fct_fx_rates),
)
check_query(
    "dq_same_pair",
    "select fx_rate_id, base_currency_id, quote_currency_id from fct_fx_rates"
    " where base_currency_id = quote_currency_id",
    lambda w: checks.same_currency_pair(w.fct_fx_rates),
)


def _implications(w: DerivedWarehouse) -> DataFrame:
    columns = ["order_id", "payment_status", "delivered_at"]
    paid = F.col("payment_status") == "PAID"
    unpaid_time = quality_rule("paid_is_delivered", w.orders_enriched, paid, columns)
    no_time = quality_rule("delivered_has_time", w.orders_enriched, F.col("is_delivered"), columns)
    return unpaid_time.unionByName(no_time)


def quality_rule(rule: str, df: DataFrame, premise, columns: list[str]) -> DataFrame:
    bad = checks.implication(df, premise, F.col("delivered_at").isNotNull(), columns)
    return bad.select(F.lit(rule).alias("rule"), "*")


check_query(
    "dq_implication",
    "select 'paid_is_delivered' as rule, order_id, payment_status, delivered_at from int_orders_enriched"
    " where payment_status = 'PAID' and delivered_at is null"
    " union all select 'delivered_has_time', order_id, payment_status, delivered_at from int_orders_enriched"
    " where is_delivered and delivered_at is null",
    _implications,
)
check_query(
    "dq_subtotal_match",
    "select order_id, subtotal, items_subtotal, (subtotal - items_subtotal)::decimal(24,2) as diff"
    " from fct_orders where abs(subtotal - items_subtotal) > 0.05",
    lambda w: checks.subtotal_mismatch(w.fct_orders),
)
check_query(
    "dq_timestamp_order",
    "select order_id, accepted_at, picked_up_at, delivered_at from fct_orders"
    " where accepted_at > picked_up_at or picked_up_at > delivered_at",
    lambda w: checks.milestones_out_of_order(w.fct_orders),
)
TOTALS = (
    "select order_id, subtotal, tax, delivery_fee, discount, total_amount, expected::decimal(24,2) as expected_total,"
    " (total_amount - expected)::decimal(24,2) as diff"
    " from (select *, subtotal + tax + delivery_fee - discount as expected from fct_orders)"
    " where abs(total_amount - expected) > 0.05"
)
check_query("dq_total_consistency", TOTALS, lambda w: checks.total_mismatch(w.fct_orders))
check_query(
    "dq_sample",
    TOTALS + " order by order_id limit 50",
    lambda w: quality.sample(checks.total_mismatch(w.fct_orders), ["order_id"]),
)


def _headers(w: DerivedWarehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    # The facts hold these columns of refunds and orders as they are staged, one row each.
    return w.staged("refunds"), w.staged("orders"), w.keys_of("refunds")


check_query(
    "dq_cross_table",
    "select refund_id, order_id, refund_ts, order_placed_at from fct_refunds join"
    " (select order_id, order_placed_at from fct_orders) using (order_id) where refund_ts < order_placed_at",
    lambda w: checks.refund_before_order(*_headers(w)),
)
check_query(
    "dq_refund_above_total",
    "select refund_id, order_id, refund_amount, total_amount from fct_refunds join"
    " (select order_id, total_amount from fct_orders) using (order_id) where refund_amount > total_amount + 0.01",
    lambda w: checks.refund_above_total(*_headers(w)),
)


def _windows(w: DerivedWarehouse) -> DataFrame:
    found = [c for c in checks.declared_checks() if c.relation in ("dim_restaurants", "dim_menu_items")]
    return quality.report(found, checks.relations(w, *found))


def failures_sql(check: quality.Check) -> str:
    """Oracle count of the violations of one check."""
    source = f"(select * from {check.relation} where {check.where})" if check.where else check.relation
    column = check.columns[0] if check.columns else ""
    grouped = ", ".join(check.columns)
    match check.kind:
        case "not_null":
            body = f"from {source} where {column} is null"
        case "unique":
            body = f"from (select 1 from {source} where {column} is not null group by {column} having count(*) > 1)"
        case "unique_combination":
            body = f"from (select 1 from {source} group by {grouped} having count(*) > 1)"
        case "accepted_values":
            body = f"from {source} where {column} not in {_listed(check.values)}"
        case "accepted_range":
            body = f"from {source} where {column} not between {check.values[0]} and {check.values[1]}"
        case "expression_is_true":
            body = f"from {source} where not ({check.expression})"
        case _:
            parent, key = check.parent
            body = f"from {source} c anti join {parent} p on p.{key} = c.{column} where c.{column} is not null"
    label = check.name.replace("'", "''")
    return f"select '{check.relation}' as relation, '{label}' as check_name, count(*) as failures {body}"


RULES_SQL = {
    "fx_no_same_currency_pair": "fct_fx_rates where base_currency_id = quote_currency_id",
    "fx_rate_positive_reasonable": "fct_fx_rates where not (rate > 0 and rate <= 100000)",
    "fx_unique_pair_ts": "(select 1 from fct_fx_rates group by base_currency_id, quote_currency_id, rate_ts"
    " having count(*) > 1)",
    "orders_delivered_has_time": "fct_orders where is_delivered and delivered_at is null",
    "orders_subtotal_matches_items": "fct_orders where abs(subtotal - items_subtotal) > 0.05",
    "orders_milestone_order": "fct_orders where accepted_at > picked_up_at or picked_up_at > delivered_at",
    "orders_total_consistency": "fct_orders"
    " where abs(total_amount - (subtotal + tax + delivery_fee - discount)) > 0.05",
    "refunds_after_order": "fct_refunds r join fct_orders o on o.order_id = r.order_id"
    " where r.refund_ts < o.order_placed_at",
    "refunds_within_total": "fct_refunds r join fct_orders o on o.order_id = r.order_id"
    " where r.refund_amount > o.total_amount + 0.01",
}


def suite_sql(declared: list[quality.Check], rules: dict[str, str]) -> str:
    parts = [failures_sql(c) for c in declared]
    parts += [
        f"select 'gold' as relation, '{n}' as check_name, count(*) as failures from {body}" for n, body in rules.items()
    ]
    union = " union all ".join(parts)
    return f"select *, if(failures = 0, 'pass', 'fail') as status from ({union})"


check_query(
    "dq_scd2_windows",
    suite_sql([c for c in checks.declared_checks() if c.relation in ("dim_restaurants", "dim_menu_items")], {}),
    _windows,
)
check_query(
    "dq_ddl_rules",
    suite_sql(checks.constraint_checks(), {}),
    lambda w: quality.report(checks.constraint_checks(), checks.relations(w, *checks.constraint_checks())),
)


@register("dq_report", suite_sql(checks.declared_checks(), RULES_SQL))
def dq_report(spark, sf_dir):
    watch = quality.Watch(checks.declared_checks())

    def keep(df: DataFrame, name: str) -> DataFrame:
        return write_out(watch.on(df, *checks.KEPT_AS.get(name, ())), name, STORED_CODEC)

    warehouse = DerivedWarehouse(spark, sf_dir, keep=keep, watch=watch)
    # Raw lines take their day from a join with the orders, which every scan of them would run again.
    warehouse.raw["order_items"] = keep(warehouse.raw["order_items"], "raw_order_items")
    return run_checks(warehouse)


@register(
    "warehouse_build",
    " union all ".join(
        f"select '{m}' as model, count(*) as n_rows from {r}"
        for m, r in {
            "dim_customers": "stg_customers",
            "dim_customer_addresses": "stg_customer_addresses",
            "dim_couriers": "stg_couriers",
            "dim_currencies": "stg_currencies",
            "dim_date": "dim_date",
            "dim_restaurants": "stg_restaurant_outlets",
            "dim_restaurants_backfill": "stg_restaurant_outlets",
            "dim_menu_items": "stg_menu_items",
            "dim_menu_items_backfill": "stg_menu_items",
            "fct_orders": "stg_orders",
            "fct_order_items": "stg_order_items",
            "fct_refunds": "stg_refunds",
            "fct_fx_rates": "stg_fx_rates",
        }.items()
    ),
)
def warehouse_build(spark, sf_dir):
    # The complete job from the source tables to gold, with one snapshot.
    sources = {t: source_table(spark, sf_dir, t) for t in STAGED}
    gold = build(spark, sources, new_path(spark, "warehouse"), "2002-01-01 00:00:00").gold
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("model"), "n_rows")
        for name, df in gold.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_built: dict[tuple[str, str], StoredWarehouse] = {}


def _stored(spark: SparkSession, sf_dir: str) -> StoredWarehouse:
    """The stored run over the given tables, built once per application and folder.

    It is built again where its files have been discarded meanwhile.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _built or not is_written(_built[at].base):
        _built[at] = _build_stored(spark, sf_dir, new_path(spark, "warehouse"))
    return _built[at]


def _build_stored(spark: SparkSession, sf_dir: str, base: str) -> StoredWarehouse:
    """Export, raw views, three snapshots, models."""
    export_bronze({t: source_table(spark, sf_dir, t) for t in STAGED}, f"{base}/bronze")
    raw = bronze.register_raw(spark, f"{base}/bronze", STAGED)
    states = Warehouse(raw)
    histories = []
    for batches, name, key, check in (
        (menu_batches(states.menu_items_snapshot_source), "menu_items", "menu_item_id", MENU_CHECK),
        (restaurant_batches(states.restaurants_snapshot_source), "restaurants", "restaurant_id", RESTAURANT_CHECK),
    ):
        for batch, taken in zip(batches, SNAPSHOTS):
            kept = record_snapshot(batch, f"{base}/snapshots/{name}", key, check, taken)
        histories.append(kept.drop("state"))
    return build_gold(raw, base, *histories)


for _name in (*DIMENSIONS, *FACTS):
    register(f"gold_{_name}", f"select * from {_name}")(lambda spark, sf_dir, name=_name: _stored(spark, sf_dir).gold[name])


# Lasting relations, read by name


def _published(spark: SparkSession, sf_dir: str) -> tuple[str, list[tuple[str, str]]]:
    """The prefix and names of the published relations; the prefix keeps several folders apart."""
    warehouse = _stored(spark, sf_dir)
    prefix = f"w{zlib.crc32(warehouse.base.encode()):08x}_"
    return prefix, publish(warehouse, prefix)


def _oracle_relation(schema: str, name: str) -> str:
    return {"raw": "raw_", "staging": "stg_", "intermediate": "int_"}.get(schema, "") + name


CATALOG = sorted(
    [("raw", t) for t in STAGED]
    + [("staging", t) for t in STAGED]
    + [("snapshots", "snap_menu_items"), ("snapshots", "snap_restaurants")]
    + [("intermediate", m) for m in INTERMEDIATE.values()]
    + [("gold", g) for g in (*DIMENSIONS, *FACTS)]
)


@register(
    "catalog_relations",
    " union all ".join(
        f"select '{s}' as schema_name, '{n}' as table_name, count(*) as n_rows from {_oracle_relation(s, n)}" for s, n in CATALOG
    ),
)
def catalog_relations(spark, sf_dir):
    prefix, names = _published(spark, sf_dir)
    return relation_counts(spark, names, prefix)


@register(
    "catalog_orders_of_a_month",
    "select r.order_id, s.payment_status, f.restaurant_sk, i.subtotal_minus_items, r.order_day"
    " from raw_orders r join stg_orders s using (order_id) join fct_orders f using (order_id)"
    " join int_orders_reconciliation i using (order_id)"
    " where r.order_day >= date '1996-03-01' and r.order_day < date '1996-04-01'",
)
def catalog_orders_of_a_month(spark, sf_dir):
    # Plain SQL over four schemas; the filter on the day prunes partitions of the raw table.
    p, _ = _published(spark, sf_dir)
    return spark.sql(
        f"select r.order_id, s.payment_status, f.restaurant_sk, i.subtotal_minus_items, r.order_day"
        f" from {p}raw.orders r join {p}staging.orders s using (order_id) join {p}gold.fct_orders f using (order_id)"
        f" join {p}intermediate.orders_reconciliation i using (order_id)"
        f" where r.order_day >= date'1996-03-01' and r.order_day < date'1996-04-01'"
    )


@register("orders_by_bucketed_nodes", "select * from int_orders_enriched")
def orders_by_bucketed_nodes(spark, sf_dir):
    # The order rollups are stored once as bucketed tables; the header alone is shuffled to meet them.
    base = new_path(spark, "by-order")
    keep = keep_by_order(spark, f"b{zlib.crc32(base.encode()):08x}_intermediate", base)
    w = DerivedWarehouse(spark, sf_dir, keep=keep)
    return enrich_orders(w.staged("orders"), w.items_rollup, w.status_rollup, w.delivery_enriched)


@register("history_compacted", "select * from snap_restaurants")
def history_compacted(spark, sf_dir):
    # Three runs, gathered after the second and after the third, and what they replace deleted.
    source = DerivedWarehouse(spark, sf_dir).restaurants_snapshot_source
    base = new_path(spark, "history")
    for k, (batch, at) in enumerate(zip(restaurant_batches(source), SNAPSHOTS)):
        record_snapshot(batch, base, "restaurant_id", RESTAURANT_CHECK, at)
        if k:
            compact(spark, base)
            drop_replaced(spark, base)
    return read_history(spark, base)


@register("catalog_snapshot_history", "select * from snap_menu_items")
def catalog_snapshot_history(spark, sf_dir):
    p, _ = _published(spark, sf_dir)
    return spark.sql(f"select * from {p}snapshots.snap_menu_items")
