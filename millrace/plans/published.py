"""Every model as a named relation that any session can query by SQL.

Five schemas: ``raw`` and ``gold`` are external tables over the stored exports and gold tables,
``staging`` are views over ``raw``, ``intermediate`` are tables over stored nodes or views, and
``snapshots`` are views over the runs of a history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, StringType, StructType, TimestampNTZType

from millrace.functions.cleaning import ANY_TIME, EPOCH, PLAIN_TIME, SPACES
from millrace.plans.build import DIMENSIONS, FACTS, StoredWarehouse
from millrace.plans.staging import DAY_COLUMNS, STAGED, source_of
from millrace.session import write_out
from millrace.sources.catalog import create_schema, create_view, quoted, register_table, relation_names, store_bucketed, text
from millrace.sources.history import history_query

SCHEMAS = ("raw", "staging", "snapshots", "intermediate", "gold")

# Nodes that the warehouse stores under the name of the model.
STORED_NODES = ("items_rollup", "status_rollup", "refunds_enriched")


# -- staging as SQL ----------------------------------------------------------------------------


def time_sql(column: str, safe: bool) -> str:
    """A text as a UTC wall-clock time, in SQL; ``cleaning.utc_timestamp`` says which texts."""
    any_time = "r'" + ANY_TIME + "'"

    def part(n: int) -> str:
        return f"regexp_extract({column}, {any_time}, {n})"

    midnight = f"({part(6)} = '24' AND {part(7)} RLIKE '^0+$' AND {part(8)} RLIKE '^0*$' AND {part(9)} RLIKE r'^\\.?0*$')"
    second = f"if({part(8)} = '', '0', {part(8)})"
    clock = f"if({part(6)} = '', '', concat(' ', if({midnight}, '0', {part(6)}), ':', {part(7)}, ':', {second}, {part(9)}, {part(10)}))"
    year = f"lpad({part(2)}, greatest(length({part(2)}), 4), '0')"
    time = f"try_cast(concat({part(1)}, {year}, '-', {part(4)}, '-', {part(5)}, {clock}) AS timestamp)"
    unusual = (
        f"CASE WHEN {column} RLIKE {any_time} THEN if({midnight}, {time} + interval 24 hours, {time})"
        f" WHEN lower(trim({column})) = '{EPOCH}' THEN timestamp_seconds(0) END"
    )
    parsed = f"coalesce(CASE WHEN {column} RLIKE r'{PLAIN_TIME}' THEN try_cast({column} AS timestamp) END, {unusual})"
    if not safe:
        wrong = f"CAST(raise_error(concat('not a time: ', {column})) AS timestamp)"
        parsed = f"CASE WHEN {column} IS NOT NULL THEN coalesce({parsed}, {wrong}) END"
    return f"CAST({parsed} AS timestamp_ntz)"


def staged_sql(column: str, kind: str, found: DataType) -> str:
    """One staged column in SQL, the same value as ``staging.staged_column`` gives."""
    safe = kind.startswith("try ")
    dtype = kind.removeprefix("try ")
    name, cast = quoted(column), "try_cast" if safe else "CAST"
    cleaned = f"nullif(trim(BOTH {text(SPACES)} FROM CAST({name} AS string)), '')"
    if dtype == "text":
        return cleaned
    if dtype == "category":
        return f"upper({cleaned})"
    if dtype == "timestamp":
        if isinstance(found, TimestampNTZType):
            return name
        return time_sql(name, safe) if isinstance(found, StringType) else f"CAST(CAST({name} AS timestamp) AS timestamp_ntz)"
    if dtype in ("int", "bigint"):
        if isinstance(found, (FloatType, DoubleType)):
            return f"{cast}(rint({name}) AS {dtype})"
        if isinstance(found, DecimalType):
            return f"{cast}(round({name}, 0) AS {dtype})"
        if isinstance(found, StringType):
            return f"{cast}(round({cast}({name} AS decimal(38,10)), 0) AS {dtype})"
    return f"{cast}({name} AS {dtype})"


def staging_query(table: str, raw: StructType, source: str) -> str:
    """A staged table as a SELECT over its raw relation ``source``."""
    columns = []
    for target, entry in STAGED[table].items():
        kind, column = source_of(target, entry)
        columns.append(f"{staged_sql(column, kind, raw[column].dataType)} AS {quoted(target)}")
    return f"SELECT {', '.join(columns)} FROM {source}"


# -- intermediate models as SQL over other relations ---------------------------------------------


def intermediate_queries(relation) -> dict[str, str]:
    """Views of the intermediate models that are not stored; ``relation(schema, name)`` names what they read."""
    amounts = "decimal(22,2)"
    wide = "decimal(24,2)"
    items = f"coalesce(i.items_subtotal, CAST(0 AS {amounts}))"
    expected = f"{items} + o.tax + o.delivery_fee - o.discount"
    cents = lambda e: f"CAST(round({e}, 2) AS {wide})"
    line = "l.order_item_id, l.order_id, l.menu_item_id, l.quantity, l.unit_price, l.line_total"
    header = "o.customer_id, o.restaurant_id, o.currency_id, o.order_placed_at, o.order_date_utc"
    return {
        "delivery_enriched": "SELECT order_id, courier_id, assigned_at, pickup_eta, dropoff_eta"
        f" FROM {relation('staging', 'delivery_assignments')}",
        "orders_reconciliation": f"SELECT o.order_id, o.subtotal AS orders_subtotal, {items} AS items_subtotal,"
        f" {cents(f'o.subtotal - {items}')} AS subtotal_minus_items, o.tax, o.delivery_fee, o.discount, o.total_amount,"
        f" {cents(expected)} AS expected_total_from_items, {cents(f'({expected}) - o.total_amount')} AS expected_total_minus_total_amount"
        f" FROM {relation('staging', 'orders')} o LEFT JOIN {relation('intermediate', 'items_rollup')} i ON i.order_id = o.order_id",
        "orders_enriched": f"SELECT * EXCEPT (restaurant_sk, is_current_restaurant_details) FROM {relation('gold', 'fct_orders')}",
        "order_items_enriched": f"SELECT {line}, {header}, m.item_name, m.category, m.price_amount AS menu_price, m.is_available,"
        " m.restaurant_id = o.restaurant_id AS is_menu_item_from_order_restaurant"
        f" FROM {relation('staging', 'order_items')} l LEFT JOIN {relation('staging', 'orders')} o ON o.order_id = l.order_id"
        f" LEFT JOIN {relation('staging', 'menu_items')} m ON m.menu_item_id = l.menu_item_id",
        "menu_items_snapshot_source": f"SELECT menu_item_id, restaurant_id, item_name, category FROM {relation('staging', 'menu_items')}",
        "restaurants_snapshot_source": "SELECT r.restaurant_id, r.brand_id, b.brand_name, b.is_active AS brand_is_active, r.outlet_name, r.city,"
        " r.delivery_zone, r.address_line1, r.postal_code, r.is_active"
        f" FROM {relation('staging', 'restaurant_outlets')} r LEFT JOIN {relation('staging', 'restaurant_brands')} b ON b.brand_id = r.brand_id",
    }


# -- nodes by order ------------------------------------------------------------------------------

# Kept nodes at the grain of an order; each is the result of a shuffle by it.
BY_ORDER = ("items_rollup", "status_rollup")


def keep_by_order(spark: SparkSession, schema: str, base: str, buckets: int | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """``keep`` for a warehouse that stores order nodes as bucketed tables of the catalog and others as plain ones.

    The order fact, and whatever else joins these nodes by order, then shuffles its other side only,
    in this run and in later ones. There are as many buckets as shuffle partitions.
    """
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name in BY_ORDER:
            return store_bucketed(df, schema, name, f"{base}/{name}", "order_id", count, dealt=True)
        return write_out(df, name)

    return keep


# -- publishing --------------------------------------------------------------------------------


def publish(warehouse: StoredWarehouse, prefix: str = "") -> list[tuple[str, str]]:
    """Register every relation of a stored warehouse; returns their (schema, name).

    Schemas are ``raw``, ``staging``, ``snapshots``, ``intermediate`` and ``gold``, each behind
    ``prefix``. May be repeated after every run: new day directories become partitions, changed
    tables are replaced, and the snapshot views follow the runs of the history.
    """
    spark = next(iter(warehouse.raw.values())).sparkSession
    at = {name: prefix + name for name in SCHEMAS}
    for schema in at.values():
        create_schema(spark, schema)

    def relation(schema: str, name: str) -> str:
        return quoted(at[schema], name)

    for table in STAGED:
        raw = warehouse.raw[table].schema
        days = [DAY_COLUMNS[table][1]] if table in DAY_COLUMNS else []
        register_table(spark, at["raw"], table, f"{warehouse.base}/bronze/{table}", raw, days)
        create_view(spark, at["staging"], table, staging_query(table, raw, relation("raw", table)))
    for name, path in (("snap_menu_items", "menu_items"), ("snap_restaurants", "restaurants")):
        query = history_query(spark, f"{warehouse.base}/snapshots/{path}")
        if query:
            create_view(spark, at["snapshots"], name, query)
    warehouse.store_gold()
    for name in (*DIMENSIONS, *FACTS):
        register_table(spark, at["gold"], name, f"{warehouse.base}/gold/{name}", warehouse.gold[name].schema)
    for name in STORED_NODES:
        found = getattr(warehouse, name)
        register_table(spark, at["intermediate"], name, f"{warehouse.base}/nodes/{name}", found.schema)
    for name, query in intermediate_queries(relation).items():
        create_view(spark, at["intermediate"], name, query)
    return relation_names(spark, at.values())


def published(spark: SparkSession, schema: str, name: str, prefix: str = "") -> DataFrame:
    """A published relation by name, in any session of the catalog."""
    return spark.table(quoted(prefix + schema, name))


def withdraw(spark: SparkSession, prefix: str = "") -> None:
    """Take the schemas out of the catalog; the files stay."""
    for schema in SCHEMAS:
        spark.sql(f"DROP SCHEMA IF EXISTS {quoted(prefix + schema)} CASCADE")
