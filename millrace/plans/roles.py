"""The fourteen source tables of the warehouse, derived from the given test tables.

Every derivation is a projection of a whole given table (customer addresses: two
rows per customer), so the work grows with the data. Padding, blanks, malformed
numbers and times, unknown keys and broken amounts are put in on purpose, for the
cleaning and the checks to find.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.scd2 import first_history, merge_snapshot
from millrace.plans.staging import DAY_COLUMNS
from millrace.plans.warehouse import MENU_CHECK, RESTAURANT_CHECK, Warehouse
from millrace.session import write_out
from millrace.sources.bronze import with_day, with_parent_day

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Snapshot times of the two dimension histories; order dates run 1995 to 2001.
SNAPSHOTS = ("1996-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00")

# Source table -> (given table, filter, target column -> SQL expression).
DERIVED = {
    "customers": (
        "customer",
        None,
        {
            "customer_id": "c_custkey",
            "full_name": "concat('  ', c_name, ' ')",
            "email": "case when c_custkey % 89 = 3 then '   ' when c_custkey % 97 = 5 then c_name"
            " else concat(' ', lower(c_name), '@mail.test') end",
            "phone": "case when c_custkey % 3 = 0 then ' ' else concat('+', c_custkey) end",
            "created_at": "case when c_custkey % 10 = 7 then 'unknown' else concat('2019-',"
            " lpad(cast(c_custkey % 12 + 1 as string), 2, '0'), '-',"
            " lpad(cast(c_custkey % 28 + 1 as string), 2, '0'), ' 10:30:00') end",
        },
    ),
    "customer_addresses": (
        "customer",
        None,
        {
            "address_id": "c_custkey * 2 + i",
            "customer_id": "c_custkey",
            "label": "case when i = 0 then ' home ' when c_custkey % 50 = 9 then 'depot'"
            " when c_custkey % 3 = 0 then 'Work' else 'other' end",
            "line_1": "concat(c_custkey, ' High St')",
            "line_2": "case when i = 0 then '' else ' Unit 2' end",
            "city": "concat(' City ', c_nationkey)",
            "state": "case when c_nationkey % 2 = 0 then concat('S', c_nationkey) else ' ' end",
            "country": "concat('Country ', c_nationkey)",
            "postal_code": "lpad(cast(c_custkey % 10000 as string), 5, '0')",
            "latitude": "concat(c_nationkey, '.1234567')",
            "longitude": "concat('-', c_custkey % 180, '.5')",
            "is_default": "i = 0 or c_custkey % 61 = 0",
            "created_at": "'2019-01-01 00:00:00'",
        },
    ),
    "restaurant_brands": (
        "nation",
        None,
        {
            "brand_id": "n_nationkey",
            "brand_name": "concat(n_name, ' ')",
            "is_active": "case when n_regionkey = 3 then 'false' else 'true' end",
            "created_at": "'2018-01-01 00:00:00'",
        },
    ),
    "restaurant_outlets": (
        "supplier",
        None,
        {
            "restaurant_id": "s_suppkey",
            "brand_id": "case when s_suppkey % 40 = 39 then 999 else s_nationkey end",
            "outlet_name": "concat(' ', s_name)",
            "city": "concat('City ', s_nationkey % 7)",
            "delivery_zone": "concat('Z', s_suppkey % 10)",
            "address_line1": "case when s_suppkey % 4 = 0 then '' else concat(s_suppkey, ' Main Rd') end",
            "postal_code": "lpad(cast(s_suppkey % 10000 as string), 5, '0')",
            "is_active": "s_acctbal >= 0",
            "created_at": "'2018-06-01 00:00:00'",
        },
    ),
    "menu_items": (
        "part",
        None,
        {
            "menu_item_id": "p_partkey",
            "restaurant_id": "p_partkey div 20",
            "item_name": "concat(' ', p_name, ' ', p_partkey)",
            "category": "concat(p_type, '  ')",
            "price": "p_retailprice",
            "is_available": "p_size > 5",
            "created_at": "'2018-07-01 00:00:00'",
        },
    ),
    "couriers": (
        "supplier",
        None,
        {
            "courier_id": "s_suppkey",
            "city": "concat(' City ', s_nationkey % 7)",
            "vehicle": "case s_suppkey % 8 when 0 then ' bike' when 1 then 'Scooter' when 2 then 'CAR '"
            " when 3 then 'boat' else 'car' end",
            "is_active": "s_acctbal >= 0",
            "created_at": "case when s_suppkey % 9 = 4 then '' else '2018-08-01 12:00:00' end",
        },
    ),
    "currencies": (
        "region",
        None,
        {
            "currency_id": "r_regionkey",
            "currency_code": "case r_regionkey when 0 then 'aud ' when 1 then ' inr' when 2 then 'usd'"
            " else substr(lower(r_name), 1, 3) end",
            "currency_name": "concat(r_name, ' dollar ')",
            "is_active": "r_regionkey < 3",
            "created_at": "'2018-01-01 00:00:00'",
        },
    ),
    "fx_rates": (
        "events",
        None,
        {
            "fx_rate_id": "cast(event_id as string)",
            "base_currency_id": "user_id % 5",
            "quote_currency_id": "event_id % 6",
            "rate_ts": "cast(date_trunc('HOUR', ts) as timestamp_ntz)",
            "rate": "case when event_id % 50 = 1 then 'n/a' when event_id % 53 = 2 then '0'"
            " when event_id % 59 = 3 then '250000' else concat(event_id % 90 + 1, '.',"
            " lpad(cast(user_id % 10000 as string), 4, '0')) end",
            "source": "case when user_id % 2 = 0 then 'SIMULATED' else ' feed' end",
        },
    ),
    "orders": (
        "orders",
        None,
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "delivery_address_id": "o_custkey * 2 + o_orderkey % 2",
            "restaurant_id": "o_custkey div 15",
            "order_placed_at": "o_orderdate",
            "scheduled_delivery": "case when o_orderkey % 4 <> 0 then o_orderdate + interval 45 minutes end",
            "subtotal": "o_totalprice",
            "tax": "o_orderkey % 1000",
            "delivery_fee": "o_custkey % 10",
            "discount": "o_orderkey % 7",
            "total_amount": "cast(o_totalprice as decimal(12,2)) + o_orderkey % 1000 + o_custkey % 10"
            " - o_orderkey % 7 + case when o_orderkey % 50 = 0 then 1 else 0 end",
            "payment_method": "case o_orderpriority when '1-URGENT' then ' card' when '2-HIGH' then 'Paypal '"
            " when '3-MEDIUM' then 'cash' when '4-NOT SPECIFIED' then 'bank_transfer' else 'voucher' end",
            "payment_status": "case o_orderstatus when 'F' then 'paid' when 'O' then ' pending'"
            " else 'Authorized' end",
            "currency_id": "case when o_orderkey % 10 <> 0 then o_custkey % 5 end",
        },
    ),
    "order_items": (
        "lineitem",
        None,
        {
            "order_item_id": "l_orderkey * 10 + l_linenumber",
            "order_id": "l_orderkey",
            "menu_item_id": "l_partkey",
            "quantity": "l_quantity",
            "unit_price": "cast(floor(round(l_extendedprice * 100) / l_quantity) as decimal(12,0)) * 0.01",
            "line_total": "l_extendedprice",
        },
    ),
    "order_status_events": (
        "events",
        None,
        {
            "event_id": "event_id",
            "order_id": "user_id",
            "event_ts": "case when event_id % 53 = 0 or user_id % 50 = 7 then null else ts end",
            "status": "case when event_id % 101 = 0 then ' ' when event_type = 'signup' then ' placed'"
            " when event_type = 'view' then 'Accepted' when event_type = 'click' then 'picked_up'"
            " when event_type = 'purchase' then 'DELIVERED ' when event_id % 3 = 0 then 'canceled'"
            " when event_id % 3 = 1 then 'prep_start' else ' ready_for_pickup' end",
            "actor": "case event_id % 4 when 0 then 'system' when 1 then 'Restaurant ' when 2 then 'courier'"
            " else 'bot' end",
            "notes": "case when event_id % 2 = 0 then ' ' else concat(' ', props) end",
        },
    ),
    "delivery_assignments": (
        "orders",
        "o_orderstatus = 'F'",
        {
            "order_id": "o_orderkey",
            "courier_id": "o_custkey div 15",
            "assigned_at": "o_orderdate + interval 10 minutes",
            "pickup_eta": "case when o_orderkey % 6 = 0 then 'soon'"
            " else concat(cast(o_orderdate as date), ' 00:20:00') end",
            "dropoff_eta": "case when o_orderkey % 9 <> 0 then o_orderdate + interval 40 minutes end",
        },
    ),
    "refunds": (
        "lineitem",
        "l_returnflag = 'R'",
        {
            "refund_id": "cast(l_orderkey * 10 + l_linenumber as string)",
            "order_id": "l_orderkey",
            "refund_ts": "l_shipdate",
            "refund_reason": "case l_linenumber % 6 when 0 then 'late_delivery' when 1 then ' missing_item'"
            " when 2 then 'wrong_item ' when 3 then 'quality_issue' when 4 then 'Other' else 'goodwill' end",
            "refund_amount": "case when l_partkey % 100 = 0 then 'tbc'"
            " else cast(cast(l_extendedprice as decimal(12,2)) as string) end",
            "currency_id": "l_suppkey % 6",
        },
    ),
    "ratings": (
        "labels",
        None,
        {
            "rating_id": "doc_id",
            "order_id": "doc_id",
            "customer_id": "doc_id",
            "restaurant_rating": "quality * 4 + 1",
            "courier_rating": "case when doc_id % 3 <> 0 then toxic * 6 end",
            "comment": "case when toxic = 1 then ' ' else ' fine ' end",
            "created_at": "case when doc_id % 5 = 0 then 'n/a' else '2024-02-01 08:00:00' end",
        },
    ),
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source_table(
    spark: SparkSession, sf_dir: str, name: str, read: Callable[[SparkSession, str, str], DataFrame] = given
) -> DataFrame:
    """One source table as the operational system would hold it."""
    origin, keep, columns = DERIVED[name]
    df = read(spark, sf_dir, origin)
    if keep:
        df = df.where(keep)
    if name == "customer_addresses":
        df = df.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1))))
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


class RawTables(dict):
    """Raw tables by name, derived on first use, with their day columns."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self._read = cache(given)

    def source(self, name: str) -> DataFrame:
        return source_table(self.spark, self.sf_dir, name, self._read)

    def __missing__(self, name: str) -> DataFrame:
        df = self.source(name)
        if name == "order_items":
            orders = self.source("orders")
            df = with_parent_day(df, orders, "order_id", *DAY_COLUMNS[name])
        elif name in DAY_COLUMNS:
            df = with_day(df, *DAY_COLUMNS[name])
        self[name] = df
        return df


def menu_batches(source: DataFrame) -> list[DataFrame]:
    """Three states of the menu: new keys, changed, unchanged, missing and returning ones."""
    key = F.col("menu_item_id")
    late = key % 13 == 1
    renamed = F.when(key % 5 == 0, F.concat("category", F.lit(" 2"))).otherwise(F.col("category"))
    moved = F.when(key % 11 == 0, F.col("restaurant_id") + 1).otherwise(F.col("restaurant_id"))
    second = source.withColumn("category", renamed).withColumn("restaurant_id", moved)
    emptied = F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("category"))
    return [
        source.where(~late),
        second.where(~late & (key % 97 != 0)),
        second.withColumn("category", emptied),
    ]


def restaurant_batches(source: DataFrame) -> list[DataFrame]:
    key = F.col("restaurant_id")
    late = key % 13 == 1
    flipped = F.when(key % 5 == 0, ~F.col("is_active")).otherwise(F.col("is_active"))
    rebranded = F.when(key % 11 == 0, F.col("brand_id") + 1).otherwise(F.col("brand_id"))
    second = source.withColumn("is_active", flipped).withColumn("brand_id", rebranded)
    emptied = F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("city"))
    return [
        source.where(~late),
        second.where(~late & (key % 97 != 0)),
        second.withColumn("city", emptied),
    ]


def history(batches: list[DataFrame], key: str, check: tuple[str, ...]) -> DataFrame:
    """Merge the batches one after the other, at the fixed snapshot times."""
    merged = first_history(batches[0], key, SNAPSHOTS[0])
    for batch, at in zip(batches[1:], SNAPSHOTS[1:]):
        merged = merge_snapshot(merged, batch, key, check, at)
    return merged


class DerivedWarehouse(Warehouse):
    """The warehouse over the derived tables, with histories of three snapshots.

    The histories are written once and read back, as a persisted snapshot table is.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep=None, watch=None):
        super().__init__(RawTables(spark, sf_dir), keep=keep, watch=watch)

    def keys_of(self, table: str) -> DataFrame:
        # The day columns are not needed here, and the lines take theirs from a join.
        return self.raw.source(table)

    def merged_menu(self) -> DataFrame:
        return history(menu_batches(self.menu_items_snapshot_source), "menu_item_id", MENU_CHECK)

    def merged_restaurants(self) -> DataFrame:
        batches = restaurant_batches(self.restaurants_snapshot_source)
        return history(batches, "restaurant_id", RESTAURANT_CHECK)

    @cached_property
    def menu_history(self) -> DataFrame:
        return write_out(self.merged_menu(), "menu_history")

    @cached_property
    def restaurant_history(self) -> DataFrame:
        return write_out(self.merged_restaurants(), "restaurant_history")
