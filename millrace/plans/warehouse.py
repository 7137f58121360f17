"""The star schema: every model of the warehouse as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.calendar import date_dimension
from millrace.operators.enrich import (
    REFUND_COLUMNS,
    enrich_lines,
    enrich_orders,
    enrich_refunds,
    lines_with_order,
    reconciliation,
    role_playing,
)
from millrace.operators.joins import lookup_join, packed, unpacked
from millrace.operators.quality import Watch
from millrace.operators.rollup import line_rollup, milestone_rollup
from millrace.operators.scd2 import asof_join, backfill_first, version_dimension
from millrace.plans.staging import STAGED, stage
from millrace.session import run_together

# Milestone columns and the status each one records, flags,
# durations, and the columns whose changes open a new version.
MILESTONES = {
    "placed_at": "PLACED",
    "accepted_at": "ACCEPTED",
    "prep_start_at": "PREP_START",
    "ready_for_pickup_at": "READY_FOR_PICKUP",
    "picked_up_at": "PICKED_UP",
    "delivered_at": "DELIVERED",
    "canceled_at": "CANCELED",
}
FLAGS = {"is_delivered": "delivered_at", "is_canceled": "canceled_at"}
DURATIONS = {
    "minutes_to_accept": ("placed_at", "accepted_at"),
    "minutes_to_pickup": ("placed_at", "picked_up_at"),
    "minutes_to_deliver": ("placed_at", "delivered_at"),
    "minutes_pickup_to_deliver": ("picked_up_at", "delivered_at"),
}
RESTAURANT_CHECK = (
    "brand_name",
    "brand_is_active",
    "outlet_name",
    "city",
    "delivery_zone",
    "address_line1",
    "postal_code",
    "is_active",
)
MENU_CHECK = ("item_name", "category")


# Nodes that readers share, in an order in which each level needs earlier ones only. The large facts
# have levels of their own: each fills a cluster, and side by side their shuffles would lie on disk together.
KEPT_TOGETHER = (
    ("menu_history", "restaurant_history", "items_rollup", "status_rollup", "lines_with_order"),
    ("dim_menu_items_backfill", "dim_restaurants_backfill"),
    ("fct_order_items",),
    ("fct_orders",),
    ("refunds_in_context",),
    ("fct_refunds",),
)


def menu_snapshot_source(menu_items: DataFrame) -> DataFrame:
    return menu_items.select("menu_item_id", "restaurant_id", "item_name", "category")


def restaurant_snapshot_source(outlets: DataFrame, brands: DataFrame) -> DataFrame:
    """Outlets with the attributes of their brand; outlets of unknown brands are kept."""
    brand = brands.select("brand_id", "brand_name", F.col("is_active").alias("brand_is_active"))
    outlet = outlets.select(
        "restaurant_id",
        "brand_id",
        "outlet_name",
        "city",
        "delivery_zone",
        "address_line1",
        "postal_code",
        "is_active",
    )
    joined = lookup_join(outlet, brand, "brand_id")
    return joined.select("restaurant_id", "brand_id", "brand_name", "brand_is_active", *outlet.columns[2:])


class Warehouse:
    """All models over a set of raw tables and the two dimension histories.

    Models are attributes and are built on first use; nothing runs until an
    action. ``keep`` is applied to the nodes that several models read: pass
    ``session.write_out`` to compute each of them once, or leave it out to let
    every query expand them.
    """

    def __init__(
        self,
        raw: dict[str, DataFrame],
        menu_history: DataFrame | None = None,
        restaurant_history: DataFrame | None = None,
        keep: Callable[[DataFrame, str], DataFrame] | None = None,
        watch: Watch | None = None,
    ):
        self.raw = raw
        if menu_history is not None:
            self.menu_history = menu_history
        if restaurant_history is not None:
            self.restaurant_history = restaurant_history
        self.shared = keep is not None
        self.watch = watch
        self.keep = keep or (lambda df, name: df)
        self._staged: dict[str, DataFrame] = {}

    def staged(self, table: str) -> DataFrame:
        if table not in self._staged:
            self._staged[table] = stage(table, self.raw[table])
        return self._staged[table]

    def keys_of(self, table: str) -> DataFrame:
        """A staged table for scans of its keys only, to find hot ones."""
        return self.staged(table)

    def prepare(self) -> None:
        """Compute the kept nodes, those that do not need each other side by side."""
        if self.shared:
            for level in KEPT_TOGETHER:
                run_together([lambda name=name: getattr(self, name) for name in level])

    # Intermediate models

    @cached_property
    def menu_items_snapshot_source(self) -> DataFrame:
        return menu_snapshot_source(self.staged("menu_items"))

    @cached_property
    def restaurants_snapshot_source(self) -> DataFrame:
        return restaurant_snapshot_source(
            self.staged("restaurant_outlets"), self.staged("restaurant_brands")
        )

    @cached_property
    def items_rollup(self) -> DataFrame:
        rolled = line_rollup(
            self.staged("order_items"),
            "order_id",
            "menu_item_id",
            "quantity",
            "line_total",
            keys_from=self.keys_of("order_items"),
        )
        return self.keep(rolled, "items_rollup")

    @cached_property
    def status_rollup(self) -> DataFrame:
        rolled = milestone_rollup(
            self.staged("order_status_events"),
            "order_id",
            "event_ts",
            "status",
            "event_id",
            MILESTONES,
            FLAGS,
            DURATIONS,
        )
        return self.keep(rolled, "status_rollup")

    @cached_property
    def delivery_enriched(self) -> DataFrame:
        return self.staged("delivery_assignments").select(
            "order_id", "courier_id", "assigned_at", "pickup_eta", "dropoff_eta"
        )

    @cached_property
    def orders_reconciliation(self) -> DataFrame:
        return reconciliation(self.staged("orders"), self.items_rollup)

    def _enriched(self, orders: DataFrame) -> DataFrame:
        return enrich_orders(orders, self.items_rollup, self.status_rollup, self.delivery_enriched)

    @cached_property
    def orders_enriched(self) -> DataFrame:
        if self.shared:
            # The kept order fact without its dimension key: the wide join exists once.
            return self.fct_orders.drop("restaurant_sk", "is_current_restaurant_details")
        return self._enriched(self.staged("orders"))

    @cached_property
    def lines_with_order(self) -> DataFrame:
        found = lines_with_order(self.staged("order_items"), self.staged("orders"), self.keys_of("order_items"))
        return self.keep(found, "lines_with_order")

    @cached_property
    def order_items_enriched(self) -> DataFrame:
        return enrich_lines(self.lines_with_order, self.staged("menu_items"), self.keys_of("order_items"))

    @cached_property
    def refunds_enriched(self) -> DataFrame:
        if self.shared:
            return self.refunds_in_context.select(*REFUND_COLUMNS)
        return enrich_refunds(self.staged("refunds"), self.orders_enriched)

    @cached_property
    def refunds_in_context(self) -> DataFrame:
        """Refunds with all that the enriched refunds and the refund fact take from their order, for kept nodes: one join serves both."""
        also = ["payment_method", "payment_status", "restaurant_sk", "items_total_qty", "item_lines", "distinct_menu_items"]
        orders = packed(self.fct_orders, "restaurant_sk")
        carried = [c for c in orders.columns if c in also or c not in self.fct_orders.columns]
        found = unpacked(enrich_refunds(self.staged("refunds"), orders, carried), "restaurant_sk")
        return self.keep(found.select(*REFUND_COLUMNS, *also), "refunds_enriched")

    # Dimensions

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self.staged("customers").select(*STAGED["customers"])

    @cached_property
    def dim_customer_addresses(self) -> DataFrame:
        return self.staged("customer_addresses").select(*STAGED["customer_addresses"])

    @cached_property
    def dim_couriers(self) -> DataFrame:
        return self.staged("couriers").select(*STAGED["couriers"])

    @cached_property
    def dim_currencies(self) -> DataFrame:
        return self.staged("currencies").select(*STAGED["currencies"])

    @cached_property
    def dim_date(self) -> DataFrame:
        tables = {
            "orders": "order_date_utc",
            "order_status_events": "event_date_utc",
            "refunds": "refund_date_utc",
            "fx_rates": "rate_date_utc",
        }
        return date_dimension([(self.days_of(table, day), day) for table, day in tables.items()])

    def days_of(self, table: str, day: str) -> DataFrame:
        """A relation with the staged days of a table."""
        return self.staged(table)

    @cached_property
    def dim_restaurants(self) -> DataFrame:
        columns = ["restaurant_id", "brand_id", *RESTAURANT_CHECK]
        return version_dimension(self.restaurant_history, "restaurant_sk", columns)

    @cached_property
    def dim_menu_items(self) -> DataFrame:
        columns = ["menu_item_id", "restaurant_id", *MENU_CHECK]
        return version_dimension(self.menu_history, "menu_item_sk", columns)

    @cached_property
    def dim_restaurants_backfill(self) -> DataFrame:
        return self.keep(backfill_first(self.dim_restaurants, "restaurant_id"), "dim_restaurants_backfill")

    @cached_property
    def dim_menu_items_backfill(self) -> DataFrame:
        return self.keep(backfill_first(self.dim_menu_items, "menu_item_id"), "dim_menu_items_backfill")

    # Facts

    @cached_property
    def fct_orders(self) -> DataFrame:
        # The header is bound to its version before it grows to forty columns. The
        # binding keeps one row per order, so the enrichment is the same as without.
        versions = self.dim_restaurants_backfill.withColumnRenamed("is_current", "is_current_restaurant_details")
        bound = asof_join(
            self.staged("orders"),
            versions,
            "restaurant_id",
            "order_placed_at",
            ["restaurant_sk", "is_current_restaurant_details"],
            keys_from=self.keys_of("orders"),
        )
        narrow = packed(bound, "restaurant_sk")
        enriched = self._enriched(narrow)
        added = [c for c in enriched.columns if c not in narrow.columns]
        return self.keep(unpacked(enriched, "restaurant_sk").select(*bound.columns, *added), "fct_orders")

    @cached_property
    def fct_order_items(self) -> DataFrame:
        versions = self.dim_menu_items_backfill.withColumnRenamed("is_current", "is_current_menu_item_details")
        # The fact has no attribute of the current menu, so that lookup is left out.
        bound = asof_join(
            self.lines_with_order,
            versions,
            "menu_item_id",
            "order_placed_at",
            ["menu_item_sk", "is_current_menu_item_details"],
            keys_from=self.keys_of("order_items"),
        )
        fact = bound.select(
            "order_item_id",
            "order_id",
            "menu_item_id",
            "menu_item_sk",
            "is_current_menu_item_details",
            "customer_id",
            "restaurant_id",
            "currency_id",
            "order_placed_at",
            "order_date_utc",
            "quantity",
            "unit_price",
            "line_total",
        )
        return self.keep(fact, "fct_order_items")

    @cached_property
    def fct_refunds(self) -> DataFrame:
        context = ["order_id", "customer_id", "restaurant_id", "total_amount", "payment_method", "payment_status"]
        if self.shared:
            # The kept refunds hold the order context, the line rollup and the dimension key.
            joined = self.refunds_in_context
        else:
            refunds = self.staged("refunds")
            # Refunds meet their orders first, so only theirs are bound to a version.
            headers = self.staged("orders").select(*context, "order_placed_at")
            joined = lookup_join(refunds, [headers, self.items_rollup], "order_id", keys_from=self.keys_of("refunds"))
            versions = self.dim_restaurants_backfill
            joined = asof_join(joined, versions, "restaurant_id", "order_placed_at", ["restaurant_sk"], keys_from=self.keys_of("orders"))
        within = F.col("refund_amount") <= F.col("total_amount")
        joined = joined.withColumn("is_refund_not_exceed_total", within)
        fact = joined.select(
            "refund_id",
            "order_id",
            "customer_id",
            "restaurant_id",
            "restaurant_sk",
            "currency_id",
            "refund_ts",
            "refund_date_utc",
            "refund_reason",
            "refund_amount",
            "payment_method",
            "payment_status",
            "items_subtotal",
            "items_total_qty",
            "item_lines",
            "distinct_menu_items",
            "is_refund_not_exceed_total",
        )
        return self.keep(fact, "fct_refunds")

    @cached_property
    def fct_fx_rates(self) -> DataFrame:
        roles = {"base": "base_currency_id", "quote": "quote_currency_id"}
        both = role_playing(
            self.staged("fx_rates"), self.dim_currencies, "currency_id", roles, ["currency_code"]
        )
        return both.select(
            "fx_rate_id",
            "base_currency_id",
            "base_currency_code",
            "quote_currency_id",
            "quote_currency_code",
            "rate_ts",
            "rate_date_utc",
            "rate",
            "source",
        )
