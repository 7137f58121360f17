"""Enrichment joins of the intermediate and gold layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import money
from millrace.operators.joins import lookup_join


#: Columns that ``reconcile`` adds.
RECONCILED = ("subtotal_minus_items", "expected_total_from_items", "expected_total_minus_total_amount")


def reconcile(orders: DataFrame) -> DataFrame:
    """Add the differences between header amounts and the items subtotal.

    Expects the header amounts and ``items_subtotal`` (NULL for an order without
    lines, which counts as zero).
    """
    items = F.coalesce("items_subtotal", F.lit(0).cast("decimal(22,2)"))
    expected = items + F.col("tax") + F.col("delivery_fee") - F.col("discount")

    def cents(amount):
        return F.round(amount, 2).cast("decimal(24,2)")

    return orders.select(
        "*",
        cents(F.col("subtotal") - items).alias("subtotal_minus_items"),
        cents(expected).alias("expected_total_from_items"),
        cents(expected - F.col("total_amount")).alias("expected_total_minus_total_amount"),
    )


def reconciliation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Header amounts against line amounts, one row per order."""
    header = orders.select("order_id", "subtotal", "tax", "delivery_fee", "discount", "total_amount")
    both = header.join(items.select("order_id", "items_subtotal"), "order_id", "left")
    return reconcile(both).select(
        "order_id",
        F.col("subtotal").alias("orders_subtotal"),
        F.coalesce("items_subtotal", F.lit(0).cast("decimal(22,2)")).alias("items_subtotal"),
        "subtotal_minus_items",
        "tax",
        "delivery_fee",
        "discount",
        "total_amount",
        "expected_total_from_items",
        "expected_total_minus_total_amount",
    )


def enrich_orders(
    orders: DataFrame, items: DataFrame, statuses: DataFrame, deliveries: DataFrame
) -> DataFrame:
    """Order header with line rollup, status rollup, delivery and reconciliation.

    All inputs have one row per order, so no key can be hot, and they share the
    key, so one partitioning by order serves every join; the reconciliation needs
    no join of its own.
    """
    for one_per_order in (items, statuses, deliveries):
        orders = orders.join(one_per_order, "order_id", "left")
    return reconcile(orders)


def lines_with_order(
    lines: DataFrame, orders: DataFrame, keys_from: DataFrame | None = None
) -> DataFrame:
    """Order lines with the context of their order; lines of unknown orders are kept."""
    header = orders.select(
        "order_id", "customer_id", "restaurant_id", "currency_id", "order_placed_at", "order_date_utc"
    )
    body = lines.select("order_item_id", "order_id", "menu_item_id", "quantity", "unit_price", "line_total")
    joined = lookup_join(body, header, "order_id", keys_from=keys_from)
    return joined.select(*body.columns, *header.columns[1:])


def enrich_lines(
    lines_in_context: DataFrame, menu_items: DataFrame, keys_from: DataFrame | None = None
) -> DataFrame:
    """Add the menu item of each line, and whether item and order agree on the restaurant."""
    menu = menu_items.select(
        "menu_item_id",
        F.col("restaurant_id").alias("item_restaurant_id"),
        "item_name",
        "category",
        F.col("price_amount").alias("menu_price"),
        "is_available",
    )
    same = F.col("item_restaurant_id") == F.col("restaurant_id")
    return lookup_join(lines_in_context, menu, "menu_item_id", keys_from=keys_from).select(
        *lines_in_context.columns, *menu.columns[2:], same.alias("is_menu_item_from_order_restaurant")
    )


#: Columns of the enriched refunds.
REFUND_COLUMNS = (
    "refund_id",
    "order_id",
    "customer_id",
    "restaurant_id",
    "courier_id",
    "refund_ts",
    "refund_reason",
    "refund_amount",
    "currency_id",
    "refund_date_utc",
    "order_placed_at",
    "order_date_utc",
    "latest_status",
    "delivered_at",
    "canceled_at",
    "total_amount",
    "items_subtotal",
    "expected_total_minus_total_amount",
    "is_refund_not_exceed_total",
)


def enrich_refunds(refunds: DataFrame, enriched_orders: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Refunds with the context of their order; ``also`` names further columns of the order."""
    context = enriched_orders.select(
        "order_id",
        "customer_id",
        "restaurant_id",
        "courier_id",
        "order_placed_at",
        "order_date_utc",
        "latest_status",
        "delivered_at",
        "canceled_at",
        "total_amount",
        "items_subtotal",
        "expected_total_minus_total_amount",
        *also,
    )
    joined = lookup_join(refunds, context, "order_id")
    within = money("refund_amount") <= F.col("total_amount")
    return joined.withColumn("is_refund_not_exceed_total", within).select(*REFUND_COLUMNS, *also)


def role_playing(facts: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str], attributes: Sequence[str]) -> DataFrame:
    """Look the same dimension up once per role.

    ``roles`` maps a prefix to the fact's foreign key; attributes come back as
    ``<prefix>_<attribute>``.
    """
    out = facts
    for prefix, fk in roles.items():
        names = [F.col(a).alias(f"{prefix}_{a}") for a in attributes]
        role = dimension.select(F.col(key).alias(f"{prefix}_key"), *names)
        out = lookup_join(out, role, {fk: f"{prefix}_key"}, keys_from=facts)
    return out
