"""Declared checks of every layer.

The raw layer is described once per table; the staging checks follow from it by
rule, since staging keeps the columns and only cleans and renames them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join
from millrace.operators.quality import ROW_KINDS, Check, duplicates, out_of_order, tolerance_mismatch
from millrace.plans.staging import STAGED, source_of, staged_column

# Domains of the categorical columns.
LABELS = ("HOME", "WORK", "OTHER")
VEHICLES = ("BIKE", "SCOOTER", "CAR")
METHODS = ("CARD", "DIGITAL_WALLET", "CONTACTLESS_NFC", "CASH", "PAYPAL", "BANK_TRANSFER")
PAYMENTS = ("PENDING", "AUTHORIZED", "PAID", "FAILED", "REFUNDED")
STATUSES = (
    "PLACED",
    "ACCEPTED",
    "PREP_START",
    "READY_FOR_PICKUP",
    "PICKED_UP",
    "DELIVERED",
    "CANCELED",
)
ACTORS = ("SYSTEM", "RESTAURANT", "COURIER", "CUSTOMER")
REASONS = ("LATE_DELIVERY", "MISSING_ITEM", "WRONG_ITEM", "QUALITY_ISSUE", "OTHER")
CURRENCIES = ("AUD", "INR", "USD")


@dataclass(frozen=True)
class Rules:
    """What holds for one relation."""

    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    combinations: tuple[tuple[tuple[str, ...], str | None], ...] = ()  # (columns, where)
    expressions: tuple[str, ...] = ()

    def checks(self, relation: str, layer: str = "") -> list[Check]:
        out = [Check("not_null", relation, (c,)) for c in self.required]
        out += [Check("unique", relation, (c,)) for c in self.unique]
        out += [
            Check("relationships", relation, (c,), parent=(layer + p, column))
            for c, (p, column) in self.parents.items()
        ]
        out += [Check("accepted_values", relation, (c,), v) for c, v in self.domains.items()]
        out += [Check("accepted_range", relation, (c,), v) for c, v in self.ranges.items()]
        out += [
            Check("unique_combination", relation, c, where=w) for c, w in self.combinations
        ]
        out += [Check("expression_is_true", relation, expression=e) for e in self.expressions]
        return out


# The rules of the raw tables.
RAW = {
    "customers": Rules(("customer_id", "full_name", "email", "created_at"), ("customer_id", "email")),
    "customer_addresses": Rules(
        ("address_id", "customer_id", "label", "line_1", "city", "country", "is_default", "created_at"),
        ("address_id",),
        {"customer_id": ("customers", "customer_id")},
        {"label": LABELS},
    ),
    "restaurant_brands": Rules(("brand_id", "brand_name", "is_active", "created_at"), ("brand_id", "brand_name")),
    "restaurant_outlets": Rules(
        ("restaurant_id", "brand_id", "outlet_name", "city", "delivery_zone", "is_active", "created_at"),
        ("restaurant_id",),
        {"brand_id": ("restaurant_brands", "brand_id")},
    ),
    "menu_items": Rules(
        ("menu_item_id", "restaurant_id", "item_name", "category", "price", "is_available", "created_at"),
        ("menu_item_id",),
        {"restaurant_id": ("restaurant_outlets", "restaurant_id")},
    ),
    "couriers": Rules(
        ("courier_id", "city", "vehicle", "is_active", "created_at"), ("courier_id",), domains={"vehicle": VEHICLES}
    ),
    "currencies": Rules(
        ("currency_id", "currency_code", "currency_name", "is_active", "created_at"), ("currency_id", "currency_code")
    ),
    "fx_rates": Rules(
        ("fx_rate_id", "base_currency_id", "quote_currency_id", "rate_ts", "rate"),
        ("fx_rate_id",),
        {
            "base_currency_id": ("currencies", "currency_id"),
            "quote_currency_id": ("currencies", "currency_id"),
        },
    ),
    "orders": Rules(
        ("order_id", "customer_id", "delivery_address_id", "restaurant_id", "order_placed_at", "subtotal", "tax", "delivery_fee", "discount", "total_amount", "payment_method", "payment_status"),
        ("order_id",),
        {
            "customer_id": ("customers", "customer_id"),
            "delivery_address_id": ("customer_addresses", "address_id"),
            "restaurant_id": ("restaurant_outlets", "restaurant_id"),
            "currency_id": ("currencies", "currency_id"),
        },
        {"payment_method": METHODS, "payment_status": PAYMENTS},
    ),
    "order_items": Rules(
        ("order_item_id", "order_id", "menu_item_id", "quantity", "unit_price", "line_total"),
        ("order_item_id",),
        {"order_id": ("orders", "order_id"), "menu_item_id": ("menu_items", "menu_item_id")},
    ),
    "order_status_events": Rules(
        ("event_id", "order_id", "event_ts", "status", "actor"),
        ("event_id",),
        {"order_id": ("orders", "order_id")},
        {"status": STATUSES, "actor": ACTORS},
    ),
    "delivery_assignments": Rules(
        ("order_id", "courier_id", "assigned_at"),
        ("order_id",),
        {"order_id": ("orders", "order_id"), "courier_id": ("couriers", "courier_id")},
    ),
    "refunds": Rules(
        ("refund_id", "order_id", "refund_ts", "refund_reason", "refund_amount"),
        ("refund_id",),
        {"order_id": ("orders", "order_id"), "currency_id": ("currencies", "currency_id")},
        {"refund_reason": REASONS},
    ),
    "ratings": Rules(
        ("rating_id", "order_id", "customer_id", "restaurant_rating", "created_at"),
        ("rating_id", "order_id"),
        {"order_id": ("orders", "order_id"), "customer_id": ("customers", "customer_id")},
    ),
}

# Raw requirements that staging does not repeat. Creation times are
# only repeated for customers, references only outside the rates.
NOT_STAGED = {
    "customers": ("full_name",),
    "customer_addresses": ("line_1",),
    "currencies": ("currency_name",),
    "orders": ("subtotal", "tax", "delivery_fee", "discount", "total_amount"),
}

# The rules of the models.
MODELS = {
    "int_items_rollup": Rules(("order_id",), ("order_id",)),
    "int_status_rollup": Rules(
        ("order_id", "latest_status"), ("order_id",), domains={"latest_status": STATUSES}
    ),
    "int_delivery_enriched": Rules(("order_id", "courier_id"), ("order_id",)),
    "int_orders_reconciliation": Rules(("order_id",), ("order_id",)),
    "int_orders_enriched": Rules(("order_id",), ("order_id",)),
    "int_order_items_enriched": Rules(
        ("order_item_id", "order_id", "menu_item_id", "quantity", "line_total"),
        ("order_item_id",),
        {"order_id": ("stg_orders", "order_id"), "menu_item_id": ("stg_menu_items", "menu_item_id")},
    ),
    "int_refunds_enriched": Rules(
        ("refund_id", "order_id", "refund_ts", "refund_reason", "refund_amount"),
        ("refund_id", "order_id"),
        {"order_id": ("int_orders_enriched", "order_id")},
    ),
    "dim_customers": Rules(
        ("customer_id", "email"),
        ("email",),
        combinations=((("customer_id",), None),),
        expressions=("email like '%@%'",),
    ),
    "dim_customer_addresses": Rules(
        ("address_id", "customer_id", "is_default"),
        parents={"customer_id": ("dim_customers", "customer_id")},
        combinations=((("address_id",), None),),
    ),
    "dim_restaurants": Rules(
        ("restaurant_sk", "restaurant_id", "valid_from", "is_current"),
        combinations=((("restaurant_sk",), None), (("restaurant_id",), "is_current")),
        expressions=("valid_to is null or valid_to > valid_from",),
    ),
    "dim_menu_items": Rules(
        ("menu_item_sk", "menu_item_id", "valid_from", "is_current"),
        combinations=((("menu_item_sk",), None), (("menu_item_id",), "is_current")),
        expressions=("valid_to is null or valid_to > valid_from",),
    ),
    "dim_couriers": Rules(
        ("courier_id", "vehicle", "is_active"),
        domains={"vehicle": VEHICLES},
        combinations=((("courier_id",), None),),
    ),
    "dim_currencies": Rules(
        ("currency_id", "currency_code", "is_active"),
        ("currency_code",),
        domains={"currency_code": CURRENCIES},
        combinations=((("currency_id",), None),),
    ),
    "dim_date": Rules(
        ("date_utc", "year_utc", "month_utc"),
        ranges={"year_utc": (2000, 2100), "month_utc": (1, 12)},
        combinations=((("date_utc",), None),),
    ),
    "fct_orders": Rules(
        ("order_id", "customer_id", "delivery_address_id", "restaurant_sk", "payment_method", "payment_status"),
        parents={
            "customer_id": ("dim_customers", "customer_id"),
            "delivery_address_id": ("dim_customer_addresses", "address_id"),
            "currency_id": ("dim_currencies", "currency_id"),
            "restaurant_sk": ("dim_restaurants", "restaurant_sk"),
        },
        domains={"payment_method": METHODS, "payment_status": PAYMENTS},
        combinations=((("order_id",), None),),
        expressions=(
            "total_amount >= 0 and subtotal >= 0 and tax >= 0 and delivery_fee >= 0 and discount >= 0",
        ),
    ),
    "fct_order_items": Rules(
        ("order_item_id", "order_id", "menu_item_sk"),
        parents={
            "order_id": ("fct_orders", "order_id"),
            "menu_item_sk": ("dim_menu_items", "menu_item_sk"),
        },
        combinations=((("order_item_id",), None),),
        expressions=("quantity >= 1 and line_total >= 0",),
    ),
    "fct_refunds": Rules(
        ("refund_id", "order_id", "refund_ts", "refund_reason"),
        parents={
            "order_id": ("fct_orders", "order_id"),
            "restaurant_sk": ("dim_restaurants", "restaurant_sk"),
        },
        domains={"refund_reason": REASONS},
        combinations=((("refund_id",), None),),
        expressions=("refund_amount >= 0",),
    ),
}


def staged_rules(table: str) -> Rules:
    """The rules of a staged table, derived from those of its raw table."""
    raw = RAW[table]
    renamed = {source_of(t, e)[1]: t for t, e in STAGED[table].items()}
    dropped = set(NOT_STAGED.get(table, ()))
    if table != "customers":
        dropped.add("created_at")

    def names(columns: tuple[str, ...]) -> tuple[str, ...]:
        return tuple(renamed[c] for c in columns if c not in dropped)

    return Rules(
        names(raw.required),
        names(raw.unique),
        {} if table == "fx_rates" else raw.parents,
        raw.domains,
    )


def declared_checks() -> list[Check]:
    """All declared checks, from raw to gold."""
    out: list[Check] = []
    for table, rules in RAW.items():
        out += rules.checks(f"raw_{table}", "raw_")
    for table in RAW:
        out += staged_rules(table).checks(f"stg_{table}", "stg_")
    for model, rules in MODELS.items():
        out += rules.checks(model)
    return out


def relations(warehouse, *checks: Check) -> dict[str, DataFrame]:
    """The relations that the checks read, by name."""
    names = {c.relation for c in checks} | {c.parent[0] for c in checks if c.parent}
    found = {}
    for name in sorted(names):
        layer, _, table = name.partition("_")
        if layer == "raw":
            found[name] = warehouse.raw[table]
        elif layer == "stg":
            found[name] = warehouse.staged(table)
        else:
            found[name] = getattr(warehouse, name.removeprefix("int_"))
    return found


#: Nodes that a warehouse keeps, with the relations that have their rows and columns.
KEPT_AS = {
    "items_rollup": ("int_items_rollup",),
    "status_rollup": ("int_status_rollup",),
    "refunds_enriched": ("int_refunds_enriched",),
    "fct_orders": ("fct_orders", "int_orders_enriched"),
    "fct_order_items": ("fct_order_items",),
    "fct_refunds": ("fct_refunds",),
}


def raw_with_staged(warehouse, checks: list[Check]) -> list[tuple[DataFrame, dict[str, str]]]:
    """Raw tables with the staged columns that ``checks`` read beside them: both layers are checked in one scan."""
    used: dict[str, set[str]] = {}
    for c in checks:
        if c.kind in ROW_KINDS:
            used.setdefault(c.relation, set()).update(c.columns)
    found = []
    for table, entries in STAGED.items():
        raw, wanted = warehouse.raw[table], used.get(f"stg_{table}")
        if wanted:
            staged = [staged_column(target, entry, raw) for target, entry in entries.items() if target in wanted]
            found.append((raw.select("*", F.struct(*staged).alias("__staged")), {f"raw_{table}": "", f"stg_{table}": "__staged"}))
    return found


# Business rules across columns and tables. Each gives its violating rows.


def same_currency_pair(rates: DataFrame) -> DataFrame:
    rows = rates.where(F.col("base_currency_id") == F.col("quote_currency_id"))
    return rows.select("fx_rate_id", "base_currency_id", "quote_currency_id")


def unreasonable_rate(rates: DataFrame) -> DataFrame:
    return rates.where((F.col("rate") <= 0) | (F.col("rate") > 100000)).select("fx_rate_id", "rate")


def repeated_rate(rates: DataFrame) -> DataFrame:
    return duplicates(rates, ["base_currency_id", "quote_currency_id", "rate_ts"])


def implication(df: DataFrame, premise: Column, conclusion: Column, columns: list[str]) -> DataFrame:
    """Rows for which the premise holds and the conclusion does not."""
    return df.where(premise & ~conclusion).select(*columns)


def delivered_without_time(orders: DataFrame) -> DataFrame:
    return implication(orders, F.col("is_delivered"), F.col("delivered_at").isNotNull(), ["order_id"])


def subtotal_mismatch(orders: DataFrame) -> DataFrame:
    """Orders with lines whose subtotal differs from the lines by more than 0.05."""
    differs = tolerance_mismatch(F.col("subtotal"), F.col("items_subtotal"))
    diff = F.round(F.col("subtotal") - F.col("items_subtotal"), 2).cast("decimal(24,2)")
    return orders.where(differs).select("order_id", "subtotal", "items_subtotal", diff.alias("diff"))


def milestones_out_of_order(orders: DataFrame) -> DataFrame:
    steps = ["accepted_at", "picked_up_at", "delivered_at"]
    return orders.where(out_of_order(*steps)).select("order_id", *steps)


def total_mismatch(orders: DataFrame) -> DataFrame:
    """Orders whose total differs from their parts by more than 0.05."""
    expected = F.col("subtotal") + F.col("tax") + F.col("delivery_fee") - F.col("discount")
    wide = "decimal(24,2)"
    return orders.where(tolerance_mismatch(F.col("total_amount"), expected)).select(
        "order_id",
        "subtotal",
        "tax",
        "delivery_fee",
        "discount",
        "total_amount",
        F.round(expected, 2).cast(wide).alias("expected_total"),
        F.round(F.col("total_amount") - expected, 2).cast(wide).alias("diff"),
    )


def _with_order(refunds: DataFrame, orders: DataFrame, column: str, keys_from: DataFrame | None) -> DataFrame:
    """Refunds with one column of their order; refunds without an order are left out."""
    return lookup_join(refunds, orders.select("order_id", column), "order_id", "inner", keys_from=keys_from)


def refund_before_order(
    refunds: DataFrame, orders: DataFrame, keys_from: DataFrame | None = None
) -> DataFrame:
    both = _with_order(refunds, orders, "order_placed_at", keys_from)
    early = both.where(F.col("refund_ts") < F.col("order_placed_at"))
    return early.select("refund_id", "order_id", "refund_ts", "order_placed_at")


def refund_above_total(
    refunds: DataFrame, orders: DataFrame, keys_from: DataFrame | None = None
) -> DataFrame:
    both = _with_order(refunds, orders, "total_amount", keys_from)
    allowed = F.col("total_amount") + F.lit("0.01").cast("decimal(3,2)")
    above = both.where(F.col("refund_amount") > allowed)
    return above.select("refund_id", "order_id", "refund_amount", "total_amount")


def business_rules(warehouse) -> dict[str, DataFrame]:
    """The nine business rules on the gold facts."""
    rates, orders, refunds = warehouse.fct_fx_rates, warehouse.fct_orders, warehouse.fct_refunds
    return {
        "fx_no_same_currency_pair": same_currency_pair(rates),
        "fx_rate_positive_reasonable": unreasonable_rate(rates),
        "fx_unique_pair_ts": repeated_rate(rates),
        "orders_delivered_has_time": delivered_without_time(orders),
        "orders_subtotal_matches_items": subtotal_mismatch(orders),
        "orders_milestone_order": milestones_out_of_order(orders),
        "orders_total_consistency": total_mismatch(orders),
        "refunds_after_order": refund_before_order(refunds, orders, warehouse.staged("refunds")),
        "refunds_within_total": refund_above_total(refunds, orders, warehouse.staged("refunds")),
    }


# The constraints of the operational schema, checked on staged tables.
CONSTRAINTS = {
    "menu_items": Rules(expressions=("price_amount >= 0",)),
    "orders": Rules(
        domains={"payment_method": METHODS, "payment_status": PAYMENTS},
        expressions=(
            "subtotal >= 0",
            "tax >= 0",
            "delivery_fee >= 0",
            "discount >= 0",
            "total_amount >= 0",
            "round(subtotal + tax + delivery_fee - discount, 2) = round(total_amount, 2)",
        ),
    ),
    "order_items": Rules(
        expressions=(
            "quantity > 0",
            "unit_price >= 0",
            "line_total >= 0",
            "round(quantity * unit_price, 2) = round(line_total, 2)",
        )
    ),
    "refunds": Rules(domains={"refund_reason": REASONS}, expressions=("refund_amount >= 0",)),
    "ratings": Rules(
        unique=("order_id",), ranges={"restaurant_rating": (1, 5), "courier_rating": (1, 5)}
    ),
    "fx_rates": Rules(
        combinations=((("base_currency_id", "quote_currency_id", "rate_ts"), None),),
        expressions=("rate > 0", "base_currency_id <> quote_currency_id"),
    ),
    "customers": Rules(unique=("email",)),
    "restaurant_brands": Rules(unique=("brand_name",)),
    "restaurant_outlets": Rules(combinations=((("brand_id", "outlet_name", "city", "delivery_zone"), None),)),
    "customer_addresses": Rules(
        domains={"label": LABELS}, combinations=((("customer_id",), "is_default"),)
    ),
    "delivery_assignments": Rules(unique=("order_id",)),
    "currencies": Rules(unique=("currency_code",)),
    "order_status_events": Rules(domains={"status": STATUSES, "actor": ACTORS}),
    "couriers": Rules(domains={"vehicle": VEHICLES}),
}


def constraint_checks() -> list[Check]:
    return [c for table, rules in CONSTRAINTS.items() for c in rules.checks(f"stg_{table}", "stg_")]
