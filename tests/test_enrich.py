from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.calendar import date_dimension
from millrace.operators.enrich import enrich_lines, enrich_refunds, lines_with_order, reconciliation, role_playing


def money(df, *columns):
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in columns})


@pytest.fixture(scope="module")
def orders(spark):
    data = [(1, 7, 5, 1, "10", "1", "2", "0.5", "12.5"), (2, 8, 6, None, "20", "0", "0", "0", "21")]
    df = spark.createDataFrame(
        data,
        "order_id long, customer_id long, restaurant_id long, currency_id long, subtotal string, tax string,"
        " delivery_fee string, discount string, total_amount string",
    )
    df = money(df, "subtotal", "tax", "delivery_fee", "discount", "total_amount")
    return df.withColumn("order_placed_at", F.lit(datetime(2024, 1, 1))).withColumn(
        "order_date_utc", F.lit(date(2024, 1, 1))
    )


def test_reconciliation(spark, orders):
    items = money(spark.createDataFrame([(1, "9.75")], "order_id long, items_subtotal string"), "items_subtotal")
    got = {r.order_id: r for r in reconciliation(orders, items).collect()}
    assert [str(x) for x in got[1][2:4]] == ["9.75", "0.25"]
    assert (str(got[1].expected_total_from_items), str(got[1].expected_total_minus_total_amount)) == ("12.25", "-0.25")
    # An order without lines counts as zero.
    assert (str(got[2].items_subtotal), str(got[2].subtotal_minus_items)) == ("0.00", "20.00")
    assert str(got[2].expected_total_minus_total_amount) == "-21.00"


def test_line_enrichment_keeps_every_line(spark, orders):
    lines = spark.createDataFrame(
        [(1, 1, 100), (2, 1, 101), (3, 9, 100), (4, 1, 999)], "order_item_id long, order_id long, menu_item_id long"
    ).select("*", F.lit(1).alias("quantity"), F.lit(1).alias("unit_price"), F.lit(1).alias("line_total"))
    menu = spark.createDataFrame(
        [(100, 5, "x", "c", 1.0, True), (101, 6, "y", "c", 1.0, True)],
        "menu_item_id long, restaurant_id long, item_name string, category string, price_amount double, is_available boolean",
    )
    out = enrich_lines(lines_with_order(lines, orders), menu)
    flags = {r.order_item_id: r.is_menu_item_from_order_restaurant for r in out.collect()}
    assert flags == {1: True, 2: False, 3: None, 4: None}


def test_refund_enrichment(spark, orders):
    enriched = orders
    for name in ("courier_id", "latest_status", "delivered_at", "canceled_at", "items_subtotal", "expected_total_minus_total_amount"):
        enriched = enriched.withColumn(name, F.lit(None).cast("string"))
    refunds = money(
        spark.createDataFrame([(1, 1, "12.5"), (2, 1, "12.51"), (3, 77, "1"), (4, 2, None)], "refund_id long, order_id long, refund_amount string"),
        "refund_amount",
    )
    for name in ("refund_ts", "refund_reason", "currency_id", "refund_date_utc"):
        refunds = refunds.withColumn(name, F.lit(None).cast("string"))
    out = enrich_refunds(refunds, enriched)
    assert {r.refund_id: r.is_refund_not_exceed_total for r in out.collect()} == {1: True, 2: False, 3: None, 4: None}


def test_role_playing(spark):
    facts = spark.createDataFrame([(1, 1, 2), (2, 2, 9)], "id long, base_id long, quote_id long")
    dim = spark.createDataFrame([(1, "AUD"), (2, "INR")], "cid long, code string")
    out = role_playing(facts, dim, "cid", {"base": "base_id", "quote": "quote_id"}, ["code"])
    assert rows(out.select("id", "base_code", "quote_code")) == [(1, "AUD", "INR"), (2, "INR", None)]


def test_date_dimension_is_distinct_and_skips_null(spark):
    a = spark.createDataFrame([(date(2024, 1, 7),), (None,), (date(2024, 1, 7),)], "d date")
    b = spark.createDataFrame([(date(2024, 1, 7),), (date(2021, 1, 1),)], "e date")
    out = date_dimension([(a, "d"), (b, "e")])
    assert rows(out) == [(date(2021, 1, 1), 2021, 1, 1, 5, 53), (date(2024, 1, 7), 2024, 1, 7, 0, 1)]
