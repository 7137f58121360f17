import re
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.rollup import key_ranges, line_rollup, milestone_rollup, ordered_children
from millrace.plans.warehouse import DURATIONS, FLAGS, MILESTONES


def at(minute, second=0):
    return datetime(2024, 1, 1, 12, minute, second)


def rolled(spark, events):
    df = spark.createDataFrame(events, "event_id long, order_id long, event_ts timestamp_ntz, status string")
    out = milestone_rollup(df, "order_id", "event_ts", "status", "event_id", MILESTONES, FLAGS, DURATIONS)
    return {r.order_id: r for r in out.collect()}


def test_milestones_of_delivered_and_canceled_orders(spark):
    steps = list(MILESTONES.values())[:6]
    delivered = [(i, 1, at(i, 59), s) for i, s in enumerate(steps)]
    out = rolled(spark, delivered + [(10, 2, at(0), "PLACED"), (11, 2, at(3), "CANCELED")])
    assert out[1].is_delivered and not out[1].is_canceled
    assert (out[1].minutes_to_accept, out[1].minutes_to_deliver, out[1].minutes_pickup_to_deliver) == (1, 5, 1)
    assert out[1].latest_status == "DELIVERED"
    assert out[2].is_canceled and not out[2].is_delivered
    assert out[2].minutes_to_deliver is None and out[2].latest_status_at == at(3)


def test_first_time_of_a_repeated_status(spark):
    out = rolled(spark, [(1, 1, at(5), "PLACED"), (2, 1, at(2), "PLACED"), (3, 1, at(9), "PLACED")])
    assert out[1].placed_at == at(2)


def test_latest_status_breaks_ties_by_id_and_skips_null(spark):
    events = [
        (1, 1, at(1), "PLACED"),
        (3, 1, at(2), "PICKED_UP"),
        (2, 1, at(2), "ACCEPTED"),
        (4, 1, at(7), None),
        (5, 2, at(1), None),
    ]
    out = rolled(spark, events)
    assert out[1].latest_status == "PICKED_UP"
    assert out[1].latest_status_at == at(7)
    assert out[2].latest_status is None and not out[2].is_delivered


LINES = [(1, 10, 2, "5.00"), (1, 10, 1, "2.50"), (1, 11, 1, "1.25"), (2, 12, 3, "9.99"), (2, None, 1, "0.01")]


def lines(spark, data=LINES):
    df = spark.createDataFrame(data, "order_id long, item long, qty int, amount string")
    return df.withColumn("amount", F.col("amount").cast("decimal(12,2)"))


def test_line_rollup(spark):
    out = {r.order_id: r for r in line_rollup(lines(spark), "order_id", "item", "qty", "amount").collect()}
    assert (str(out[1].items_subtotal), out[1].items_total_qty) == ("8.75", 4)
    assert (out[1].item_lines, out[1].distinct_menu_items) == (3, 2)
    assert (out[2].item_lines, out[2].distinct_menu_items) == (2, 1)


def test_items_of_even_parents_are_counted_without_a_table_of_them(spark):
    data = [(None, 5, 1, "1.00"), (None, 5, 1, "1.00"), (None, 6, 1, "1.00"), (3, None, 1, "1.00"), (4, 0, 1, "1.00"), (4, None, 1, "1.00"), (4, 0, 2, "1.00")]
    even = [(k, k, 1, "1.00") for k in range(10, 2000)]
    out = line_rollup(lines(spark, LINES + data + even), "order_id", "item", "qty", "amount")
    # The aggregates have the parent as their only key: no task holds all pairs of parent and item.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert {k for k in re.findall(r"HashAggregate\(keys=\[([^]]*)\]", plan) if "item" in k} == set()
    found = {r.order_id: (r.item_lines, r.distinct_menu_items) for r in out.where("order_id is null or order_id < 10").collect()}
    assert found == {1: (3, 2), 2: (2, 1), None: (3, 2), 3: (1, 0), 4: (3, 1)}


def test_line_rollup_of_wide_amounts(spark):
    wide = lines(spark).withColumn("amount", F.col("amount").cast("decimal(20,4)"))
    narrow = line_rollup(lines(spark), "order_id", "item", "qty", "amount")
    assert rows(line_rollup(wide, "order_id", "item", "qty", "amount")) == rows(narrow)


def test_line_rollup_with_a_hot_parent(no_broadcast):
    spark = no_broadcast
    data = [(1 if i % 3 == 0 else i + 1, i % 500, 1, "1.00") for i in range(6000)]
    df = lines(spark, data)
    out = line_rollup(df, "order_id", "item", "qty", "amount")
    # The hot parent keeps the two-step distinct plan, even keys use one shuffle.
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    hot = out.where("order_id = 1").first()
    assert (hot.item_lines, hot.distinct_menu_items) == (2000, 500)
    even = line_rollup(df.where("order_id > 1"), "order_id", "item", "qty", "amount")
    assert even._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    total = out.agg(F.sum("items_subtotal")).first()[0]
    assert total == df.agg(F.sum("amount")).first()[0]


def test_ordered_children_across_spans(spark):
    data = [(1 if i % 3 else 2, i * 7 % 101, f"f{i}") for i in range(101)]
    df = spark.createDataFrame(data, "p long, o long, f string")
    out = ordered_children(df, "p", "o", ["f"], span=8)
    expected = []
    for parent in (1, 2):
        mine = sorted((o, f) for p, o, f in data if p == parent)
        expected += [(parent, i + 1, o, f) for i, (o, f) in enumerate(mine)]
    assert rows(out) == sorted(expected, key=repr)


def test_ordered_children_keep_null_orders_and_sparse_ids(spark):
    data = [(1, None, "n"), (None, 3, "p"), (None, None, "q")] + [(k % 2, k * 10**15 + k % 7, f"f{k}") for k in range(900)]
    df = spark.createDataFrame(data, "p long, o long, f string")
    expected = []
    for parent in {p for p, _, _ in data}:
        mine = sorted(((o, f) for p, o, f in data if p == parent), key=lambda x: (x[0] is None, x[0] or 0))
        expected += [(parent, i + 1, o, f) for i, (o, f) in enumerate(mine)]
    for span in (50, 10_000):
        assert rows(ordered_children(df, "p", "o", ["f"], span=span)) == sorted(expected, key=repr)


def test_latest_status_skips_events_without_a_time(spark):
    events = spark.createDataFrame(
        [(1, 1, None, "PLACED"), (2, 1, None, "PLACED"), (2, 2, datetime(2024, 1, 1), "DELIVERED"), (2, 3, None, "CANCELED")],
        "order_id long, id long, ts timestamp_ntz, status string",
    )
    out = {r.order_id: r for r in milestone_rollup(events, "order_id", "ts", "status", "id", {"placed_at": "PLACED"}, {}, {}).collect()}
    assert (out[1].latest_status, out[1].latest_status_at) == (None, None)
    assert (out[2].latest_status, out[2].placed_at) == ("DELIVERED", None)


def test_key_ranges_of_an_empty_relation(spark):
    out = key_ranges({"x": (lines(spark), "order_id"), "empty": (lines(spark).where("false"), "order_id")})
    assert rows(out) == [("empty", None, None, 1), ("x", 1, 2, 3)]
