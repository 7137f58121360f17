"""Properties of the models over the derived tables."""

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from millrace.plans.build import DIMENSIONS, FACTS, build, run_checks
from millrace.plans.checks import declared_checks, relations
from millrace.plans.roles import DerivedWarehouse, source_table
from millrace.plans.staging import STAGED
from millrace.session import write_out

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark):
    return DerivedWarehouse(spark, SF, keep=write_out)


def test_staging_keeps_every_row(warehouse):
    for table in STAGED:
        assert warehouse.staged(table).count() == warehouse.raw[table].count()
        assert warehouse.staged(table).columns == list(STAGED[table])


def test_grains_are_kept(warehouse):
    orders = warehouse.staged("orders").count()
    assert warehouse.orders_enriched.count() == orders == warehouse.fct_orders.count()
    lines = warehouse.staged("order_items").count()
    assert warehouse.order_items_enriched.count() == lines == warehouse.fct_order_items.count()
    refunds = warehouse.staged("refunds").count()
    assert warehouse.refunds_enriched.count() == refunds == warehouse.fct_refunds.count()


def test_rollup_keeps_the_amounts(warehouse):
    lines = warehouse.staged("order_items").agg(F.sum("line_total"), F.sum("quantity"), F.count("*")).first()
    rolled = warehouse.items_rollup.agg(F.sum("items_subtotal"), F.sum("items_total_qty"), F.sum("item_lines")).first()
    assert tuple(lines) == tuple(rolled)


def test_widths_of_the_order_models(warehouse):
    assert len(warehouse.orders_enriched.columns) == 41
    assert len(warehouse.fct_orders.columns) == 43


def test_windows_have_no_gap_and_no_overlap(warehouse):
    for history, key in ((warehouse.menu_history, "menu_item_id"), (warehouse.restaurant_history, "restaurant_id")):
        versions = {}
        for r in history.collect():
            versions.setdefault(r[key], []).append((r.valid_from, r.valid_to))
        for windows in versions.values():
            windows.sort()
            assert [w[1] for w in windows[:-1]] == [w[0] for w in windows[1:]]
            assert windows[-1][1] is None


def test_every_order_of_a_known_restaurant_is_bound(warehouse):
    known = warehouse.staged("restaurant_outlets").select("restaurant_id")
    unbound = warehouse.fct_orders.join(known, "restaurant_id").where("restaurant_sk is null")
    assert unbound.count() == 0


def test_relations_cover_all_checks(warehouse):
    assert len(relations(warehouse, *declared_checks())) == 45


def test_complete_job_runs_twice(spark, tmp_path):
    """The second run replaces the tables, adds to the histories and reports every check."""
    sources = {t: source_table(spark, SF, t) for t in STAGED if t not in ("orders", "order_items", "refunds")}
    # Few days, so that the day directories stay few.
    for t in ("orders", "order_items", "refunds"):
        ts = {"orders": "order_placed_at", "refunds": "refund_ts"}.get(t)
        df = source_table(spark, SF, t)
        sources[t] = df.withColumn(ts, F.date_trunc("year", ts).cast("timestamp_ntz")) if ts else df
    base = str(tmp_path / "wh")
    build(spark, sources, base, "2002-01-01 00:00:00")
    renamed = sources["menu_items"].withColumn("category", F.lit("new"))
    second = build(spark, sources | {"menu_items": renamed}, base, "2002-02-01 00:00:00")
    gold = second.gold
    assert set(gold) == {*DIMENSIONS, *FACTS}
    items = sources["menu_items"].count()
    assert gold["dim_menu_items"].count() == 2 * items
    assert gold["dim_menu_items"].where("is_current").count() == items
    assert gold["dim_restaurants"].count() == sources["restaurant_outlets"].count()
    assert gold["fct_orders"].count() == sources["orders"].count()
    assert gold["fct_order_items"].where("menu_item_sk is null").count() == 0
    found = {(r.relation, r.check_name): r.status for r in run_checks(second).collect()}
    assert len(found) == 340
    assert found[("fct_orders", "not_null: order_id")] == "pass"
    assert found[("gold", "orders_total_consistency")] == "fail"
