"""What a stored warehouse writes, and what it derives from what is written."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import quality
from millrace.operators.quality import Check
from millrace.operators.enrich import RECONCILED
from millrace.operators.joins import packed, unpacked
from millrace.plans import build
from millrace.plans.build import FACTS, StoredWarehouse, gather_by_day
from millrace.plans.warehouse import KEPT_TOGETHER, Warehouse
from millrace.sources.bronze import export_by_day, export_table
from millrace.sources.history import record_snapshot


@pytest.fixture(scope="module")
def raw(spark):
    orders = spark.sql(
        "select * from values (1, 10, 100, 7, '2024-01-01 10:00:00', null, 5, 1, 1, 0, 7, 'card', 'paid', 1, date'2024-01-01'),"
        " (2, 11, 101, 8, '2024-01-02 10:00:00', null, 9, 0, 1, 0, 10, 'cash', 'pending', 1, date'2024-01-02') t(order_id, customer_id,"
        " delivery_address_id, restaurant_id, order_placed_at, scheduled_delivery, subtotal, tax, delivery_fee, discount, total_amount,"
        " payment_method, payment_status, currency_id, order_day)"
    )
    lines = spark.sql(
        "select * from values (1, 1, 50, 1, 2, 2, date'2024-01-01'), (2, 1, 51, 1, 3, 3, date'2024-01-01'), (3, 2, null, 3, 3, 9, date'2024-01-02')"
        " t(order_item_id, order_id, menu_item_id, quantity, unit_price, line_total, order_day)"
    )
    refunds = spark.sql(
        "select * from values (1, 1, '2024-01-03 00:00:00', 'late_delivery', '8', 1, date'2024-01-03'),"
        " (2, 1, null, 'other', 'tbc', 1, null), (3, 9, '2024-01-03 00:00:00', null, '1', null, date'2024-01-03')"
        " t(refund_id, order_id, refund_ts, refund_reason, refund_amount, currency_id, refund_day)"
    )
    menu = spark.sql("select 50 as menu_item_id, 7 as restaurant_id, 'Soup' as item_name, 'hot' as category, 2 as price, true as is_available, null as created_at")
    events = spark.sql("select 1 as event_id, 1 as order_id, '2024-01-01 11:00:00' as event_ts, 'delivered' as status, 'courier' as actor, '' as notes, date'2024-01-01' as event_day")
    deliveries = spark.sql("select 1 as order_id, 3 as courier_id, null as assigned_at, null as pickup_eta, null as dropoff_eta")
    return {"orders": orders, "order_items": lines, "refunds": refunds, "menu_items": menu, "order_status_events": events, "delivery_assignments": deliveries}


def histories(spark):
    at = "timestamp_ntz'2024-01-01 00:00:00'"
    menu = spark.sql(
        "select 50L as menu_item_id, 7L as restaurant_id, 'Soup' as item_name, 'hot' as category,"
        f" 'm1' as scd_id, {at} as updated_at, {at} as valid_from, cast(null as timestamp_ntz) as valid_to"
    )
    restaurants = spark.sql(
        "select 7L as restaurant_id, 1L as brand_id, 'B' as brand_name, true as brand_is_active, 'O' as outlet_name, 'C' as city, 'Z' as delivery_zone,"
        f" 'A' as address_line1, 'P' as postal_code, true as is_active, 'r1' as scd_id, {at} as updated_at, {at} as valid_from, cast(null as timestamp_ntz) as valid_to"
    )
    return menu, restaurants


def test_stored_facts_stand_for_their_nodes(spark, raw, tmp_path):
    """Lines with their order are not written beside the line fact, and one join serves both refund relations."""
    base = str(tmp_path)
    stored = StoredWarehouse(raw, base, *histories(spark))
    plain = Warehouse(raw, *histories(spark))
    for name in ("order_items_enriched", "refunds_enriched", "fct_order_items", "fct_refunds"):
        one, other = getattr(stored, name), getattr(plain, name)
        assert one.columns == other.columns
        assert rows(one) == rows(other)
    assert not (tmp_path / "nodes" / "lines_with_order").exists()
    assert any("fct_order_items" in f for f in stored.order_items_enriched.inputFiles())
    files = spark.read.parquet(f"{base}/nodes/refunds_enriched")
    assert {"restaurant_sk", "payment_status", *stored.refunds_enriched.columns} <= set(files.columns)


def test_stored_tables_are_zstd(spark, tmp_path):
    df = spark.range(4).select("id", F.to_date(F.lit("2024-01-01")).alias("d"))
    export_table(df, str(tmp_path / "whole"))
    export_by_day(df, str(tmp_path / "days"), "d")
    for folder in ("whole", "days"):
        files = list((tmp_path / folder).rglob("*.parquet"))
        assert files and all(".zstd." in f.name for f in files)


def test_checks_on_one_column_share_its_rows(spark, monkeypatch):
    parent = spark.sql("select * from values (1), (2), (2), (null), (null) t(pk)")
    children = {name: spark.sql(f"select * from values {v} t(fk)") for name, v in {"a": "(1), (3), (3), (null)", "b": "(2), (4)"}.items()}
    checks = {
        Check("unique", "parent", ("pk",)): 1,
        Check("unique_combination", "parent", ("pk",)): 2,
        Check("unique_combination", "parent", ("pk",), where="pk > 2"): 0,
        Check("relationships", "a", ("fk",), parent=("parent", "pk")): 2,
        Check("relationships", "b", ("fk",), parent=("parent", "pk")): 1,
        Check("relationships", "b", ("fk",), parent=("parent", "pk"), where="fk < 4"): 0,
    }
    entries = []
    real = quality._entry
    monkeypatch.setattr(quality, "_entry", lambda *args: entries.append(args) or real(*args))
    got = {(r.relation, r.check_name): r.failures for r in quality.report(list(checks), {"parent": parent, **children}).collect()}
    assert got == {(c.relation, c.name): n for c, n in checks.items()}
    # The parent's own rows once, and once more for the condition; each reference once.
    assert len(entries) == 5


def test_md5_texts_are_carried_as_bytes(spark):
    texts = ["0" * 32, "0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "a" * 31, "a" * 32 + "\n", "g" * 32, "m1", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, key string")
    narrow = packed(df, "key")
    held = {r["id"]: (r["__bytes_key"], r["__text_key"]) for r in narrow.collect()}
    assert held[1] == (bytes.fromhex(texts[1]), None)
    assert {i for i, (found, _) in held.items() if found is not None} == {0, 1}
    assert rows(unpacked(narrow, "key")) == rows(df)


def plan_below_gathering(df):
    """The columns of the shuffle that gathers a fact by day."""
    lines = df._jdf.queryExecution().optimizedPlan()
    while lines.nodeName() != "RebalancePartitions":
        lines = lines.children().head()
    return {lines.output().apply(i).name() for i in range(lines.output().size())}


def test_facts_are_gathered_narrow(spark, raw, tmp_path):
    """Version keys go by day as bytes, what reconciliation derives not at all, and lines of an order end up side by side."""
    menu, restaurants = histories(spark)
    stored = StoredWarehouse(raw, str(tmp_path), menu, restaurants.withColumn("scd_id", F.md5("scd_id")))
    plain = Warehouse(raw, menu, restaurants.withColumn("scd_id", F.md5("scd_id")))
    gathered = gather_by_day(plain.fct_orders, "fct_orders")
    columns = plan_below_gathering(gathered)
    assert "__bytes_restaurant_sk" in columns and not columns & {"restaurant_sk", *RECONCILED}
    for name in ("fct_orders", "fct_order_items", "fct_refunds"):
        one, other = getattr(stored, name), getattr(plain, name)
        assert (one.columns, rows(one)) == (other.columns, rows(other))
    order = [F.spark_partition_id(), "order_date_utc", "order_id"]
    lines = spark.range(400).selectExpr("id % 90 as order_id", "date_add(date'2024-01-01', cast(id % 3 as int)) as order_date_utc", "'m' as menu_item_sk")
    found = [tuple(r) for r in gather_by_day(lines, "fct_order_items").select(*order).collect()]
    assert len(found) == 400 and found == sorted(found)


def shuffle_files(spark):
    """Names of the shuffle files on the disk of this application."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in found if name.startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """Shuffles behind a stored layer are deleted with the end of its write, not when the driver collects garbage."""
    df = spark.range(300).selectExpr("id", "id % 5 as g", "date_add(date'2024-01-01', cast(id % 3 as int)) as d")
    source = df.groupBy("g").agg(F.max("id").alias("n"))
    # Each with the shuffles of other jobs in it: the snapshot's search for repeated keys.
    steps = [
        (lambda: export_table(df.repartition(3, "g"), str(tmp_path / "whole")), 0),
        (lambda: export_by_day(df, str(tmp_path / "days"), "d"), 0),
        (lambda: record_snapshot(source, str(tmp_path / "history"), "g", ("n",), "2024-01-01 00:00:00"), 1),
    ]

    def shuffles():
        return {name.split("_")[1] for name in shuffle_files(spark)}

    for write, others in steps:
        before, until = shuffles(), time.time() + 15
        write()
        while len(shuffles() - before) > others and time.time() < until:
            time.sleep(0.2)
        assert len(shuffles() - before) <= others
    assert spark.read.parquet(str(tmp_path / "whole")).count() == 300
    assert spark.read.parquet(str(tmp_path / "days")).count() == 300


def test_lines_are_written_down_before_they_are_gathered(spark, raw, tmp_path, monkeypatch):
    """The joins of the line fact end in a step of its own, which is deleted once the fact is stored."""
    written = []
    real = build.export_table
    monkeypatch.setattr(build, "export_table", lambda df, path, *last: written.append((path, df)) or real(df, path, *last))
    menu, restaurants = histories(spark)
    keys = F.md5("scd_id").alias("scd_id")
    menu = menu.unionByName(menu.withColumn("menu_item_id", F.lit(51).cast("bigint")).withColumn("scd_id", keys))
    stored, plain = StoredWarehouse(raw, str(tmp_path), menu, restaurants), Warehouse(raw, menu, restaurants)
    one, other = stored.fct_order_items, plain.fct_order_items
    assert (one.dtypes, rows(one)) == (other.dtypes, rows(other)) and one.count() == 3
    step, fact = [(path, df) for path, df in written if "fct_order_items" in path]
    assert step[0] == f"{fact[0]}.step"
    assert "__bytes_menu_item_sk" in step[1].columns
    plan = fact[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" in plan and "Join" not in plan
    assert not (tmp_path / "gold" / "fct_order_items.step").exists()


def test_large_facts_are_not_joined_side_by_side():
    large = {"fct_orders", "fct_order_items", "refunds_in_context", "fct_refunds"}
    assert large < {*FACTS, "refunds_in_context"}
    assert all(len(large.intersection(level)) <= 1 for level in KEPT_TOGETHER)
