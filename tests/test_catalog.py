"""Relations that are registered by name: external tables, partitions, views, bucketed tables, published models."""

from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import DATA, rows
from millrace.operators.enrich import enrich_orders
from millrace.plans import published, queries
from millrace.plans.build import INTERMEDIATE
from millrace.plans.queries import CATALOG, _stored
from millrace.plans.roles import DerivedWarehouse
from millrace.plans.staging import STAGED, stage
from millrace.session import discard_written, setting, written_so_far
from millrace.sources import catalog

SF = f"{DATA}/sf0.001"
PREFIX = "test_"


@pytest.fixture
def schema(spark):
    yield "test_tables"
    spark.sql("DROP SCHEMA IF EXISTS test_tables CASCADE")


@pytest.fixture(scope="module")
def models(spark):
    warehouse = _stored(spark, SF)
    names = published.publish(warehouse, PREFIX)
    yield warehouse, names
    published.withdraw(spark, PREFIX)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_directories(spark, schema, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(20).withColumn("d", F.expr("date_add(date'2024-01-01', int(id % 3))"))
    df.write.partitionBy("d").parquet(path)
    table = catalog.register_table(spark, schema, "t", path, df.schema, ["d"])
    assert table.dtypes == df.dtypes and rows(table) == rows(df)
    found = spark.newSession().sql(f"select count(*) from {schema}.t where d = '2024-01-02'")
    assert found.first()[0] == 7
    assert found.inputFiles() and all("d=2024-01-02" in f for f in found.inputFiles())
    df.limit(4).withColumn("d", F.lit(date(2025, 1, 1))).write.mode("append").partitionBy("d").parquet(path)
    assert spark.table(f"{schema}.t").count() == 20
    assert catalog.register_table(spark, schema, "t", path, df.schema, ["d"]).count() == 24
    spark.range(0).withColumn("d", F.lit(date(2025, 1, 1))).write.mode("overwrite").partitionBy("d").parquet(path)
    assert catalog.register_table(spark, schema, "t", path, df.schema, ["d"]).count() == 0


def test_registering_again_changes_nothing_and_replaces_what_changed(spark, schema, tmp_path):
    one, two = f"{tmp_path}/one", f"{tmp_path}/two's"
    spark.range(3).write.parquet(one)
    spark.range(5).selectExpr("id", "string(id) as name").write.parquet(two)
    for _ in range(2):
        assert catalog.register_table(spark, schema, "x", one, spark.read.parquet(one).schema).count() == 3
    moved = catalog.register_table(spark, schema, "x", two, spark.read.parquet(two).schema)
    assert moved.columns == ["id", "name"] and moved.count() == 5
    spark.sql(f"drop table {schema}.x")
    assert spark.read.parquet(two).count() == 5  # the files stay


def test_a_managed_table_is_never_replaced(spark, schema, tmp_path):
    catalog.create_schema(spark, schema)
    spark.range(2).write.saveAsTable(f"{schema}.kept")
    spark.range(3).write.parquet(f"{tmp_path}/new")
    with pytest.raises(ValueError, match="managed"):
        catalog.register_table(spark, schema, "kept", f"{tmp_path}/new", spark.range(1).schema)
    with pytest.raises(ValueError, match="not an external"):
        catalog.store_bucketed(spark.range(3), schema, "kept", f"{tmp_path}/b", "id", 4)
    assert spark.table(f"{schema}.kept").count() == 2


def test_bucketed_tables_join_without_an_exchange(spark, schema, tmp_path):
    df = spark.range(1000).selectExpr("id % 97 as k", "id as v")
    a = catalog.store_bucketed(df, schema, "a", f"{tmp_path}/a", "k", 6)
    b = catalog.store_bucketed(df.groupBy("k").agg(F.sum("v").alias("s")), schema, "b", f"{tmp_path}/b", "k", 6)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        joined = a.join(b, "k")
        assert "Exchange" not in plan_of(joined)
        assert "Exchange" not in plan_of(a.groupBy("k").count())
        assert joined.agg(F.count("*"), F.sum("s")).first() == df.join(df.groupBy("k").agg(F.sum("v").alias("s")), "k").agg(F.count("*"), F.sum("s")).first()
    assert catalog.store_bucketed(df.limit(7), schema, "a", f"{tmp_path}/a", "k", 3).count() == 7


def test_order_fact_joins_bucketed_nodes_without_an_exchange(spark, schema, tmp_path):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        keep = published.keep_by_order(spark, schema, str(tmp_path), 8)
        w = DerivedWarehouse(spark, SF, keep=keep)
        fact = enrich_orders(w.staged("orders"), w.items_rollup, w.status_rollup, w.delivery_enriched)
        plan = plan_of(fact)
        # The header and the deliveries are shuffled; the stored rollups are read bucket by bucket.
        assert plan.count("Bucketed: true") == 2
        assert plan.count("Exchange hashpartitioning(order_id") == 2
        assert rows(fact) == rows(DerivedWarehouse(spark, SF).orders_enriched)
    for name in published.BY_ORDER:
        buckets = [f.name.split("_")[1].split(".")[0] for f in (tmp_path / name).glob("*.parquet")]
        assert len(buckets) == len(set(buckets)) <= 8  # one file each


def test_every_model_is_published(spark, models):
    warehouse, names = models
    assert names == [(PREFIX + s, n) for s, n in CATALOG]
    assert names == published.publish(warehouse, PREFIX)  # again, with the same result


@pytest.mark.parametrize("table", STAGED)
def test_staging_views_equal_the_models(spark, models, table):
    other = spark.newSession()
    view = published.published(other, "staging", table, PREFIX)
    model = models[0].staged(table)
    assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in model.schema]
    assert rows(view) == rows(model)


@pytest.mark.parametrize("model", INTERMEDIATE.values())
def test_intermediate_relations_equal_the_models(spark, models, model):
    view = published.published(spark.newSession(), "intermediate", model, PREFIX)
    found = getattr(models[0], model)
    assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in found.schema]
    assert rows(view) == rows(found)


def test_another_session_reads_by_name(spark, models):
    other = spark.newSession()
    day = other.sql(f"select order_day, count(*) as n from {PREFIX}raw.orders group by order_day order by n desc, order_day").first()
    one = other.sql(f"select * from {PREFIX}raw.orders where order_day = date'{day.order_day}'")
    assert one.count() == day.n
    assert all(f"order_day={day.order_day}" in f for f in one.inputFiles())
    assert other.sql(f"select count(*) from {PREFIX}gold.fct_orders").first()[0] == models[0].gold["fct_orders"].count()
    assert other.sql(f"select count(*) from {PREFIX}snapshots.snap_menu_items").first()[0] == models[0].menu_history.count()


TIMES = [
    None, "", "2024-01-02 03:04:05", "2024-01-02T03:04:05+02:00", " 2024/1/2 24:00 ", "0099-01-02", "99-1-2", "epoch", "EPOCH ", "2024-01-02 03:04:05.123456",
    "2024", "03:04", "2024-13-01", "soon", "2024-01-02 24:01", "0044-03-15", "2024-01-02 3:4", "2024-02-30",
]


def test_staging_sql_reads_odd_values_as_the_models_do(spark, schema, tmp_path):
    data = [(t, f" {k}.5 ", f"  a{k}  ", None if k % 3 else "x") for k, t in enumerate(TIMES)]
    raw = spark.createDataFrame(data, "event_ts string, event_id string, status string, notes string").selectExpr("*", "'7' as order_id", "' me ' as actor", "date'2024-01-01' as event_day")
    raw.write.parquet(f"{tmp_path}/events")
    catalog.register_table(spark, schema, "events", f"{tmp_path}/events", raw.schema)
    view = spark.sql(published.staging_query("order_status_events", raw.schema, f"{schema}.events"))
    assert rows(view) == rows(stage("order_status_events", raw))


def test_stored_run_is_built_again_after_its_files_are_discarded(spark, monkeypatch):
    def small(spark, sf_dir, base):
        spark.range(3).write.parquet(f"{base}/gold/t")
        return SimpleNamespace(base=base, gold={"t": spark.read.parquet(f"{base}/gold/t")})

    monkeypatch.setattr(queries, "_build_stored", small)
    before = written_so_far()
    first = queries._stored(spark, "nowhere")
    assert queries._stored(spark, "nowhere") is first
    discard_written(spark, before)
    second = queries._stored(spark, "nowhere")
    assert second.base != first.base and second.gold["t"].count() == 3
