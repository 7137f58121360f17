from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.session import setting, shared_dir, write_out
from millrace.sources import bronze


def test_day_export_round_trip_and_pruning(spark, tmp_path):
    data = [(i, datetime(2024, 1, 1 + i % 3, 23, 59, 59)) for i in range(30)]
    df = bronze.with_day(spark.createDataFrame(data, "id long, ts timestamp_ntz"), "ts", "d")
    bronze.export_by_day(df, f"{tmp_path}/events", "d")
    assert sorted(p.name for p in (tmp_path / "events").glob("d=*")) == [f"d=2024-01-0{i}" for i in (1, 2, 3)]
    back = bronze.register_raw(spark, str(tmp_path), ["events"])["events"]
    assert dict(back.dtypes)["d"] == "date"
    assert rows(back) == rows(df)
    pruned = spark.table("raw_events").where(F.col("d") == date(2024, 1, 2))
    assert "PartitionFilters: [isnotnull(d" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 10


def test_hot_day_is_written_by_several_tasks(spark, tmp_path):
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB"):
        df = spark.range(0, 200_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise(F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))).cast("date").alias("d"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
        )
        bronze.export_by_day(df, f"{tmp_path}/hot", "d", file_bytes=65536)
    assert len(list((tmp_path / "hot" / "d=2024-01-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 200_000


def day_files_of(path):
    return {p.parent.name: p.name for p in path.glob("d=*/*.parquet")}


def test_only_changed_days_are_written_again(spark, tmp_path):
    path = tmp_path / "events"
    data = [(i, f"v{i % 3}", date(2024, 1, 1 + i % 4)) for i in range(40)] + [(99, None, None)] * 2
    frame = lambda data: spark.createDataFrame(data, "id long, v string, d date")
    back = lambda: sorted(map(repr, map(tuple, spark.read.parquet(str(path)).select("id", "v", "d").collect())))
    assert len(bronze.export_changed_days(frame(data), str(path), "d")) == 5
    assert back() == sorted(map(repr, data))
    first = day_files_of(path)
    assert bronze.export_changed_days(frame(data[::-1]).repartition(3), str(path), "d") == []
    assert day_files_of(path) == first

    late = [*data, (100, "late", date(2024, 1, 2))]
    assert bronze.export_changed_days(frame(late), str(path), "d") == [date(2024, 1, 2)]
    second = day_files_of(path)
    assert {k for k in second if second[k] != first[k]} == {"d=2024-01-02"}
    assert back() == sorted(map(repr, late))

    # A changed cell, a row that goes and comes twice elsewhere, a new day, and days that vanish.
    left = [(i, "new" if i == 2 else v, d) for i, v, d in late if d and d != date(2024, 1, 4)]
    left = [r for r in left if r[0] != 8] + [left[1], (7, "x", date(2024, 2, 1))]
    written = bronze.export_changed_days(frame(left), str(path), "d")
    assert written == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3), date(2024, 2, 1)]
    assert back() == sorted(map(repr, left))
    assert not (path / "d=2024-01-04").exists()


def test_days_come_from_the_directories(spark, tmp_path):
    path = f"{tmp_path}/events"
    df = spark.createDataFrame([(1, date(2024, 1, 2)), (2, None), (3, date(2023, 12, 31)), (4, date(2024, 1, 2))], "id long, d date")
    bronze.export_by_day(df, path, "d")
    days = bronze.stored_days(spark.read.parquet(path), "d")
    assert rows(days) == rows(df.select("d").distinct())
    assert "FileScan" not in days._jdf.queryExecution().executedPlan().toString()


def test_an_export_that_ended_before_its_digests_is_made_good(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "events"), "id long, d date"
    one = spark.createDataFrame([(i, date(2024, 1, 1 + i % 3)) for i in range(9)], schema)
    bronze.export_changed_days(one, path, "d")
    two = one.unionAll(spark.createDataFrame([(100, date(2024, 1, 1))], schema))
    with monkeypatch.context() as m:
        m.setattr(bronze, "day_digests", lambda df, day: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            bronze.export_changed_days(two, path, "d")
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):  # the data alone arrived
        two.where("d = '2024-01-01'").write.mode("overwrite").partitionBy("d").parquet(path)
    assert bronze.export_changed_days(two, path, "d") == [date(2024, 1, 1)]
    assert rows(spark.read.parquet(path)) == rows(two)


def test_children_take_the_day_of_their_parent(spark):
    parents = spark.createDataFrame([(1, datetime(2024, 1, 1, 23)), (2, datetime(2024, 1, 2))], "k long, ts timestamp_ntz")
    children = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, 3), (14, None)], "id long, k long")
    out = bronze.with_parent_day(children, parents, "k", "ts", "d")
    assert rows(out) == [(10, 1, date(2024, 1, 1)), (11, 1, date(2024, 1, 1)), (12, 2, date(2024, 1, 2))]


def test_append_if_absent(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(1, "old"), (2, "old")], "k long, v string").write.parquet(path)
    staged = spark.createDataFrame([(2, "new"), (3, "b"), (3, "a"), (4, "x")], "k long, v string")
    target = spark.read.parquet(path)
    expected = [(1, "old"), (2, "old"), (3, "a"), (4, "x")]
    assert rows(bronze.append_if_absent(staged, target, "k", ["v"])) == expected
    for _ in range(2):  # the second append finds every key present
        bronze.append_to_path(staged, path, "k", ["v"])
        assert rows(spark.read.parquet(path)) == expected
    nothing = staged.where("false")
    assert bronze.absent_rows(nothing, target, "k", ["v"]).count() == 0


def test_view_counts(spark, tmp_path):
    bronze.export_table(spark.range(5).toDF("a"), f"{tmp_path}/x")
    bronze.register_raw(spark, str(tmp_path), ["x"])
    bronze.register_raw(spark, str(tmp_path), ["x"])  # idempotent
    assert rows(bronze.view_counts(spark, ["x"])) == [("x", 5)]


def test_written_nodes_use_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    out = write_out(spark.range(3).toDF("a"), "node")
    assert out.inputFiles()[0].startswith(f"file://{folder}/node-")
    assert rows(out) == [(0,), (1,), (2,)]
