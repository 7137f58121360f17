"""Joins with a hot key give the same rows as a plain join, and really spread it."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import joins
from millrace.operators.joins import hot_hashes, lookup_join, orphans
from millrace.session import setting


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has key 1, a third has no key, the rest is spread."""
    rng = random.Random(7)
    data = [(i, 1 if i % 3 == 0 else None if i % 3 == 1 else rng.randint(2, 3000)) for i in range(6000)]
    return spark.createDataFrame(data, "id long, k long").cache()


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([(k, f"n{k}") for k in range(1, 2500)], "k long, name string").cache()


def test_hot_hashes_finds_exactly_the_frequent_keys(spark, skewed):
    expected = spark.createDataFrame([(1,), (None,)], "k long").select(F.xxhash64("k")).collect()
    assert set(hot_hashes(skewed, ["k"])) == {r[0] for r in expected}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(no_broadcast, skewed, dimension, how):
    plain = skewed.join(dimension, "k", how).select("id", "k", "name")
    salted = lookup_join(skewed, dimension, "k", how)
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert salted.columns == ["id", "k", "name"]
    assert rows(salted) == rows(plain)


def test_salted_join_spreads_the_hot_key(no_broadcast, skewed):
    # A third of the rows is as much as three of eight partitions hold.
    hot = hot_hashes(skewed, ["k"])
    parts = joins._salted(skewed, F.xxhash64("k"), hot).where("k = 1").groupBy("__salt").count().collect()
    assert len(parts) == 3
    assert max(r["count"] for r in parts) < 2 * 2000 / 3


def test_equal_rows_of_a_hot_key_are_spread(no_broadcast):
    spark = no_broadcast
    same = spark.range(8000).repartition(16).select(F.lit(1).cast("long").alias("k"))
    salted = joins._salted(same, F.xxhash64("k"), hot_hashes(same, ["k"]))
    assert salted.select("__salt").distinct().count() > 4


def test_hot_is_measured_against_a_partition(no_broadcast):
    spark = no_broadcast
    # 0.4 % of the rows: little for 8 partitions, much for 2000.
    data = spark.range(50_000).select(F.when(F.col("id") % 250 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    names = spark.range(-1, 50_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    assert hot_hashes(data, ["k"]) == {}
    with setting(spark, "spark.sql.shuffle.partitions", "2000"):
        assert list(hot_hashes(data, ["k"]).values()) == [0.004]
        plan = lookup_join(data, names, "k")._jdf.queryExecution().optimizedPlan().toString()
        assert "__salt" in plan
    with setting(spark, "spark.sql.shuffle.partitions", "50000"):
        assert len(lookup_join(data, names, "k")._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_wider_right_keys_do_not_overflow(no_broadcast, skewed, dimension):
    narrow = skewed.select("id", F.col("k").cast("int").alias("k"))
    beyond = dimension.union(dimension.sparkSession.createDataFrame([(5_000_000_000, "far")], "k long, name string"))
    expected = narrow.join(beyond.withColumnRenamed("k", "key"), F.col("k") == F.col("key"), "left").select("id", "k", "name")
    assert rows(lookup_join(narrow, beyond, "k")) == rows(expected)


def test_keys_of_different_integer_types_still_match(no_broadcast, skewed, dimension):
    narrow = dimension.select(F.col("k").cast("int").alias("key"), "name")
    assert rows(lookup_join(skewed, narrow, {"k": "key"})) == rows(lookup_join(skewed, dimension, "k"))


def test_long_texts_are_not_broadcast_by_their_count(spark):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "1000000"):
        wide = spark.range(200).select("id", F.expr("repeat('x', 200000)").alias("text")).repartition(4)
        facts = spark.range(20_000).select((F.col("id") % 300).alias("id"))
        plan = lookup_join(facts, wide, "id", counted=200)._jdf.queryExecution().optimizedPlan().toString()
        assert "broadcast" not in plan.lower()


def test_several_lookups_share_one_salt(no_broadcast, skewed, dimension):
    second = dimension.select("k", F.length("name").alias("size"))
    both = lookup_join(skewed, [dimension, second], "k")
    expected = skewed.join(dimension, "k", "left").join(second, "k", "left").select("id", "k", "name", "size")
    plan = both._jdf.queryExecution().executedPlan().toString()
    # One shuffle of the left side and one of each right side.
    assert plan.count("Exchange hashpartitioning") == 3
    assert rows(both) == rows(expected)


def test_without_hot_keys_the_join_is_plain(no_broadcast, skewed, dimension):
    even = skewed.where("k > 1")
    plan = lookup_join(even, dimension, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" not in plan


def test_counted_rows_decide_about_the_salt(spark, skewed, dimension):
    # Both sides are larger than the limit by estimate; the exact count overrules it.
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "16000"):
        few = lookup_join(skewed, dimension.where("k < 100"), "k", counted=99)
        assert "__salt" not in few._jdf.queryExecution().optimizedPlan().toString()
        many = lookup_join(skewed, dimension.where("k < 100"), "k", counted=10**9)
        assert "__salt" in many._jdf.queryExecution().optimizedPlan().toString()
        assert rows(few) == rows(many)


def test_a_small_left_side_is_not_searched_for_hot_keys(spark, skewed, dimension):
    plan = lookup_join(skewed, dimension, "k", counted=10**9)._jdf.queryExecution().optimizedPlan()
    assert "__salt" not in plan.toString()


def test_residual_condition(no_broadcast, skewed, dimension):
    joined = lookup_join(skewed, dimension, "k", condition=lambda: F.col("id") < 3000)
    assert joined.count() == skewed.count()
    assert joined.where("id >= 3000 and name is not null").count() == 0
    assert joined.where("id < 3000 and k = 1 and name is null").count() == 0


def test_orphans_count_rows_and_skip_nulls(spark, skewed, dimension):
    found = dict(rows(orphans(skewed, "k", dimension, "k")))
    expected = {k: n for k, n in rows(skewed.groupBy("k").count()) if k is not None and k >= 2500}
    assert found == expected


def test_orphan_rows_are_the_rows_themselves(spark, skewed, dimension):
    found = joins.orphan_rows(skewed, "k", dimension, "k")
    assert found.columns == skewed.columns
    assert rows(found) == rows(skewed.where("k >= 2500"))
