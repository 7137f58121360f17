import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import quality
from millrace.operators.quality import Check
from millrace.plans import checks
from millrace.session import run_together, write_out


def test_declared_checks_are_complete():
    declared = checks.declared_checks()
    assert Counter(c.kind for c in declared) == {
        "not_null": 199,
        "unique": 46,
        "relationships": 46,
        "accepted_values": 20,
        "unique_combination": 12,
        "expression_is_true": 6,
        "accepted_range": 2,
    }
    layers = Counter(c.relation.split("_")[0] for c in declared)
    assert layers == {"raw": 124, "stg": 107, "int": 29, "dim": 41, "fct": 30}
    assert len({(c.relation, c.name) for c in declared}) == 331
    assert len(checks.constraint_checks()) == 31


@pytest.fixture(scope="module")
def tables(spark):
    child = [(1, 10, "A", 5, True), (2, 11, "Z", 0, True), (2, 99, "A", 6, False), (3, 99, None, None, True), (None, None, "B", 1, None), (None, 10, "A", 3, True)]
    return {
        "child": spark.createDataFrame(child, "id long, fk long, cat string, n int, live boolean"),
        "parent": spark.createDataFrame([(10,), (11,), (None,)], "pk long"),
        "empty": spark.createDataFrame([], "id long"),
    }


CHECKS = {
    Check("not_null", "child", ("id",)): 2,
    Check("unique", "child", ("id",)): 1,  # NULLs pass
    Check("unique_combination", "child", ("id",)): 2,  # NULLs form a group
    Check("unique_combination", "child", ("id",), where="live"): 0,
    Check("unique_combination", "child", ("fk", "cat")): 1,
    Check("relationships", "child", ("fk",), parent=("parent", "pk")): 2,
    Check("accepted_values", "child", ("cat",), ("A", "B")): 1,
    Check("accepted_range", "child", ("n",), (1, 5)): 2,
    Check("expression_is_true", "child", expression="n > 0 and cat = 'A'"): 2,  # a NULL result passes
    Check("not_null", "empty", ("id",)): 0,
    Check("unique", "empty", ("id",)): 0,
}


def test_report_counts(tables):
    got = {(r.relation, r.check_name): (r.failures, r.status) for r in quality.report(list(CHECKS), tables).collect()}
    assert got == {(c.relation, c.name): (n, "fail" if n else "pass") for c, n in CHECKS.items()}


@pytest.mark.parametrize("check, failures", CHECKS.items(), ids=lambda v: v.name if isinstance(v, Check) else "")
def test_violations_agree_with_the_report(tables, check, failures):
    found = quality.violations(check, tables)
    n = found.agg(F.sum("n_rows")).first()[0] or 0 if check.kind == "relationships" else found.count()
    assert n == failures


def test_report_shuffles_keys_once_per_type(tables):
    keyed = [c for c in CHECKS if c.kind not in quality.ROW_KINDS]
    frames = quality._key_counts(tables, keyed)
    assert 1 <= len(frames) <= 2
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        # One shuffle of (check, key) pairs, and one of the few counts per check.
        assert plan.count("hashpartitioning(check") == 2
        assert "SortMergeJoin" not in plan


@pytest.fixture
def scanned(monkeypatch):
    """The relations whose rows the report counts in scans of their own."""
    seen = []
    real = quality._counters
    monkeypatch.setattr(quality, "_counters", lambda checks, *rest: seen.extend(c.relation for c in checks) or real(checks, *rest))
    return seen


def test_watched_writes_need_no_scan(tables, scanned):
    watch = quality.Watch(list(CHECKS))
    for name, df in tables.items():
        write_out(watch.on(df, name), "watched")
    counted = watch.failures()
    assert counted == {c: n for c, n in CHECKS.items() if c.kind in quality.ROW_KINDS}
    scanned.clear()
    got = {(r.relation, r.check_name): r.failures for r in quality.report(list(CHECKS), tables, counted).collect()}
    assert got == {(c.relation, c.name): n for c, n in CHECKS.items()}
    assert not scanned


def test_watch_counts_the_last_write_and_several_relations(spark):
    checks_ = [Check("not_null", "a", ("id",)), Check("accepted_range", "b", ("id",), (0, 5))]
    watch = quality.Watch(checks_)
    for n in (3, 9):
        df = spark.range(n).selectExpr("nullif(id, 2) as id").hint("rebalance", F.col("id"))
        write_out(watch.on(df, "a", "b", "unknown"), "watched")
    assert watch.failures() == {checks_[0]: 1, checks_[1]: 3}


def test_relations_in_one_frame_are_checked_in_one_scan(spark, scanned):
    base = spark.range(10).select(F.when(F.col("id") > 2, F.col("id")).alias("v"))
    both = base.select("*", F.struct((F.col("v") * 2).alias("v")).alias("s"))
    checks_ = [Check("not_null", "raw", ("v",)), Check("accepted_range", "staged", ("v",), (0, 10)), Check("unique", "raw", ("v",))]
    relations = {"raw": base, "staged": both.select("s.v")}
    got = quality.report(checks_, relations, together=[(both, {"raw": "", "staged": "s"})]).collect()
    assert [r.failures for r in got] == [3, 4, 0]
    assert scanned == ["raw", "staged"]
    with pytest.raises(ValueError, match="own relation"):
        quality.failing(Check("expression_is_true", "raw", expression="v > 0"), "s")


def test_steps_run_together():
    met = threading.Barrier(3, timeout=20)
    assert run_together([lambda k=k: (met.wait(), k)[1] for k in range(3)]) == [0, 1, 2]
    assert run_together([]) == []
    done = []
    with pytest.raises(ZeroDivisionError):
        run_together([lambda: 1 // 0, lambda: done.append(1)])
    assert done == [1]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_fx_rules(spark):
    data = [
        (1, 1, 1, "t1", "1.0"),
        (2, 1, 2, "t1", "0"),
        (3, 1, 2, "t1", "100000"),
        (4, 2, 1, "t2", "100000.01"),
        (5, None, 1, "t2", None),
    ]
    rates = frame(spark, data, "fx_rate_id long, base_currency_id long, quote_currency_id long, rate_ts string, rate string")
    rates = rates.withColumn("rate", F.col("rate").cast("decimal(18,8)"))
    assert [r.fx_rate_id for r in checks.same_currency_pair(rates).collect()] == [1]
    assert sorted(r.fx_rate_id for r in checks.unreasonable_rate(rates).collect()) == [2, 4]
    assert rows(checks.repeated_rate(rates)) == [(1, 2, "t1", 2)]


def test_refund_rules(spark):
    orders = frame(spark, [(1, "2024-01-02", "10.00")], "order_id long, p string, t string").select(
        "order_id", F.col("p").cast("timestamp_ntz").alias("order_placed_at"), F.col("t").cast("decimal(12,2)").alias("total_amount")
    )
    data = [(1, 1, "2024-01-01", "10.00"), (2, 1, "2024-01-02", "10.01"), (3, 1, "2024-01-03", "10.02"), (4, 9, "2020-01-01", "99")]
    refunds = frame(spark, data, "refund_id long, order_id long, r string, a string").select(
        "refund_id", "order_id", F.col("r").cast("timestamp_ntz").alias("refund_ts"), F.col("a").cast("decimal(12,2)").alias("refund_amount")
    )
    assert [r.refund_id for r in checks.refund_before_order(refunds, orders).collect()] == [1]
    assert [r.refund_id for r in checks.refund_above_total(refunds, orders).collect()] == [3]


def test_order_rules(spark):
    data = [
        (1, "10", "10.04", "2024-01-01", "2024-01-02", "2024-01-03"),
        (2, "10", "10.06", "2024-01-03", "2024-01-02", "2024-01-03"),
        (3, "10", None, None, "2024-01-05", "2024-01-03"),
        (4, "10", "9.95", "2024-01-09", None, "2024-01-03"),
    ]
    orders = frame(spark, data, "order_id long, s string, i string, a string, p string, d string").select(
        "order_id",
        F.col("s").cast("decimal(12,2)").alias("subtotal"),
        F.col("i").cast("decimal(22,2)").alias("items_subtotal"),
        *[F.col(c).cast("timestamp_ntz").alias(n) for c, n in zip("apd", ["accepted_at", "picked_up_at", "delivered_at"])],
    )
    assert [r.order_id for r in checks.subtotal_mismatch(orders).collect()] == [2]
    assert sorted(r.order_id for r in checks.milestones_out_of_order(orders).collect()) == [2, 3]


def test_implication_and_sample(spark):
    df = spark.range(200).select(F.col("id").alias("order_id"), (F.col("id") % 2 == 0).alias("is_delivered"))
    df = df.withColumn("delivered_at", F.when(F.col("order_id") > 99, F.lit("t")))
    bad = checks.delivered_without_time(df)
    assert bad.count() == 50
    assert [r.order_id for r in quality.sample(bad, ["order_id"], 3).collect()] == [0, 2, 4]


def test_declared_checks_are_these():
    layers = {"raw": [81, 18, 18, 7], "stg": [66, 18, 16, 7], "int": [17, 8, 3, 1], "dim": [22, 2, 1, 2], "fct": [13, 0, 8, 3]}
    kinds = ["not_null", "unique", "relationships", "accepted_values"]
    found = Counter((c.relation.split("_")[0], c.kind) for c in checks.declared_checks())
    assert {layer: [found[layer, kind] for kind in kinds] for layer in layers} == layers
    others = {"unique_combination": (9, 3), "expression_is_true": (3, 3), "accepted_range": (2, 0)}
    assert {k: (found["dim", k], found["fct", k]) for k in others} == others
    assert sum(found.values()) == 331
