import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import scd2
from millrace.operators.scd2 import asof_join, backfill_first, first_history, merge_snapshot, version_dimension
from millrace.session import write_out
from millrace.sources import history
from millrace.sources.history import current_versions, read_history, record_snapshot

T = [f"2024-0{m}-01 00:00:00" for m in range(1, 7)]
SCHEMA = "id long, name string, note string"


def day(i):
    return datetime.fromisoformat(T[i])


def batch(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def merged(spark, batches):
    h = first_history(batch(spark, batches[0]), "id", T[0])
    for data, ts in zip(batches[1:], T[1:]):
        h = merge_snapshot(h, batch(spark, data), "id", ["name"], ts)
    return h


def windows(h):
    return {
        k: sorted((r.name, r.valid_from, r.valid_to) for r in g)
        for k, g in _grouped(h.collect()).items()
    }


def _grouped(found):
    out = {}
    for r in found:
        out.setdefault(r.id, []).append(r)
    return out


FIRST = [(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "d", "x"), (5, "e", "x")]
SECOND = [(1, "a2", "x"), (2, "b", "changed"), (3, "c", "x"), (4, None, "x"), (6, "new", "x")]


def test_merge_rules(spark):
    h = merged(spark, [FIRST, SECOND])
    got = {k: [(r.name, r.note, r.valid_from, r.valid_to) for r in sorted(g, key=lambda r: r.valid_from)] for k, g in _grouped(h.collect()).items()}
    assert got[1] == [("a", "x", day(0), day(1)), ("a2", "x", day(1), None)]
    assert got[2] == [("b", "x", day(0), None)]  # the change is outside the check columns
    assert got[3] == [(None, "x", day(0), day(1)), ("c", "x", day(1), None)]
    assert got[4] == [("d", "x", day(0), day(1)), (None, "x", day(1), None)]
    assert got[5] == [("e", "x", day(0), None)]  # missing keys stay current
    assert got[6] == [("new", "x", day(1), None)]


def test_merge_again_adds_nothing(spark):
    once = merged(spark, [FIRST, SECOND])
    twice = merge_snapshot(once, batch(spark, SECOND), "id", ["name"], T[2])
    assert rows(once) == rows(twice)


def test_version_ids_are_unique_and_stable(spark):
    h = merged(spark, [FIRST, SECOND, FIRST])
    ids = [r.scd_id for r in h.collect()]
    assert len(ids) == len(set(ids))
    one = h.where("id = 1 and valid_to is null").select(F.md5(F.lit(f"1|{T[2]}")) == F.col("scd_id"))
    assert one.first()[0]


def reference(batches):
    """The merge rules, one key at a time."""
    out = {}
    for i, data in enumerate(batches):
        for key, name, _ in data:
            versions = out.setdefault(key, [])
            if versions and versions[-1][0] == name:
                continue
            if versions:
                versions[-1][2] = day(i)
            versions.append([name, day(i), None])
    return {k: sorted((tuple(v) for v in vs), key=repr) for k, vs in out.items()}


state = st.dictionaries(st.integers(1, 5), st.sampled_from(["a", "b", None]), min_size=1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(state, min_size=2, max_size=4))
def test_merge_matches_the_rules(spark, states):
    batches = [[(k, n, "x") for k, n in s.items()] for s in states]
    h = merged(spark, batches).select("id", "name", "valid_from", "valid_to")
    got = {k: sorted(((r.name, r.valid_from, r.valid_to) for r in g), key=repr) for k, g in _grouped(h.collect()).items()}
    assert got == reference(batches)


def test_history_runs(spark, tmp_path):
    base = str(tmp_path / "history")
    for data, ts in zip([FIRST, SECOND, SECOND, FIRST], T):
        stored = record_snapshot(batch(spark, data), base, "id", ["name"], ts)
    expected = merged(spark, [FIRST, SECOND, SECOND, FIRST])
    assert rows(stored.select(*expected.columns)) == rows(expected)
    assert current_versions(spark, base).where("valid_to is not null").count() == 0


def test_snapshots_come_in_order(spark, tmp_path):
    base = str(tmp_path / "history")
    record_snapshot(batch(spark, FIRST), base, "id", ["name"], T[1])
    with pytest.raises(ValueError):
        record_snapshot(batch(spark, SECOND), base, "id", ["name"], T[0])


def test_history_of_an_empty_source(spark, tmp_path):
    base = str(tmp_path / "history")
    assert record_snapshot(batch(spark, []), base, "id", ["name"], T[0]).count() == 0
    assert record_snapshot(batch(spark, FIRST), base, "id", ["name"], T[1]).count() == len(FIRST)
    assert record_snapshot(batch(spark, []), base, "id", ["name"], T[2]).count() == len(FIRST)


def test_failed_run_is_ignored(spark, tmp_path):
    base = str(tmp_path / "history")
    record_snapshot(batch(spark, FIRST), base, "id", ["name"], T[0])
    record_snapshot(batch(spark, SECOND), base, "id", ["name"], T[1])
    before = rows(read_history(spark, base))
    batch(spark, FIRST).write.parquet(f"{base}/run=00000003/state=current")  # without _SUCCESS above it
    assert rows(read_history(spark, base)) == before
    after = record_snapshot(batch(spark, FIRST), base, "id", ["name"], T[2])
    assert after.where(F.col("valid_from") == F.lit(T[2]).cast("timestamp_ntz")).count() > 0


def versions(spark):
    h = merged(spark, [FIRST, SECOND, FIRST])
    return backfill_first(version_dimension(h, "sk", ["id", "name"]), "id")


def test_backfill_moves_only_the_first_version(spark):
    moved = {(r.id, r.name): r.valid_from for r in versions(spark).collect()}
    assert moved[(1, "a2")] == day(1)
    starts = versions(spark).where("id = 1").orderBy("valid_from").collect()
    assert [r.valid_from for r in starts] == [datetime(1900, 1, 1), day(1), day(2)]
    assert versions(spark).count() == merged(spark, [FIRST, SECOND, FIRST]).count()


FACTS = [
    (1, 1, datetime(1999, 1, 1)),
    (2, 1, day(1)),  # exactly at the boundary: the later version
    (3, 1, datetime(2024, 1, 31, 23, 59, 59)),
    (4, 1, datetime(2030, 1, 1)),
    (5, 99, datetime(2024, 1, 5)),
    (6, None, datetime(2024, 1, 5)),
    (7, 1, None),
]


def test_asof_boundaries(spark):
    facts = spark.createDataFrame(FACTS, "fact long, id long, ts timestamp_ntz")
    out = {r.fact: r for r in asof_join(facts, versions(spark), "id", "ts", ["name", "is_current"]).collect()}
    assert [out[i].name for i in range(1, 8)] == ["a", "a2", "a", "a", None, None, None]
    assert [out[i].is_current for i in (1, 2, 4)] == [False, False, True]


@pytest.mark.parametrize("broadcast", [True, False])
def test_long_histories_in_slices(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    base = datetime(2020, 1, 1).timestamp()
    long = [(1, f"v{i}", base + i * i * 60, base + (i + 1) ** 2 * 60 if i < 299 else None) for i in range(300)]
    short = [(k, f"s{k}", base, None) for k in range(2, 50)]
    dim = spark.createDataFrame(long + short, "id long, name string, f double, t double").select(
        "id",
        "name",
        F.timestamp_seconds("f").cast("timestamp_ntz").alias("valid_from"),
        F.timestamp_seconds("t").cast("timestamp_ntz").alias("valid_to"),
    )
    facts = spark.range(4000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 60).alias("key"),
        F.timestamp_seconds(F.lit(base - 3600) + F.col("id") * 1400).cast("timestamp_ntz").alias("ts"),
    ).withColumnsRenamed({"id": "fact", "key": "id"})
    plain = asof_join(facts, dim, "id", "ts", ["name"], long_history=10_000)
    sliced = asof_join(facts, dim, "id", "ts", ["name"], long_history=16)
    assert sliced.count() == 4000
    assert rows(sliced) == rows(plain)


@pytest.mark.parametrize("step", ["even", "burst"])
def test_long_backfilled_histories_are_cut_by_rows(spark, step, monkeypatch):
    """Bins hold about the same number of versions, wherever in time these lie; facts are not written."""
    kept = {}
    monkeypatch.setattr(scd2, "write_out", lambda df, label: kept.setdefault(label, write_out(df, label)))
    at = F.col("id") if step == "even" else F.when(F.col("id") < 750, F.col("id") / 1000).otherwise(F.col("id"))
    dim = spark.range(800).select(
        F.lit(1).alias("id"), F.col("id").alias("n"), (F.lit(1577836800) + at * 86400).alias("s")
    ).select("id", "n", F.timestamp_seconds("s").cast("timestamp_ntz").alias("valid_from"))
    ended = F.lead("valid_from").over(Window.partitionBy("id").orderBy("n"))
    dim = backfill_first(dim.withColumn("valid_to", ended), "id")
    facts = spark.range(500).select(F.col("id").alias("fact"), F.lit(1).alias("id"), F.expr("timestamp_ntz '2019-12-31 00:00:00' + make_interval(0, 0, 0, id * 2)").alias("ts"))
    out = asof_join(facts, dim, "id", "ts", ["n"], long_history=40)
    assert set(kept) == {"version-starts", "history-bins"}
    bins = kept["history-bins"]
    v = dim.select("id", F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))
    held = [r["count"] for r in scd2.into_bins(v, bins, "id", 40).groupBy("__bin").count().collect()]
    assert len(held) == 20 and max(held) <= 42
    plain = asof_join(facts, dim, "id", "ts", ["n"], long_history=10_000)
    assert rows(out) == rows(plain)


def brute_force(facts, dim):
    """Every pair of a fact and a version that holds at its time; facts without one are kept."""
    out = []
    for fact, key, ts in facts:
        found = [n for k, n, start, end in dim if key is not None and k == key and ts is not None and start <= ts and (end is None or ts < end)]
        out += [(fact, key, ts, n) for n in found or [None]]
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "kind, broadcast",
    [("bursts", True), ("hot key", True), ("overlaps", True), ("gaps and empty windows", True), ("hot key", False), ("overlaps", False)],
)
def test_binned_lookup_equals_brute_force(spark, kind, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(kind)
    base = datetime(2020, 1, 1)
    at = lambda minutes: base + timedelta(minutes=minutes)
    dim = []
    for key in range(6):
        n = 200 if key == 0 else rng.choice([1, 5, 9, 30])
        starts = sorted(rng.choice([rng.randrange(3), rng.randrange(500)]) if kind == "bursts" else rng.randrange(500) for _ in range(n))
        for k, start in enumerate(starts):
            following = starts[k + 1] if k + 1 < n else None
            if kind == "overlaps":
                end = rng.choice([None, start + rng.randrange(200), following])
            elif kind.startswith("gaps"):
                end = None if following is None else max(start - 3, following - rng.randrange(6))
            else:
                end = following
            dim.append((key, len(dim), at(start), None if end is None else at(end)))
    keys = [0] * 20 if kind == "hot key" else [0, 0, *range(8), None]
    facts = [(k, rng.choice(keys), rng.choice([at(rng.randrange(-20, 520)), at(rng.randrange(4)), None if k % 9 == 0 else at(100)])) for k in range(400)]
    left = spark.createDataFrame(facts, "fact long, id long, ts timestamp_ntz")
    right = spark.createDataFrame(dim, "id long, n long, valid_from timestamp_ntz, valid_to timestamp_ntz")
    expected = brute_force(facts, dim)
    for longest in (7, 10_000):  # two levels of bins, and none
        assert rows(asof_join(left, right, "id", "ts", ["n"], long_history=longest)) == expected


def many_runs(spark, base, runs, **options):
    """Snapshots of 20 keys, of which a few change each time."""
    for n in range(runs):
        data = [(k, f"{k}-{n // 2 if k % 3 else n // (k + 1)}", "x") for k in range(20)]
        at = (datetime(2024, 1, 1) + timedelta(hours=n)).isoformat(sep=" ")
        record_snapshot(batch(spark, data), base, "id", ["name"], at, **options)


def test_compacted_history_is_the_same_in_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "FAN_IN", 2)
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    many_runs(spark, plain, 9)
    many_runs(spark, small, 9, compact_every=2)
    expected = rows(read_history(spark, plain))
    assert rows(read_history(spark, small)) == expected
    assert rows(current_versions(spark, small)) == rows(current_versions(spark, plain))
    closed = [len(history._parts(spark, base)[0]) for base in (plain, small)]
    assert closed[0] >= 4 and closed[1] <= 2
    assert history.compact(spark, small) <= 2 and history.compact(spark, small) <= 2  # nothing new: nothing done
    assert rows(read_history(spark, small)) == expected
    assert history.drop_replaced(spark, small) > 0 and history.drop_replaced(spark, small) == 0
    assert rows(read_history(spark, small)) == expected
    many_runs_after = [(k, "new", "x") for k in range(20)]
    for base in (plain, small):
        record_snapshot(batch(spark, many_runs_after), base, "id", ["name"], "2024-02-01 00:00:00")
    assert rows(read_history(spark, small)) == rows(read_history(spark, plain))


def test_a_crash_before_the_manifest_loses_nothing(spark, tmp_path):
    base = str(tmp_path / "history")
    many_runs(spark, base, 4)
    before = rows(read_history(spark, base))
    # The segment is written, its manifest is not, or only without _SUCCESS.
    batch(spark, FIRST).write.parquet(f"{base}/segment=00000004")
    assert rows(read_history(spark, base)) == before
    spark.createDataFrame([(0, 0, "segment=00000004")], history.MANIFEST).write.parquet(f"{base}/manifest=00000004")
    (tmp_path / "history" / "manifest=00000004" / "_SUCCESS").unlink()
    assert rows(read_history(spark, base)) == before
    assert history.compact(spark, base) == 1
    assert rows(read_history(spark, base)) == before
    # A failed run after the manifest is ignored as well.
    batch(spark, FIRST).write.parquet(f"{base}/run=00000005/state=current")
    assert rows(read_history(spark, base)) == before
    assert history.drop_replaced(spark, base) > 0
    assert rows(read_history(spark, base)) == before


def test_refused_snapshots_leave_the_history(spark, tmp_path):
    base = str(tmp_path / "history")
    record_snapshot(batch(spark, FIRST), base, "id", ["name"], T[0])
    record_snapshot(batch(spark, SECOND), base, "id", ["name"], T[2])
    record_snapshot(batch(spark, SECOND), base, "id", ["name"], T[3])
    before = rows(read_history(spark, base))
    changed = [(k, "z", "x") for k, _, _ in SECOND]
    for data, ts, said in (([*FIRST, FIRST[0]], T[4], "several rows"), (changed, T[3], "different snapshot"), (changed, T[2], "taken after")):
        with pytest.raises(ValueError, match=said):
            record_snapshot(batch(spark, data), base, "id", ["name"], ts)
    assert rows(read_history(spark, base)) == before


def test_most_histories_need_one_step_to_find_a_bin(no_broadcast, monkeypatch):
    spark = no_broadcast
    bins = spark.createDataFrame([(k, n, datetime(2024, 1, 1, 1, n % 60)) for k in range(300) for n in range(40)], "id long, __number long, __start timestamp_ntz")
    facts = spark.createDataFrame([(k, datetime(2024, 1, 1, 1, k % 60)) for k in range(300)], "id long, ts timestamp_ntz")
    expected = [(k, datetime(2024, 1, 1, 1, k % 60), min(k % 60, 39)) for k in range(300)]
    out = scd2.in_bin(facts, bins, "id", F.col("ts"), "bin", 4)
    assert out._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
    assert rows(out) == sorted(expected, key=repr)
    monkeypatch.setattr(scd2, "FAN_OUT", 2)
    assert rows(scd2.in_bin(facts, bins, "id", F.col("ts"), "bin", 4)) == sorted(expected, key=repr)
