import os
from concurrent.futures import ThreadPoolExecutor

from millrace.session import CLEANUP_SETTING, size_shuffles, setting, write_out


def shuffle_files(spark):
    """Names of the shuffle files on the disks of this local session."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}


def test_writing_out_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    kept = write_out(spark.range(10_000).repartition(4, "id"), "kept")
    assert not shuffle_files(spark) - before
    assert kept.count() == 10_000


def test_writes_side_by_side_set_the_session_back(spark):
    with ThreadPoolExecutor(4) as pool:
        kept = list(pool.map(lambda n: write_out(spark.range(n).repartition(2, "id"), "kept"), range(100, 108)))
    assert [df.count() for df in kept] == list(range(100, 108))
    assert spark.conf.get(CLEANUP_SETTING) == "false"


def test_shuffle_partitions_follow_the_input(spark):
    with setting(spark, "spark.sql.shuffle.partitions", "8"):
        assert size_shuffles(spark, 100 << 20) == 8
        assert size_shuffles(spark, 6 << 30) == 96
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32MB"
