import glob
import time

from tallylake.llm import storage


def _shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = env.blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_a_stored_table_leaves_no_shuffle_files_and_no_setting(spark):
    before = _shuffle_files(spark)
    assert spark.conf.get(storage.CLEANUP, None) in (None, "false")
    counts = spark.range(5000).selectExpr("id % 700 AS k").repartition(7, "k").groupBy("k").count()
    got = storage.stored(counts, "test")
    for _ in range(50):  # removed in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(storage.CLEANUP, None) in (None, "false")
    assert got.count() == 700 and counts.count() == 700  # the table itself can still be used
    storage.discarded(got)
    assert not glob.glob(got.inputFiles()[0].replace("file://", ""))
