from types import SimpleNamespace

import pytest

from txnrisk.session import checkpoint_dir, write_scratch


def test_write_scratch_keeps_rows_and_caches_nothing(spark):
    out = write_scratch(spark.range(0, 10_000, numPartitions=16), "t")
    assert out.count() == 10_000 and "Scan parquet" in out._jdf.queryExecution().executedPlan().toString().replace("FileScan", "Scan")
    assert write_scratch(spark.range(0), "t").count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_checkpoint_dir_prefers_the_session_setting(spark):
    d = spark.conf.get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    if d:
        assert got == d
    assert spark.sparkContext.getCheckpointDir() is not None


def test_a_cluster_must_name_the_shared_folder():
    unset = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        checkpoint_dir(cluster)
