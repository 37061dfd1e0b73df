from conftest import SF0001

import __spark_entry__ as E


def test_stream_equals_batch(spark):
    a = E.queries()["score_batch"](spark, SF0001)
    b = E.queries()["score_stream"](spark, SF0001)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
    assert set(a.columns) == {"TRANSACTION_ID", "prob_fraud"}


def test_bucketed_snapshots_reload_without_shuffle(spark):
    import uuid

    from pyspark.sql import functions as F

    from txnrisk.ml.pipeline import fit_pipeline
    from txnrisk.plans import serving as SV
    from txnrisk.plans.training import train_test_features
    from txnrisk.operators.snapshot import customer_snapshot, terminal_snapshot
    from txnrisk.session import scratch_path
    from txnrisk.sources import load_transactions
    train, _ = train_test_features(load_transactions(spark, SF0001), "2024-01-01")
    model = fit_pipeline(train, "logistic", C=0.5)
    path = scratch_path(spark, f"art-{uuid.uuid4().hex}")
    SV.save_artifacts(path, model, customer_snapshot(train), terminal_snapshot(train), buckets=4)
    for name, _ in SV.SNAPSHOTS:                       # forget the tables: the loader re-registers them
        spark.sql(f"DROP TABLE IF EXISTS {SV._table_name(path, name)}")
    _, snc, _ = SV.load_artifacts(spark, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        req = spark.range(50).select(F.col("id").alias("CUSTOMER_ID"))
        j = req.join(snc, "CUSTOMER_ID", "left")
        j.collect()
        plan = j._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
