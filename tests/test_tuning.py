from conftest import SF0001
from pyspark.sql import functions as F

from txnrisk.ml.pipeline import PROB
from txnrisk.ml.tuning import GRID, scorer_average_precision, scorer_precision_top_k


def test_grid_is_the_workload_grid():
    assert len(GRID) == 11
    kinds = [k for _, k, _ in GRID]
    assert kinds.count("logistic") == 4 and kinds.count("bagging_ensemble") == 4
    assert kinds.count("forest") == 1 and kinds.count("gbt") == 2


def test_scorer_hooks(spark):
    df = spark.createDataFrame([(1, 0.9, 1, 0), (2, 0.8, 0, 0), (3, 0.7, 1, 1), (4, 0.1, 0, 1)],
                               "TRANSACTION_ID bigint, s double, TX_FRAUD bigint, TX_TIME_DAYS bigint") \
        .withColumn(PROB, F.col("s"))
    assert scorer_precision_top_k(1)(df).first()["score"] == 1.0
    # frauds at ranks 1 and 3: AP = 1/2 * 1/1 + 1/2 * 2/3
    assert abs(scorer_average_precision(df).first()["score"] - 5 / 6) < 1e-12


def _small(spark):
    from txnrisk.plans.training import train_test_features
    from txnrisk.sources import load_transactions
    return train_test_features(load_transactions(spark, SF0001), "2024-01-01")


def test_models_of_one_class(spark):
    from txnrisk.ml.tuning import fit_config, predict
    train, test = _small(spark)
    train = train.where("TX_FRAUD = 0")
    for kind, params in (("tree", {}), ("forest", {"n_estimators": 3}), ("bagging_ensemble", {"base": "tree", "max_features": 0.5, "n_members": 2, "random_state": 1})):
        rows = predict(fit_config(train, kind, params), test).select(PROB).distinct().collect()
        assert [r[0] for r in rows] == [0.0]
    for kind in ("logistic", "gbt"):
        assert predict(fit_config(train, kind, {"n_estimators": 2}), test).agg(F.max(PROB)).first()[0] < 0.05


def test_models_rank_frauds_above_chance_and_repeat(spark):
    from txnrisk.ml.tuning import fit_config, predict
    train, test = _small(spark)
    train = train.withColumn("TX_AMOUNT", F.col("TX_AMOUNT").cast("double") + 300 * F.col("TX_FRAUD"))
    test = test.withColumn("TX_AMOUNT", F.col("TX_AMOUNT").cast("double") + 300 * F.col("TX_FRAUD"))
    rate = test.agg(F.avg("TX_FRAUD")).first()[0]
    for kind, p in (("logistic", {"C": 0.5}), ("tree", {}), ("bagging", {"n_estimators": 3}), ("forest", {"n_estimators": 5}),
                    ("gbt", {"n_estimators": 3}), ("bagging_ensemble", {"base": "tree", "max_features": 0.5, "n_members": 4, "random_state": 10})):
        one = predict(fit_config(train, kind, p), test)
        assert scorer_average_precision(one).first()["score"] > rate, kind
        two = predict(fit_config(train, kind, p), test)
        a, b = ({r["TRANSACTION_ID"]: round(r[PROB], 9) for r in x.select("TRANSACTION_ID", PROB).collect()} for x in (one, two))
        assert a == b, kind


def test_select_refit_save_serve(spark):
    import uuid

    from txnrisk.ml.tuning import final_report, grid_search, predict
    from txnrisk.operators.snapshot import customer_snapshot, terminal_snapshot
    from txnrisk.operators.split import cv_folds
    from txnrisk.plans import serving as SV
    from txnrisk.plans.features import feature_table
    from txnrisk.session import scratch_path
    from txnrisk.sources import load_transactions
    train, test = _small(spark)
    folds = cv_folds(feature_table(load_transactions(spark, SF0001)), "2024-01-08", 2, 7, 7, 7)
    small = {"logistic": [("l2", "logistic", {"C": 0.5})],
             "ensemble": [("bag", "bagging_ensemble", {"base": "logistic", "max_features": 0.5, "n_members": 3, "random_state": 10})]}
    for name, grid in small.items():
        scores = grid_search(folds, grid=grid)
        assert scores.count() == 2
        report, model = final_report(scores, train, test, grid=grid, with_model=True)
        assert report.first()["test_average_precision"] == report.first()["test_score"]
        path = scratch_path(spark, f"served-{name}-{uuid.uuid4().hex}")
        SV.save_artifacts(path, model, customer_snapshot(train), terminal_snapshot(train))
        back, _, _ = SV.load_artifacts(spark, path)
        a, b = ({r["TRANSACTION_ID"]: round(r[PROB], 12) for r in predict(m, test).select("TRANSACTION_ID", PROB).collect()} for m in (model, back))
        assert a == b and len(a) == test.count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
