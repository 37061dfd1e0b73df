"""Preprocessing + classifier pipelines.

Pipeline: Imputer(mean) -> VectorAssembler -> StandardScaler(mean, std)
-> ElementwiseProduct(sqrt(n/(n-1))) -> classifier.  Spark's scaler divides
by the sample std; the product turns that into the population std the
workload standardises with.  Zero-variance columns become 0 either way.
"""

from __future__ import annotations

import math
import warnings

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import ElementwiseProduct, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..session import checkpoint_dir

LABEL = "label"
PROB = "prob_fraud"


def usable_inputs(train: DataFrame, cols: list[str], with_count: bool = False):
    """Columns with at least one non-null value in train (an all-null column
    cannot be imputed; it is dropped with a warning).  With ``with_count`` the
    row count comes back from the same aggregate: ``(cols, n)``."""
    counts = train.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in cols]).first().asDict()
    keep = [c for c in cols if counts[c] > 0]
    if len(keep) < len(cols):
        warnings.warn(f"dropping all-null inputs: {sorted(set(cols) - set(keep))}")
    return (keep, counts["__n"]) if with_count else keep


def preprocessing_stages(cols: list[str], n_train: int):
    imp_out = [f"__imp_{c}" for c in cols]
    factor = math.sqrt(n_train / (n_train - 1)) if n_train > 1 else 1.0
    return [
        Imputer(strategy="mean", inputCols=cols, outputCols=imp_out),
        VectorAssembler(inputCols=imp_out, outputCol="__raw", handleInvalid="keep"),
        StandardScaler(inputCol="__raw", outputCol="__std", withMean=True, withStd=True),
        ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(cols)), inputCol="__std",
                           outputCol="features"),
    ]


def prepare(df: DataFrame, cols: list[str], label: str = S.TX_FRAUD) -> DataFrame:
    """Cast inputs to double and the label to a double ``label`` column."""
    keep = [c for c in df.columns if c not in cols and c != LABEL]
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols],
                     F.col(label).cast("double").alias(LABEL))


def make_classifier(kind: str, seed: int = 0, **p):
    """Spark estimators matching the workload's model families.

    logistic: L2 (or L1) penalty C -> regParam 1/(C*n) needs n; see fit_pipeline.
    tree: grown deep (sklearn grows unbounded; Spark caps depth at 30).
    bagging: 10 bootstrapped full-feature trees = a random forest whose
    feature subset strategy is "all".
    """
    if kind == "logistic":
        # tol 1e-4 is the workload's (library default) stopping tolerance
        return LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=p.get("max_iter", 2000),
                                  tol=p.get("tol", 1e-4),
                                  elasticNetParam=1.0 if p.get("penalty", "l2") == "l1" else 0.0,
                                  standardization=False)
    if kind == "tree":
        return DecisionTreeClassifier(featuresCol="features", labelCol=LABEL, maxDepth=p.get("max_depth", 30),
                                      maxBins=p.get("max_bins", 256), seed=seed)
    if kind == "bagging":
        return RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=p.get("n_estimators", 10),
                                      featureSubsetStrategy="all", bootstrap=True, subsamplingRate=1.0,
                                      maxDepth=p.get("max_depth", 30), maxBins=p.get("max_bins", 256), seed=seed)
    if kind == "forest":
        return RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=p.get("n_estimators", 100),
                                      featureSubsetStrategy="sqrt", bootstrap=True,
                                      maxDepth=p.get("max_depth", 30), maxBins=p.get("max_bins", 256),
                                      seed=p.get("random_state", seed))
    if kind == "gbt":
        # predictions are checkpointed every 10 iterations (lineage stays short)
        return GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=p.get("n_estimators", 100),
                             stepSize=p.get("learning_rate", 0.1), maxDepth=p.get("max_depth", 3),
                             seed=p.get("random_state", seed), checkpointInterval=10)
    raise ValueError(f"unknown classifier {kind!r}")


def fit_preprocessing(train: DataFrame, cols: list[str] = S.INPUT_FEATURES):
    """(usable columns, train rows, fitted imputer-to-scaler pipeline)."""
    cols, n = usable_inputs(train, cols, with_count=True)
    return cols, n, Pipeline(stages=preprocessing_stages(cols, n)).fit(prepare(train, cols))


def fit_classifier(ready: DataFrame, kind: str, n: int, seed: int = 0, weight: str | None = None, **params):
    """Fit a classifier on prepared rows (label, features); ``n`` scales the logistic penalty."""
    if kind == "gbt":
        checkpoint_dir(ready.sparkSession)   # the shared folder; a scratch one only when unset
    clf = make_classifier(kind, seed, **params)
    if kind == "logistic":
        clf.setRegParam(1.0 / (params.get("C", 1.0) * max(n, 1)))
    if weight:
        clf.setWeightCol(weight)
    return clf.fit(ready)


def fit_pipeline(train: DataFrame, kind: str, cols: list[str] = S.INPUT_FEATURES, seed: int = 0,
                 **params) -> PipelineModel:
    """M3/M4: fit preprocessing + classifier on ``train`` (label TX_FRAUD)."""
    cols, n, pre = fit_preprocessing(train, cols)
    model = fit_classifier(pre.transform(prepare(train, cols)).select(LABEL, "features"), kind, n, seed, **params)
    return PipelineModel(pre.stages + [model])


def class_one(probability: str = "probability"):
    """P(class 1); 0 when the model saw class 0 alone and knows no other."""
    return F.coalesce(F.get(vector_to_array(probability), F.lit(1)), F.lit(0.0))


def score(model: PipelineModel, df: DataFrame, cols: list[str] = S.INPUT_FEATURES) -> DataFrame:
    """Append ``prob_fraud`` = P(class 1); keeps the input columns."""
    imp = model.stages[0]
    used = [c.replace("__imp_", "") for c in imp.getOutputCols()]
    base = prepare(df.withColumn(S.TX_FRAUD, F.coalesce(F.col(S.TX_FRAUD), F.lit(0)))
                   if S.TX_FRAUD in df.columns else df.withColumn(S.TX_FRAUD, F.lit(0)), used)
    out = model.transform(base)
    keep = [c for c in df.columns]
    return out.select(*keep, class_one().alias(PROB))
