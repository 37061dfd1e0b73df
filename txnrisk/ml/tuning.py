"""Grid search over sequential folds and the one-SD final report.

``CrossValidator`` trains each fold on all other folds, which cannot express
a train / delay / validation split in time.  Here every configuration of every
fold is a group of the batched fits: all logistic fits share their passes, all
trees of all ensembles grow in one job, and all folds are scored in one plan.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schema as S
from ..functions.numeric import round_half_even
from ..operators.metrics import cv_summary, mean_precision_top_k, ranking_metrics, select_one_sd
from ..operators.split import FOLD, ROLE
from ..session import write_scratch
from .frame import Scaling, fit_scaling, inputs
from .linear import LinearScorer
from .logit import Logit, LogitPredictor, fit_logits
from .model import FittedModel
from .pipeline import PROB, score
from .trees import SMALL, Boosting, Forest, bin_edges, binned, ensemble, fit_boosting, fit_forests

# The workload's parameter grid (11 configurations).
GRID = [
    ("logistic_l1_C0.5", "logistic", {"penalty": "l1", "C": 0.5, "penalised_intercept": True}),
    ("logistic_l1_C5", "logistic", {"penalty": "l1", "C": 5.0, "penalised_intercept": True}),
    ("logistic_l2_C0.5", "logistic", {"penalty": "l2", "C": 0.5, "penalised_intercept": True}),
    ("logistic_l2_C5", "logistic", {"penalty": "l2", "C": 5.0, "penalised_intercept": True}),
    ("bagging_tree_mf1", "bagging_ensemble", {"base": "tree", "max_features": 1, "n_members": 200, "random_state": 10}),
    ("bagging_tree_mf0.5", "bagging_ensemble", {"base": "tree", "max_features": 0.5, "n_members": 200, "random_state": 10}),
    ("bagging_logistic_mf1", "bagging_ensemble", {"base": "logistic", "max_features": 1, "n_members": 200, "random_state": 10}),
    ("bagging_logistic_mf0.5", "bagging_ensemble", {"base": "logistic", "max_features": 0.5, "n_members": 200, "random_state": 10}),
    ("rf_200", "forest", {"n_estimators": 200, "random_state": 10}),
    ("gbt_lr0.05_100", "gbt", {"n_estimators": 100, "learning_rate": 0.05, "max_depth": 3, "random_state": 10}),
    ("gbt_lr0.05_200", "gbt", {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 3, "random_state": 10}),
]


def specs_of(name: str, kind: str, params: dict, group: int, n_inputs: int, n_members: int | None = None) -> list:
    """The batched fits of one configuration on one group."""
    p = dict(params)
    if kind == "logistic":
        return [Logit(name, group, p.get("penalty", "l2"), p.get("C", 1.0), penalised_intercept=p.get("penalised_intercept", False))]
    if kind == "bagging_ensemble":
        members, state = n_members or p["n_members"], p["random_state"]
        if p["base"] == "tree":
            return [Forest(name, group, members, p["max_features"], random_state=state)]
        return [Logit(name, group, member=m, max_features=p["max_features"], random_state=state) for m in range(members)]
    if kind == "tree":
        return [Forest(name, group, 1, bootstrap=False, max_depth=p.get("max_depth"))]
    if kind == "bagging":
        return [Forest(name, group, p.get("n_estimators", 10), random_state=p.get("random_state", 0))]
    if kind == "forest":
        return [Forest(name, group, p.get("n_estimators", 100), per_node=max(1, int(n_inputs ** 0.5)), random_state=p.get("random_state", 0))]
    if kind == "gbt":
        return [Boosting(name, group, p.get("n_estimators", 100), p.get("learning_rate", 0.1), p.get("max_depth", 3))]
    raise ValueError(f"unknown classifier {kind!r}")


def fit_grid(rows: DataFrame, scaling: Scaling, grid, n_members: int | None = None, small: int = SMALL) -> dict[tuple[str, int], FittedModel]:
    """Every configuration of ``grid`` fitted on every group of ``rows`` (grp, x, y, h)."""
    n = len(scaling.cols)
    specs = [s for g in sorted(scaling.n) for name, kind, params in grid for s in specs_of(name, kind, params, g, n, n_members)]
    logits, forests, boosts = ([s for s in specs if isinstance(s, t)] for t in (Logit, Forest, Boosting))
    found: dict[tuple[str, int], FittedModel] = {}
    weights: dict[tuple[str, int], list] = {}
    with ThreadPoolExecutor(1) as aside:
        if forests or boosts:
            edges = bin_edges(rows, n)
            table = binned(rows, edges)
        # a boosting that is the beginning of a longer one is read off its first stages
        longest = {(s.group, s.rate, s.depth): s for s in sorted(boosts, key=lambda s: s.stages)}
        # stage after stage on few cores; the other fits take the rest
        stages = aside.submit(fit_boosting, table, list(longest.values()), edges, scaling.n, small) if boosts else None
        for spec, w in fit_logits(rows, logits, n, scaling.n).items() if logits else ():
            weights.setdefault((spec.config, spec.group), []).append((spec.member, w.tolist()))
        for key, w in weights.items():
            found[key] = FittedModel(scaling, LogitPredictor([v for _, v in sorted(w)]), key[1])
        nodes = fit_forests(table, forests, edges, scaling.n, small) if forests else None
        stages = stages.result() if boosts else None
        for s in forests:
            found[s.config, s.group] = FittedModel(scaling, ensemble(_nodes(nodes, s)), s.group)
        for s in boosts:
            some = _nodes(stages.where(F.col("member") < s.stages), longest[s.group, s.rate, s.depth])
            found[s.config, s.group] = FittedModel(scaling, ensemble(some, s.rate), s.group)
    return found


def _nodes(table: DataFrame, spec) -> DataFrame:
    """The nodes of one ensemble."""
    return table.where((F.col("config") == spec.config) & (F.col("grp") == spec.group))


def fit_config(train: DataFrame, kind: str, params: dict, n_members: int | None = None, cols: list[str] = S.INPUT_FEATURES) -> FittedModel:
    """Fitted model of a grid entry."""
    scaling = fit_scaling(train, cols)
    rows = write_scratch(inputs(train, scaling), "fit-rows")
    return fit_grid(rows, scaling, [("model", kind, params)], n_members)["model", 0]


def predict(model, df: DataFrame) -> DataFrame:
    """``df`` with ``prob_fraud``, by a model of :func:`fit_config`, an ML pipeline or a LinearScorer."""
    if isinstance(model, LinearScorer):
        return model.transform(df, PROB)
    return model.transform(df) if isinstance(model, FittedModel) else score(model, df)


def scorer_average_precision(scored: DataFrame, group_cols: list[str] = ()) -> DataFrame:
    return ranking_metrics(scored, S.TX_FRAUD, PROB, group_cols).select(*group_cols, F.col("average_precision").alias("score"))


def scorer_precision_top_k(k: int = S.TOP_K):
    def fn(scored: DataFrame, group_cols: list[str] = ()) -> DataFrame:
        return mean_precision_top_k(scored, k, S.TX_TIME_DAYS, PROB, group_cols=group_cols).select(
            *group_cols, F.col("mean_precision_top_k").alias("score"))
    return fn


def grid_scored(folds: DataFrame, grid=GRID, n_members: int | None = None, cols: list[str] = S.INPUT_FEATURES) -> DataFrame:
    """Validation rows scored by every configuration of their fold:
    (config, fold, TRANSACTION_ID, TX_TIME_DAYS, TX_FRAUD, prob_fraud), written once."""
    folds = write_scratch(folds.select(FOLD, ROLE, S.TX_ID, S.TX_TIME_DAYS, S.TX_FRAUD, *cols), "folds")
    train, val = folds.where(F.col(ROLE) == "train"), folds.where(F.col(ROLE) == "val")
    scaling = fit_scaling(train, cols, F.col(FOLD))
    rows = write_scratch(inputs(train, scaling, F.col(FOLD)), "fold-rows")
    out = None
    for (name, fold), model in fit_grid(rows, scaling, grid, n_members).items():
        one = model.transform(val.where(F.col(FOLD) == fold)).select(
            F.lit(name).alias("config"), F.col(FOLD), S.TX_ID, S.TX_TIME_DAYS, F.col(S.TX_FRAUD).cast("bigint").alias(S.TX_FRAUD), PROB)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = folds.limit(0).select(F.lit("").alias("config"), FOLD, S.TX_ID, S.TX_TIME_DAYS, S.TX_FRAUD, F.lit(0.0).alias(PROB))
    return write_scratch(out, "fold-scored")


def grid_search(folds: DataFrame, grid=GRID, scorer=scorer_average_precision, n_members: int | None = None) -> DataFrame:
    """Fold scores (config, fold, score) for every configuration.  ``folds`` is the output of
    :func:`cv_folds` over the feature table; ``scorer(scored, group_cols)`` gives a score per group."""
    return scorer(grid_scored(folds, grid, n_members), ["config", FOLD]).select("config", FOLD, "score")


def select_and_refit(fold_scores: DataFrame, train: DataFrame, grid=GRID, n_members: int | None = None):
    """(configuration, its CV summary row, model refitted on ``train``) of the one-SD choice."""
    summary = cv_summary(write_scratch(fold_scores, "fold-scores"))        # read by two jobs
    # equal means leave nothing strictly above the threshold: then the best rank, by name
    chosen = select_one_sd(summary).first() or summary.orderBy("rank_test_score", "config").first()
    name = chosen["config"]
    kind, params = next((k, p) for n, k, p in grid if n == name)
    return name, summary.where(F.col("config") == name).first(), fit_config(train, kind, params, n_members)


def final_report(fold_scores: DataFrame, train: DataFrame, test: DataFrame, grid=GRID,
                 scorer=scorer_average_precision, n_members: int | None = None, with_model: bool = False):
    """Choose by the one-SD rule, refit on train, score test: the scorer's own
    value, and both average precision and daily precision of the top alerts.  The three
    reported figures and the interval also come rounded half-even to two digits.
    ``with_model`` returns (report, refitted model) for saving and serving."""
    name, row, model = select_and_refit(fold_scores, train, grid, n_members)
    scored = write_scratch(predict(model, test).select(S.TX_ID, S.TX_TIME_DAYS, S.TX_FRAUD, PROB), "report-scored")
    value = lambda s: (lambda x: None if x is None else float(x))(s(scored).first()["score"])
    report = train.sparkSession.createDataFrame(
        [(name, row["mean_test_score"], row["lower_bd"], row["upper_bd"], value(scorer),
          value(scorer_average_precision), value(scorer_precision_top_k(S.TOP_K)))],
        "config string, cv_score double, lower_bd double, upper_bd double, test_score double, "
        "test_average_precision double, test_precision_top_k double")
    report = report.select("*", *[round_half_even(c, 2).alias(f"{c}_rounded") for c in ("cv_score", "lower_bd", "upper_bd", "test_score")])
    return (report, model) if with_model else report
