"""The batched fits against plain forms of themselves."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnrisk.ml import frame as MF
from txnrisk.ml import logit as LG
from txnrisk.ml import trees as MT
from txnrisk.ml.model import PROB, FittedModel, blocks

COLS = [f"c{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark):
    rnd = np.random.default_rng(2)
    n = 900
    x = rnd.normal(size=(n, 5))
    x[:, 1] = np.round(x[:, 1])                 # ties
    x[:, 4] = 3.0                               # constant
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rnd.normal(size=n) > 1).astype(int)
    rows = [(i, int(i % 3 == 0), int(y[i]), *[None if rnd.random() < 0.03 else float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID long, fold long, TX_FRAUD int, " + ", ".join(f"{c} double" for c in COLS))
    scaling = MF.fit_scaling(df, COLS, F.col("fold"))
    ready = MF.inputs(df, scaling, F.col("fold"))
    local = ready.toPandas()
    return df, scaling, ready, {g: (np.stack(t["x"]), t["y"].to_numpy(), t["h"].to_numpy()) for g, t in local.groupby("grp")}


def test_scaling(data):
    df, scaling, _, local = data
    for g, (x, _, _) in local.items():
        assert np.allclose(x.mean(0), 0) and np.allclose(x.std(0)[:4], 1) and (x[:, 4] == 0).all()
        assert scaling.n[g] == len(x)
    whole = MF.fit_scaling(df.withColumn("c0", F.lit(None).cast("double")), COLS)
    assert whole.std[0][0] == 0


def test_weights_are_poisson_and_fixed():
    h = MF.mixed(np.arange(200_000, dtype=np.uint64)).view(np.int64)
    w = MF.bootstrap_weights(h, np.arange(4), 10)
    assert abs(w.mean() - 1) < 0.01 and abs(w.astype(float).var() - 1) < 0.02
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.01
    assert (w[500:600] == MF.bootstrap_weights(h[500:600], np.arange(4), 10)).all()
    assert (w[:, 2:] == MF.bootstrap_weights(h, np.array([2, 3]), 10)).all()


def conditions(x, y, s, spec, w):
    """Distance from the optimality conditions, written out."""
    cols = np.arange(x.shape[1]) if spec.member < 0 else MF.member_features(x.shape[1], spec.max_features, spec.member, spec.random_state)
    off = np.setdiff1d(np.arange(x.shape[1]), cols)
    assert (w[off] == 0).all()
    one = np.column_stack([x, np.ones(len(x))])
    slope = spec.C * one.T @ (s * (1 / (1 + np.exp(-one @ w)) - y))
    miss = []
    for j in [*cols, x.shape[1]]:
        if j == x.shape[1] and not spec.penalised_intercept:
            miss.append(abs(slope[j]))
        elif spec.penalty == "l2":
            miss.append(abs(slope[j] + w[j]))
        else:
            miss.append(abs(slope[j] + np.sign(w[j])) if w[j] else max(abs(slope[j]) - 1, 0))
    return max(miss)


def test_all_logistic_fits_are_optimal(data):
    _, scaling, ready, local = data
    specs = [LG.Logit("a", g, pen, c, own) for g in (0, 1) for pen in ("l1", "l2") for c in (0.01, 0.5, 50.0) for own in (True, False)]
    specs += [LG.Logit("b", 1, member=m, max_features=k, random_state=3) for m in range(6) for k in (1, 0.5)]
    fits = LG.fit_logits(ready, specs, 5, scaling.n)
    assert len(fits) == len(specs)
    for spec, w in fits.items():
        x, y, h = local[spec.group]
        s = np.ones(len(y)) if spec.member < 0 else MF.bootstrap_weights(h, np.array([spec.member]), 3)[:, 0]
        assert conditions(x, y, s, spec, w) <= 1e-6, spec
    assert any((w[:5] == 0).sum() > 1 for s, w in fits.items() if s.penalty == "l1")


def plain_tree(x, y, w, cols, depth=0, limit=None):
    """Grow on the raw values, every threshold tried; returns a function of a row."""
    share = (w * y).sum() / w.sum()
    best = None
    if 0 < (w * y).sum() < w.sum() and (limit is None or depth < limit):
        for c in cols:
            for t in np.unique(x[:, c])[:-1]:
                left = x[:, c] <= t
                score = sum(((w * y)[s].sum() ** 2 + (w * (1 - y))[s].sum() ** 2) / w[s].sum() for s in (left, ~left))
                if best is None or score > best[0] + 1e-9:
                    best = score, c, t
    if best is None:
        return lambda r: share
    _, c, t = best
    left = x[:, c] <= t
    a, b = (plain_tree(x[s], y[s], w[s], cols, depth + 1, limit) for s in (left, ~left))
    return lambda r: a(r) if r[c] <= t else b(r)


def test_trees_equal_a_plain_form(data):
    """With at most 255 distinct values an input's bins are its values."""
    _, scaling, ready, local = data
    rows = ready.where("grp = 1").withColumn("x", F.transform("x", lambda v: F.round(v, 1)))
    t = rows.toPandas()
    x, y, h = np.stack(t["x"]), t["y"].to_numpy(), t["h"].to_numpy()
    spec = MT.Forest("f", 1, members=3, max_features=0.7, random_state=5, max_depth=4)
    edges = MT.bin_edges(rows, 5)
    p = MT.TreePredictor(MT.fit_forests(MT.binned(rows, edges), [spec], edges, scaling.n).toArrow())
    got = p.value[p.leaves(x)]
    for m in range(3):
        w = MF.bootstrap_weights(h, np.array([m]), 5)[:, 0].astype(float)
        some = w > 0
        tree = plain_tree(x[some], y[some], w[some], spec.columns(m, 5), limit=4)
        assert np.abs(got[:, m] - np.array([tree(r) for r in x])).max() < 1e-9


def key(nodes):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in nodes.collect())


def test_levels_over_all_tasks_give_the_same_trees(data):
    _, scaling, ready, _ = data
    edges = MT.bin_edges(ready, 5)
    table = MT.binned(ready.repartition(3), edges)
    specs = [MT.Forest("f", 0, members=4, per_node=2, random_state=1), MT.Forest("g", 1, members=2, max_features=0.5, max_depth=3),
             MT.Forest("t", 1, members=1, bootstrap=False)]
    near = MT.fit_forests(table, specs, edges, scaling.n)
    assert key(near) == key(MT.fit_forests(table, specs, edges, scaling.n, small=40))
    boosts = [MT.Boosting("b", g, stages=3, rate=0.3, depth=2) for g in (0, 1)]
    assert key(MT.fit_boosting(table, boosts, edges, scaling.n)) == key(MT.fit_boosting(table, boosts, edges, scaling.n, small=10))


def test_trees_are_pure_and_hold_the_weights(data):
    _, scaling, ready, local = data
    edges = MT.bin_edges(ready, 5)
    spec = MT.Forest("f", 0, members=5, random_state=4)
    nodes = MT.fit_forests(MT.binned(ready, edges), [spec], edges, scaling.n)
    t = nodes.toPandas()
    leaf = t[t["input"] < 0]
    assert leaf["value"].isin([0.0, 1.0]).mean() > 0.98          # rows that share all bins stay together
    w = MF.bootstrap_weights(local[0][2], np.arange(5), 4).sum(0)
    assert leaf.groupby("member")["weight"].sum().tolist() == w.tolist()
    held = MT.leaf_totals(ready, MT.TreePredictor(nodes.toArrow()), spec).toPandas().merge(leaf, on=["member", "node"], suffixes=("", "_n"))
    assert len(held) == len(leaf) and (held["weight"] == held["weight_n"]).all()


def test_boosting_lowers_the_loss(data):
    _, scaling, ready, local = data
    edges = MT.bin_edges(ready, 5)
    nodes = MT.fit_boosting(MT.binned(ready, edges), [MT.Boosting("b", 0, stages=60, rate=0.1)], edges, scaling.n).toArrow()
    x, y, _ = local[0]
    losses = []
    for stages in (1, 10, 60):
        p = MT.TreePredictor(nodes.filter(pa.compute.less(nodes.column("member"), stages)), 0.1)
        z = p.start + 0.1 * p.sums(x)
        losses.append(float((np.logaddexp(0, z) - y * z).mean()))
    assert losses[0] > losses[1] > losses[2]


@pytest.mark.parametrize("kind,params", [("logistic", {"C": 0.5}), ("bagging_ensemble", {"base": "logistic", "max_features": 0.5, "n_members": 3, "random_state": 1}),
                                         ("forest", {"n_estimators": 4}), ("gbt", {"n_estimators": 4})])
def test_models_save_load_and_score_in_blocks(spark, data, tmp_path, kind, params):
    from txnrisk.ml.tuning import fit_config
    df, _, _, _ = data
    model = fit_config(df, kind, params, cols=COLS)
    model.save(str(tmp_path / "m"))
    again = FittedModel.load(spark, str(tmp_path / "m"))
    a, b = (m.transform(df).select("TRANSACTION_ID", PROB).orderBy("TRANSACTION_ID").toPandas() for m in (model, again))
    assert np.allclose(a[PROB], b[PROB], atol=1e-12) and a[PROB].between(0, 1).all()
    if model.predictor.kind == "trees":
        parts = blocks(model.predictor, limit=100)
        assert len(parts) == 4
        x = np.random.default_rng(0).normal(size=(50, 5))
        assert np.allclose(sum(p.sums(x) for p in parts), model.predictor.sums(x))


def test_wide_boosting_shares_its_passes(data, monkeypatch):
    """Boostings of several groups take the same passes, one for each level that splits, and their rows
    keep their scores between stages."""
    _, scaling, ready, _ = data
    edges = MT.bin_edges(ready, 5)
    table = MT.binned(ready.repartition(3), edges)
    boosts = [MT.Boosting("b", 0, stages=7, rate=0.3, depth=2), MT.Boosting("c", 1, stages=4, rate=0.2, depth=3)]
    near = key(MT.fit_boosting(table, boosts, edges, scaling.n))
    passes, level = [], MT._level
    monkeypatch.setattr(MT, "RESCORE", 2)
    monkeypatch.setattr(MT, "_level", lambda *a: passes.append(max(map(len, a[3].values()))) or level(*a))
    assert key(MT.fit_boosting(table, boosts, edges, scaling.n, small=10)) == near
    assert len(passes) == 4 * 3 + 3 * 2 and max(passes) < 2
    monkeypatch.setattr(MT, "FEW_HISTOGRAMS", 0)
    assert key(MT.fit_boosting(table, boosts, edges, scaling.n, small=10)) == near


def test_levels_of_a_subtree_equal_node_by_node():
    rnd = np.random.default_rng(5)
    for n, per_node, depth in ((700, None, None), (700, 2, None), (60, 1, 4), (1, 2, None)):
        bins = np.column_stack([rnd.integers(0, k, n) for k in (256, 7, 2, 40, 1)]).astype(np.uint8)
        w, y = rnd.integers(1, 4, n).astype(float), (rnd.random(n) < 0.3).astype(float)
        want = sorted((*r[:6], len(r[6]), w[r[6]].sum(), (w * y)[r[6]].sum()) for r in MT.grow(bins, w, y, 9, 1, depth, per_node, 77))
        levels = [np.concatenate(c) for c in zip(*MT.grow_levels(bins, w, y, 9, 1, depth, per_node, 77, part_rows=50))]
        assert sorted(zip(*(c.tolist() for c in levels[:9]))) == want
        part = dict(zip(levels[0].tolist(), levels[9].tolist()))
        for node, left, right, rows in zip(*(levels[i].tolist() for i in (0, 4, 5, 6))):
            assert part[node] == 0 if rows > 50 else part[node] != 0
            assert not left or rows > 50 or part[left] == part[right] == part[node]


@pytest.mark.parametrize("small", [40, MT.SMALL])
def test_trees_left_in_their_table_equal_the_arrays(data, small):
    """Routing rows to parts of trees: the same scores and leaf sums, also with leaves above the parts."""
    df, scaling, ready, local = data
    edges = MT.bin_edges(ready, 5)
    rows = ready.withColumn(MF.Y, F.when(F.col(MF.X)[0] > 0, F.col(MF.Y)).otherwise(0.0))          # half of all rows in pure leaves
    table = MT.binned(rows, edges)
    for spec in (MT.Forest("f", 0, members=4, per_node=2, random_state=1), MT.Forest("g", 1, members=2, max_features=0.7)):
        nodes = MT.fit_forests(table, [spec], edges, scaling.n, small, part_rows=30)
        assert nodes.where("part = 0 and input < 0").count() and nodes.where("part = node").count() > 2 * spec.members
        arrays, kept = MT.ensemble(nodes), MT.ensemble(nodes, few=3)
        assert isinstance(arrays, MT.TreePredictor) and isinstance(kept, MT.TreeTable)
        sums = [sorted(map(tuple, MT.leaf_totals(rows, p, spec).collect())) for p in (arrays, kept)]
        assert sums[0] == sums[1]
        a, b = (FittedModel(scaling, p, spec.group).transform(df.withColumn("share", F.lit(7))).select("TRANSACTION_ID", "c0", PROB).orderBy("TRANSACTION_ID").toPandas() for p in (arrays, kept))
        assert len(a) == len(b) and np.abs(a[PROB] - b[PROB]).max() < 1e-12 and a["c0"].equals(b["c0"])


def test_a_large_forest_is_never_collected(spark, data, tmp_path, monkeypatch):
    from txnrisk.ml.tuning import fit_config
    df, _, _, _ = data
    monkeypatch.setattr(MT.ensemble, "__defaults__", (None, 50))
    monkeypatch.setattr(MT.TreePredictor, "__init__", lambda *a: pytest.fail("collected"))
    model = fit_config(df, "forest", {"n_estimators": 4}, cols=COLS)
    model.save(str(tmp_path / "m"))
    again = FittedModel.load(spark, str(tmp_path / "m"))
    a, b = (m.transform(df).select("TRANSACTION_ID", PROB).orderBy("TRANSACTION_ID").collect() for m in (model, again))
    assert a == b and len(a) == df.count()
