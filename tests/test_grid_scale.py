"""What keeps the grid and its reports affordable on large tables, and that it changes no result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnrisk.ml import frame as MF
from txnrisk.ml import logit as LG
from txnrisk.ml import trees as MT
from txnrisk.session import write_scratch

COLS = [f"c{i}" for i in range(4)]


@pytest.fixture(scope="module")
def ready(spark):
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(1200, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] + rnd.normal(size=1200) > 1).astype(int)
    rows = [(i, int(i % 3 == 0), int(y[i]), *map(float, x[i])) for i in range(1200)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID long, fold long, TX_FRAUD int, " + ", ".join(f"{c} double" for c in COLS))
    scaling = MF.fit_scaling(df, COLS, F.col("fold"))
    return scaling, write_scratch(MF.inputs(df, scaling, F.col("fold")).repartition(3), "grid-rows")


def key(nodes):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in nodes.collect())


def test_large_groups_start_from_a_share_of_their_rows(ready, monkeypatch):
    scaling, rows = ready
    specs = [LG.Logit("a", g, pen, 0.5, True) for g in (0, 1) for pen in ("l1", "l2")]
    specs += [LG.Logit("b", 0, member=m, max_features=k, random_state=3) for m in range(5) for k in (1, 0.5)]
    specs += [LG.Logit("c", 0, member=m, max_features=1, random_state=4) for m in range(5)]
    passes, sums = [], LG._sums
    monkeypatch.setattr(LG, "PACK", 4)
    monkeypatch.setattr(LG, "_sums", lambda rows, *a: passes.append(rows.count()) or sums(rows, *a))
    plain = LG.fit_logits(rows, specs, 4, scaling.n)
    full, before = max(passes), len(passes)
    passes.clear()
    monkeypatch.setattr(LG, "LARGE", 700)                       # group 0 only
    monkeypatch.setattr(LG, "SHARE", 3)
    monkeypatch.setattr(LG, "ENOUGH", 10)
    started = LG.fit_logits(rows, [s for s in specs if s.group == 0], 4, scaling.n)
    assert all(np.abs(w - plain[s]).max() < 1e-6 for s, w in started.items()) and len(started) == len(specs) - 2
    assert passes.count(full) < before and min(passes) < full / 2
    passes.clear()
    monkeypatch.setattr(LG, "ENOUGH", 10_000)                   # too few rows of a label: no start
    assert all(np.abs(w - plain[s]).max() < 1e-6 for s, w in LG.fit_logits(rows, specs, 4, scaling.n).items())


def test_trees_grow_in_blocks_over_rows_dealt_once_per_block(ready, monkeypatch):
    scaling, rows = ready
    edges = MT.bin_edges(rows, 4)
    table = MT.binned(rows, edges)
    specs = [MT.Forest("f", 0, members=7, per_node=2, random_state=1), MT.Forest("g", 0, members=7, max_features=1, random_state=1),
             MT.Forest("h", 1, members=5, max_features=0.5, max_depth=4), MT.Forest("t", 1, members=1, bootstrap=False)]
    whole = key(MT.fit_forests(table, specs, edges, scaling.n))
    monkeypatch.setattr(MT, "BLOCK_ROWS", 1)
    monkeypatch.setattr(MT, "BLOCKS", 6)
    assert key(MT.fit_forests(table, specs, edges, scaling.n)) == whole
    assert key(MT.fit_forests(table, specs, edges, scaling.n, small=50)) == whole
    assert key(MT.fit_forests(table, specs, edges, scaling.n, small=500)) == whole            # group 1 near, group 0 wide


def test_rows_are_scored_by_blocks_of_whole_trees(ready, monkeypatch):
    scaling, rows = ready
    edges = MT.bin_edges(rows, 4)
    nodes = MT.fit_forests(MT.binned(rows, edges), [MT.Forest("f", 0, members=30, per_node=2, random_state=1)], edges, scaling.n)
    kept, arrays = MT.ensemble(nodes, few=3), MT.ensemble(nodes)
    tests = rows.select("x", F.monotonically_increasing_id().alias("row"))
    monkeypatch.setattr(MT, "TASK_ROWS", 500)
    monkeypatch.setattr(MT, "TASK_NODES", nodes.count() // 4)
    met = kept._whole(tests, nodes.count()).groupBy("row").count()
    assert met.count() == rows.count() and met.agg(F.max("count")).first()[0] <= 8            # not a row per tree
    want = dict(zip([r["row"] for r in tests.collect()], arrays.value[arrays.leaves(np.array([r["x"] for r in tests.collect()]))].mean(1)))
    blocked = {r["row"]: r["share"] for r in kept.scores(tests).collect()}
    monkeypatch.setattr(MT, "TREE_NODES", 1)                    # in parts
    parted = {r["row"]: r["share"] for r in kept.scores(tests).collect()}
    assert blocked == parted and max(abs(blocked[k] - v) for k, v in want.items()) < 1e-12


def test_fold_scores_are_computed_once(spark, ready):
    from conftest import SF0001

    from txnrisk.ml.tuning import select_and_refit
    from txnrisk.plans.training import train_test_features
    from txnrisk.sources import load_transactions
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    train, _ = train_test_features(load_transactions(spark, SF0001), "2024-01-01")
    scores = spark.createDataFrame([(c, f, s + f / 10) for c, s in (("a", 0.2), ("b", 0.1)) for f in (0, 1)], "config string, fold long, score double")
    name, row, _ = select_and_refit(scores.mapInArrow(run, scores.schema), train, [("a", "logistic", {}), ("b", "logistic", {})])
    assert (name, round(row["mean_test_score"], 9)) == ("a", 0.25) and read.value == 4


def test_boosting_by_levels_equals_node_by_node(ready):
    rnd = np.random.default_rng(3)
    bins, y = rnd.integers(0, 40, (500, 3)).astype(np.uint8), (rnd.random(500) < 0.3).astype(float)
    spec, f = MT.Boosting("b", 0, 6, 0.3, 3), None
    for stage, tree in MT.boost(bins, y, spec):
        if stage < 0:
            f = np.full(500, tree[0][8])
            continue
        p = 1 / (1 + np.exp(-f))
        want = []
        for n, d, col, cut, a, b, at in MT.grow(bins, np.ones(500), y - p, MT.ROOT, 0, 3, None, 0, MT.spread):
            value = MT._leaf(float((y - p)[at].sum()), float((p * (1 - p))[at].sum())) if col < 0 else 0.0
            want.append((n, d, col, cut, a, b, len(at), float(len(at)), value))
            f[at] += spec.rate * value
        assert sorted(tree) == sorted(want)


def test_wide_boosting_keeps_its_rows_packed(ready, monkeypatch):
    scaling, rows = ready
    edges = MT.bin_edges(rows, 4)
    table = MT.binned(rows, edges)
    boosts = [MT.Boosting("b", g, stages=4, rate=0.3, depth=3) for g in (0, 1)]
    near = key(MT.fit_boosting(table, boosts, edges, scaling.n))
    written, write = {}, MT.write_scratch
    monkeypatch.setattr(MT, "write_scratch", lambda df, name: written.setdefault(name, write(df, name)))
    monkeypatch.setattr(MT, "RESCORE", 2)
    assert key(MT.fit_boosting(table, boosts, edges, scaling.n, small=10)) == near
    assert written["boost-rows"].count() < 20
