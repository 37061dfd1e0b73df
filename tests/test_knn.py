import numpy as np
from conftest import SF0001
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnrisk import schema as S
from txnrisk.ml import knn as K
from txnrisk.ml.pipeline import PROB, prepare, preprocessing_stages
from txnrisk.plans.training import train_test_features
from txnrisk.sources import load_transactions

COLS = ["a", "b", "c"]


def brute(query, train, ids, k):
    out = []
    for q in query:
        d = [sum((x - y) ** 2 for x, y in zip(q, t)) for t in train]
        out.append([i for _, _, i in sorted((d[i], ids[i], i) for i in range(len(train)))[:k]])
    return out


def test_nearest_equals_brute_force_in_slabs(monkeypatch):
    rnd = np.random.default_rng(0)
    train = rnd.integers(0, 4, (200, 3)).astype(float)         # many ties
    query = rnd.integers(0, 4, (50, 3)).astype(float)
    ids = rnd.permutation(200)
    monkeypatch.setattr(K, "SLAB", 700)
    for k in (1, 5, 199, 200, 300):
        assert [n.tolist() for n, _ in K.slabs(query, train, ids, k)] == brute(query, train, ids, k)


def test_all_rows_by_pivots_equal_the_matrix(spark, monkeypatch):
    """More train rows than the matrix may hold, a chunk that most test rows meet, ties and odd values."""
    rnd = np.random.default_rng(1)
    n = 1500
    x = np.concatenate([rnd.normal(size=(900, 3)), np.zeros((300, 3)), rnd.normal(5, 0.1, size=(300, 3))]).round(2)
    rows = [(int(i), *map(float, v), int(rnd.random() < 0.3)) for i, v in zip(rnd.permutation(n), x)]
    train = spark.createDataFrame(rows, "TRANSACTION_ID long, a double, b double, c double, TX_FRAUD int")
    q = np.concatenate([rnd.normal(size=(100, 3)), np.zeros((150, 3)), [[100.0, 0, 0]]])
    test = spark.createDataFrame([(i % 200, *map(float, v)) for i, v in enumerate(q)], "TRANSACTION_ID long, a double, b double, c double")
    test = test.withColumn("b", F.when(F.col("TRANSACTION_ID") != 3, F.col("b")))
    monkeypatch.setattr(K, "PIVOTS", 12)
    monkeypatch.setattr(K, "CHUNK_ROWS", 40)
    monkeypatch.setattr(K, "QUERY_ROWS", 25)
    key = lambda df: sorted((tuple(-9.0 if v is None else v for v in r)) for r in df.select("TRANSACTION_ID", *COLS, PROB).collect())
    for k in (1, 5, 60):
        assert key(K.knn_scores(train, test, k, COLS, max_matrix_rows=n - 1)) == key(K.knn_scores(train, test, k, COLS))
    few = train.limit(3)
    assert key(K.knn_scores(few, test, 5, COLS, max_matrix_rows=2)) == key(K.knn_scores(few, test, 5, COLS))
    assert K.knn_scores(train, test.limit(0), 5, COLS, max_matrix_rows=10).count() == 0


def test_blocked_knn_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(K, "SLAB", 2_000)
    train, test = train_test_features(load_transactions(spark, SF0001), "2024-01-01")
    got = {r[S.TX_ID]: r["prob_fraud"] for r in K.knn_scores(train, test, k=5).collect()}
    # brute force in numpy on the same standardised features
    cols = S.INPUT_FEATURES
    n = train.count()
    prep = prepare(train, cols)
    pre = Pipeline(stages=preprocessing_stages(cols, n)).fit(prep)
    tr = pre.transform(prep).select(S.TX_ID, "label", vector_to_array("features").alias("v")).toPandas()
    te = pre.transform(prepare(test, cols)).select(S.TX_ID, vector_to_array("features").alias("v")).toPandas()
    tv, ty, tid = np.stack(tr["v"]), tr["label"].to_numpy(), tr[S.TX_ID].to_numpy()
    for qid, qv in zip(te[S.TX_ID], te["v"]):
        d2 = ((tv - np.asarray(qv)) ** 2).sum(axis=1)
        top = np.lexsort((tid, d2))[:5]
        assert abs(got[qid] - ty[top].mean()) < 1e-12
    assert len(got) == len(te)


def test_leaves_within_reach_hold_the_neighbours():
    """Of a tree's leaves, those within reach are few and hold all neighbours; equal rows are cut anywhere."""
    rnd = np.random.default_rng(3)
    train = np.concatenate([rnd.normal(size=(3000, 4)).round(2), np.ones((600, 4))])
    query = np.concatenate([rnd.normal(size=(40, 4)).round(2), np.ones((5, 4))])
    ids, y = rnd.permutation(len(train)), rnd.random(len(train))
    at = K.kd_leaves(train, 50)
    assert sorted(np.concatenate(at).tolist()) == list(range(len(train))) and max(map(len, at)) <= 50
    cuts = K.kd_cuts(train[::7], 12)
    cell = K.kd_cell(train, cuts)
    assert len(cuts) == 11 and set(cell.tolist()) == set(range(12))
    want = [(q, *r) for q, (n, d) in enumerate(K.slabs(query, train, ids, 5)) for r in zip(d.tolist(), ids[n].tolist())]
    reach = np.array([max(d for p, d, _ in want if p == q) for q in range(len(query))])
    q, d2, found, _ = K.within(query, reach, [(ids[a], y[a], train[a]) for a in at], 5)
    assert list(zip(q.tolist(), d2.tolist(), found.tolist())) == want
    low, high = (np.stack([f(train[a], axis=0) for a in at]) for f in (np.min, np.max))
    met = K.box_distances(query[:40], low, high) <= K._limit(query[:40], reach[:40])[:, None]
    assert (met @ np.array([len(a) for a in at])).mean() < 0.2 * len(train)
