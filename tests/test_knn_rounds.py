"""kNN over many chunks: the rounds in which test rows meet them, and how they travel."""

import numpy as np
import pytest

from txnrisk.ml import knn as K


def test_reach_of_the_nearest_leaf_holds_k_rows():
    rnd = np.random.default_rng(4)
    v, q = rnd.normal(size=(300, 3)), rnd.normal(size=(40, 3))
    leaves = [(at, np.zeros(len(at)), v[at]) for at in K.kd_leaves(v, 30)]
    reach = K._reach(q, leaves, 5)
    true = np.sort(((q[:, None] - v[None]) ** 2).sum(2), 1)[:, 4]
    assert (reach >= true).all() and np.median(reach / true) < 20
    assert (K._reach(q, [(ids[:3], y[:3], x[:3]) for ids, y, x in leaves], 5) == 1e300).all()


def test_packs_hold_all_rows_once(monkeypatch):
    monkeypatch.setattr(K, "PACK", 10)
    monkeypatch.setattr(K, "PACKED", 25)
    packs, out = K._Packs(), []
    for i in range(30):
        n = i % 4 + 1
        out += packs.add(i % 7, np.arange(100 * i, 100 * i + n), np.full((n, 2), i), np.full(n, i / 2))
    out += packs.rest()
    got = [(c, *r) for b in out for c, n, ids, q, d in zip(*(b.column(k).to_pylist() for k in range(5)))
           for r in zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(q).reshape(n, -1)[:, 0].tolist(), np.frombuffer(d).tolist())]
    assert sorted(got) == sorted((i % 7, 100 * i + j, i, i / 2) for i in range(30) for j in range(i % 4 + 1))


@pytest.mark.parametrize("following", [1, 3, 1000])
def test_rounds_give_the_neighbours_of_the_matrix(spark, monkeypatch, following):
    rnd = np.random.default_rng(6)
    x = np.round(rnd.normal(size=(400, 3)), 1)                  # ties
    y = (rnd.random(400) < 0.3).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(400)], "TRANSACTION_ID long, TX_FRAUD int, a double, b double, c double")
    test = df.where("TRANSACTION_ID % 3 = 0").select("TRANSACTION_ID", "a", "b", "c")
    monkeypatch.setattr(K, "NEXT", following)
    for name, value in (("CHUNK_ROWS", 40), ("LEAF_ROWS", 8), ("QUERY_ROWS", 20), ("PACK", 7), ("PACKED", 40)):
        monkeypatch.setattr(K, name, value)
    many, one = (sorted(map(tuple, K.knn_scores(df, test, 5, ["a", "b", "c"], max_matrix_rows=n).select("TRANSACTION_ID", "prob_fraud").collect())) for n in (0, 1000))
    assert many == one and len(many) == 134
