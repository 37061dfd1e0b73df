import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from txnrisk.llm import balltree

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = [
    (1, "The quick brown fox, the lazy dog"), (2, "the QUICK fox"), (2, "quick quick quick"), (3, None), (4, ""), (5, "... --- \x7f \x01"),
    (None, "the quick fox"), (None, "lazy dog 42"), (6, "Ärger ärger naïve 日本 fox_dog"), (7, "dog " * 30_000 + "end"), (8, "the quick fox"),
    (9, "fox"), (10, "unrelated words only"), (11, "the quick fox")]
ITEMS = [(1, "The fox, the dog"), (1, "quick! Quick? lazy"), (2, None), (3, ""), (4, "Ärger 日本"), (5, "nothing known here"), (None, "fox 42"), (6, "the the the dog end")]


def plain(docs, items, k):
    terms = [TERM.findall((t or "").translate(FOLD)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    out = []
    for item, text in items:
        wanted, scored = set(TERM.findall((text or "").translate(FOLD))), []
        for (doc, _), ts in zip(docs, terms):
            tf = Counter(ts)
            m = 50 + (50 * len(ts) * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in wanted if t in tf)
            if s > 0:
                scored.append((-s, doc is not None, doc or 0))
        out += [(item, rank + 1, doc if known else None, -s) for rank, (s, known, doc) in enumerate(sorted(scored)[:k])]
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    clash = [F.lit(1).alias(c) for c in ("n", "terms", "tf", "score", "rank", "qno", "wave")]
    return (spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3).select("*", *clash),
            spark.createDataFrame(ITEMS, "item_id int, text string").select("*", *clash))


@pytest.mark.parametrize("options", [{}, {"k": 2}, {"k": 3, "wave_terms": 3, "tree_docs": 2, "floor_docs": 1}])
def test_against_brute_force(odd, options):
    assert rows(balltree.ranked_search(*odd, **options)) == sorted(plain(DOCS, ITEMS, options.get("k", 50)), key=str)


def test_empty_tables(odd):
    docs, items = odd
    assert balltree.ranked_search(docs.where("false"), items).count() == 0
    assert balltree.ranked_search(docs, items.where("false")).count() == 0
    assert balltree.ranked_search(docs.where("doc_id = 10"), items.where("item_id = 1")).count() == 0


def random_vectors(rnd, n, v):
    sizes = rnd.integers(1, 12, n)
    cols = np.concatenate([np.sort(rnd.choice(v, s, replace=False)) for s in sizes])
    return np.concatenate([[0], np.cumsum(sizes)]), cols, rnd.integers(1, 1_000_000, len(cols))


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_prune(seed):
    rnd = np.random.default_rng(seed)
    v, n = 400, 1500
    starts, cols, values = random_vectors(rnd, n, v)
    weights = rnd.integers(0, 15_000, v)
    tree = balltree.Tree(np.arange(n), starts, cols, values, weights)
    assert sorted(np.diff(tree.ends).tolist())[-1] <= balltree.LEAF_DOCS and tree.ends[-1] == n
    full = np.zeros((n, v), np.int64)
    full[np.repeat(np.arange(n), np.diff(starts)), cols] = values * weights[cols]
    terms = [np.sort(rnd.choice(v, 8, replace=False)) for _ in range(20)]
    indicator = np.zeros((v, len(terms)))
    for i, t in enumerate(terms):
        indicator[t, i] = 1
    bounds = tree.bounds(terms, indicator)

    def below(node):
        a, b = tree.nodes[node]
        return tree.ids[tree.ends[b]:tree.ends[b + 1]].tolist() if a < 0 else below(a) + below(b)

    leaves = sum(a < 0 for a, _ in tree.nodes)
    scored = 0
    for i, t in enumerate(terms):
        scores = full[:, t].sum(1)
        for node in range(len(tree.nodes)):
            assert bounds[node, i] >= scores[below(node)].max()
        best = balltree.Best(5, 1)
        scored += tree.search(t, bounds[:, i], best)
        want = sorted(range(n), key=lambda d: (-scores[d], d))[:5]
        assert best.ids.tolist() == [d for d in want if scores[d] > 0]
    assert scored < 0.8 * leaves * len(terms)


def test_equal_documents_and_a_lone_one():
    same = balltree.Tree(np.arange(100), np.arange(101), np.zeros(100, np.int64), np.full(100, 7), np.array([3]))
    assert len(same.ids) == 100 and max(same.radius) < 1
    one = balltree.Tree(np.array([5]), np.array([0, 1]), np.array([0]), np.array([7]), np.array([3]))
    assert one.nodes == [(-1, 0)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = sorted(con.execute(balltree.OP11_SQL).fetchall(), key=str)
    assert rows(balltree.op11_ball_tree(spark, SMALL)) == want
