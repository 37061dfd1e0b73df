"""The corpus pipeline against a brute-force version of its stages."""

import sys
from collections import Counter, defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from txnrisk.llm import toxicity  # noqa: E402
from txnrisk.llm.tables import fixed_bitmap, in_bitmap, read_table  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    return corpus_pipeline.run(spark, SMALL)


def test_pipeline(spark, result):
    docs = read_table(spark, SMALL, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    model = toxicity.fit(docs.select("doc_id", "text"), read_table(spark, SMALL, "labels").where(~toxicity.held_out()))
    left = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < toxicity.CUT}
    groups = brute.jaccard_groups({d: text[d] for d in left}, 5, 80)
    left = {d for d in left if groups[d][1] == d}
    items = [brute.words(r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    near = {d for d in left if any(len(set(brute.words(text[d])) & set(w)) >= 0.4 * len(set(w)) * 0.5 for w in items)}
    leaked = {d for d in near if any(hit(w, brute.words(text[d])) for w in items)}
    left -= leaked
    size = {d: len(brute.words(text[d])) for d in left}
    by = defaultdict(int)
    for d in left:
        by[source[d]] += size[d]
    target = brute.water_fill(by)
    rows = result.collect()
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= left and max(copies.values()) <= 2
    for s in by:
        words = sum(copies[d] * size[d] for d in left if source[d] == s)
        assert abs(words - target[s]) <= max(size[d] for d in left if source[d] == s)
    shards = Counter(r.shard for r in rows)
    assert len(shards) == min(40, len(rows)) and max(shards.values()) - min(shards.values()) <= 1
    assert result.columns[:len(docs.columns)] == docs.columns


def hit(item, doc):
    """A window that holds an item scores as much as the whole document does."""
    parts = [item[i:i + 64] for i in range(0, max(1, len(item) - 32), 32)]
    return any(brute.best_alignment(p, doc) >= 0.4 * len(p) for p in parts if len(p) >= 3)


def test_stage_columns_and_odd_rows(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "same words here today", "en", "b", 1), (4, "same words here today", "en", None, 1),
            (3, "same words here today", "en", "b", 1), (None, "no id", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (False, 2), (False, 3), (True, 0)]
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SMALL).columns == docs.columns
        assert corpus_pipeline.shard(spark, frame, SMALL).count() == frame.count()


def test_one_id_of_several_texts_loses_none(spark):
    p, q, r = (" ".join(f"{c}{i}" for i in range(30)) for c in "pqr")
    rows = [(1, p), (2, p), (2, q), (3, r), (3, "a text of its own kind here"), (3, r), (4, q + " more"), (5, r)]
    docs = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    out = sorted((x.doc_id, x.text) for x in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect())
    assert out == sorted([(1, p), (4, q + " more"), (5, r), (3, "a text of its own kind here")])
    assert corpus_pipeline.mix(spark, docs, SMALL).columns == docs.columns


def test_near_duplicates_leave_other_texts_where_they_are(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20)), "en", "a", 1) for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "a", 1) for i in range(5)] + [rows[7], (None, "no id", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    plan = out._jdf.queryExecution().optimizedPlan()
    assert "LeftAnti" in plan.toString() and "LeftAnti" not in plan.children().apply(0).toString()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, i) for i in range(40)] + [(True, 0)]


def test_bitmap_marks_all_and_few_others(spark):
    ids = spark.range(20_000)
    bitmap = fixed_bitmap(ids.where("id % 10 = 0"), F.xxhash64("id"), 20)
    marked = [r.id for r in ids.where(in_bitmap(spark, bitmap, F.xxhash64("id"))).collect()]
    assert set(marked) >= set(range(0, 20_000, 10)) and len(marked) < 2_200
