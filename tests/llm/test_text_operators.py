"""The text operators against brute force, and on odd rows: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from txnrisk.llm import decontaminate, jaccard, mixing, passages, pii, sharding, tokens, topk, toxicity, warc  # noqa: E402
from txnrisk.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402
from txnrisk.llm.tables import components, ordered_totals  # noqa: E402
from txnrisk.llm.wordhash import words as word_hashes  # noqa: E402

SMALL = "/root/testdata/sf0.001"
P1 = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
P2 = " ".join(f"w{i}x{i * i}" for i in range(60))
ODD = [
    (0, P1, "en", "a", 1), (1, P1, "en", "b", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \t\n ", "en", "a", 3),
    (5, "one two", "de", "b", 7), (6, "One TWO", "de", None, 7), (7, "long " * 5000 + "end", "en", "c", 1), (8, P1 + " extra", "en", "a", 1),
    (9, "mail a.b@example.com.c@d.e or +1 (555) 123-4567 at 10.0.0.1 and 4111 1111 1111 1111", "en", "a", 1),
    (10, "x " * 30 + P2 + " tail words", "en", "b", 1), (11, "other start " + P2 + " y" * 20, "fr", "b", 1),
    (12, "1" * 400 + " naïve É 日本", "fr", "c", 1), (12, "1" * 400 + " naïve É 日本", "fr", "c", 1), (None, P1, "en", "a", 1)]
COLS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    clash = [F.lit(7).alias(c) for c in ("shard", "slot", "row_no", "size", "token", "n", "key", "part", "hilbert", "component", "target", "score")]
    return spark.createDataFrame(ODD, COLS).repartition(3).select("*", *clash)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLS)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(small):
    return {r.doc_id: r.text for r in small.select("doc_id", "text").collect()}


def oracle(name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    return sorted(tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect()) == oracle(name)


# --- shared helpers -------------------------------------------------------------------------

def test_ordered_totals(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 101).alias("k"), "id", (F.col("id") % 7).alias("w")).repartition(5)
    rows = sorted((r.k, r.id, r['__row_no'], r['__before_w'], r.w) for r in ordered_totals(df, ["k", "id"], ["w"], "t").collect())
    total = 0
    for i, (_, _, no, before, w) in enumerate(rows):
        assert (no, before) == (i, total)
        total += w


def test_components_chain_star_and_cycle(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    assert got == brute.components({x for p in links for x in p}, links)


@given(st.lists(st.text(alphabet="aB \t\né日z.", max_size=12), max_size=6))
@settings(max_examples=60, deadline=None)
def test_word_hashes(texts):
    data = "".join(texts).encode()
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    h, a, b, w = word_hashes(np.frombuffer(data, np.uint8), offs)
    for i, t in enumerate(texts):
        got = [data[x:y].decode().translate(brute.UPPER) for x, y in zip(a[w[i]:w[i + 1]], b[w[i]:w[i + 1]])]
        assert got == brute.words(t)
    flat = [x for t in texts for x in brute.words(t)]
    assert len(set(h.tolist())) == len(set(flat)) and len(h) == len(flat)


# --- 1 sharding -----------------------------------------------------------------------------

def test_hilbert_neighbours():
    n = 16
    xy = [(x, y) for x in range(n) for y in range(n)]
    index = sharding.hilbert_index([np.array([p[0] for p in xy]), np.array([p[1] for p in xy])], 4)
    path = [xy[i] for i in np.argsort(index)]
    assert sorted(index) == list(range(n * n))
    assert all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(path, path[1:]))


def law_holds(rows, n, shards=40):
    by = defaultdict(list)
    for shard, slot in rows:
        by[shard].append(slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards(spark, texts):
    rows = QUERIES["op1_hilbert_shards"](spark, SMALL).collect()
    law_holds([(r.shard, r.slot) for r in rows], len(texts))
    for r in rows:
        b = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 16, zlib.crc32(b), "rows", None)


def test_shards_odd_rows_and_files(spark, odd, empty, tmp_path):
    out = sharding.cut_runs(sharding.hilbert_order(odd, sharding.document_dims(odd), ["doc_id"]), 4)
    law_holds([(r.shard, r.slot) for r in out.collect()], len(ODD), 4)
    sharding.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(ODD)
    assert sharding.manifest(out, ["source"]).count() == 4
    assert sharding.cut_runs(sharding.hilbert_order(empty, sharding.document_dims(empty), ["doc_id"])).count() == 0


# --- 2 decontamination ----------------------------------------------------------------------

def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, (20, 7)), rng.integers(0, 4, (20, 15))
    best, end = decontaminate.align(a, b)
    for i in range(20):
        assert best[i] == brute.best_alignment(a[i], b[i])
        assert brute.best_alignment(a[i], b[i][:end[i]]) == best[i]


def test_contamination(spark, small, texts):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(12)
    parts = {r.item_id: brute.words(r.text) for r in items.collect()}
    want = {(d, i) for d, t in texts.items() for i, w in parts.items() if len(brute.words(t)) <= 400 and brute.best_alignment(w, brute.words(t)) >= 0.4 * len(w)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(small, items).collect() if len(brute.words(texts[r.doc_id])) <= 400}
    assert got == want


def test_contamination_edited_and_odd(spark, odd, empty):
    edited = P2.split()
    for i in range(4, 60, 9):
        edited[i] = "changed"
    items = spark.createDataFrame([(1, " ".join(edited)), (2, P1), (3, "too short"), (4, None), (5, "alpha beta"), (6, "never seen words here at all")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, items).collect()}
    assert got == {(10, 1), (11, 1), (0, 2), (1, 2), (8, 2)}
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(odd, items.limit(0)).count() == 0


def test_contamination_edited_copy_beside_an_exact_one(spark):
    item = [f"q{i}x{i * i}" for i in range(40)]
    docs = [(0, " ".join(item), "")]
    for step in range(4, 8):
        docs += [(10 * step + at, " ".join("changed" if i % step == at else w for i, w in enumerate(item)), "") for at in range(step)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    got = {r.doc_id: r.score for r in decontaminate.contaminated(df, items).collect()}
    want = {d: brute.best_alignment(item, t.split()) / 40 for d, t, _ in docs}
    assert got == {d: s for d, s in want.items() if s >= 0.4} and len(got) == len(docs)


# --- 3 WARC ---------------------------------------------------------------------------------

def test_plain_text():
    page = ("<html lang=fr><head><title>A &amp; B</title><style>p{}</style><script>var t=\"</p>\";</script></head><body><!-- x -->"
            "<p title='a>b'>one <b>two</b><br>three&nbsp;&copy; &#233;</p><div>4 < 5</div><script>open")
    assert warc.plain_text(page) == "A & B\none two\nthree © é\n4 < 5"
    assert "title: A & B\r\n" in warc.metadata_block(page, warc.HTTP, "d") and "language: fr" in warc.metadata_block(page, warc.HTTP, "d")


def test_warc_records_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x<a href='/y'>l</a>"), (2, None, None), (3, "http://c/", ""), (4, "http://d/", "<p>" + "é " * 50_000),
                                   (1, "http://a/", "<p>x<a href='/y'>l</a>")], "page_id long, url string, html string")
    records = warc.derivatives(warc.responses(pages))
    rows = records.collect()
    assert len(rows) == 10 and {r.record_type for r in rows} == {"metadata", "conversion"}
    for r in rows:
        assert r.block_digest == warc.digest(r.block) and r.content_length == len(r.block.encode())
    assert len({r.record_id for r in rows}) == 8 and len({r.refers_to for r in rows}) == 4
    warc.write_warc(records, str(tmp_path / "w"), "none")
    found = 0
    for f in (tmp_path / "w").glob("part-*"):
        raw = f.read_bytes()
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n:n + 4] == b"\r\n\r\n"
            assert fields["WARC-Block-Digest"] == warc.digest(rest[:n].decode()) and fields["WARC-Refers-To"].startswith("<urn:uuid:")
            raw, found = rest[n + 4:], found + 1
    assert found == 10
    undated = warc.derivatives(warc.responses(pages.limit(1)).withColumn("date", F.lit(None).cast("string")).withColumn("block", F.lit(1)))
    texts = [r.value for r in warc.record_text(undated).collect()]
    assert len(texts) == 2 and all(f"WARC-Date: {warc.NO_DATE}\r\n" in t and "Refers-To-Date" not in t for t in texts)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_warc_query_covers_every_page(spark):
    df = QUERIES["op3_warc_derivatives"](spark, SMALL)
    assert df.count() == 2 * spark.read.parquet(f"{SMALL}/pages.parquet").count()


# --- 4 Jaccard join -------------------------------------------------------------------------

@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (3, 50)])
def test_jaccard_small(spark, small, texts, k, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(small, k, percent).collect()}
    assert got == brute.jaccard_groups(texts, k, percent)


def test_jaccard_random_edits(spark):
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in rng.integers(0, 500, 120)]
    docs = {}
    for d in range(160):
        w = list(base) if d % 2 else [f"t{i}" for i in rng.integers(0, 500, 120)]
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(0, 120))] = f"e{int(rng.integers(0, 900))}"
        docs[d] = " ".join(w)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(df, 3, 90).collect()}
    assert got == brute.jaccard_groups(docs, 3, 90)


def test_jaccard_odd(odd, empty):
    rows = jaccard.jaccard_groups(odd, 3, 90).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert got == brute.jaccard_groups({r[0]: r[1] for r in ODD if r[0] is not None}, 3, 90)
    assert len(rows) == len(ODD) and [r.component_id for r in rows if r.doc_id is None] == [0]
    assert jaccard.jaccard_groups(empty).count() == 0


# --- 5 passages -----------------------------------------------------------------------------

def test_bands_reach_the_recall():
    bands, rows = passages.tune_bands(0.8, 0.98)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.98 > 1 - (1 - 0.8 ** rows) ** (bands - 1)


def test_repeated_passages(spark, small, texts):
    flagged = {r.doc_id for r in passages.repeated_passages(small).collect()}
    by = defaultdict(set)
    for d, t in texts.items():
        w = brute.words(t)
        for i in range(len(w) - 50):
            by[tuple(w[i:i + 51])].add(d)
    assert set().union(*[v for v in by.values() if len(v) > 1]) <= flagged
    short = defaultdict(list)
    for d, t in texts.items():
        w = brute.words(t)
        for i in range(len(w) - 6):
            short[tuple(w[i:i + 7])].append(d)
    assert flagged <= {d for v in short.values() if len(v) > 1 for d in v}


def test_passages_odd(spark, odd, empty):
    rows = passages.repeated_passages(odd).collect()
    place = {r.doc_id: r for r in rows if r.doc_id in (10, 11)}
    assert set(place) == {10, 11} and place[10].keep and not place[11].keep and place[11].first_doc_id == 10
    assert place[10].start_word >= 30 - 5 and place[10].end_word <= 30 + 60 + 5
    assert not {2, 3, 4, 5, 6} & {r.doc_id for r in rows}
    assert passages.repeated_passages(empty).count() == 0


def test_passages_in_short_lines(spark):
    rng = np.random.default_rng(11)
    word = lambda n: [f"v{x}" for x in rng.integers(0, 10**9, n)]
    rows = []
    for width in range(3, 13):
        lines = lambda w: "\n".join(" ".join(w[i:i + width]) for i in range(0, len(w), width))  # noqa: E731,B023
        for k in range(12):
            same = lines(word(60))
            rows += [(1000 * width + 2 * k + j, lines(word(50 + j)) + "\n" + same + "\n" + lines(word(40))) for j in (0, 1)]
    found = {r.doc_id for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {r[0] for r in rows}


def test_first_occurrences_stay_beside_repeats(spark):
    p, q = (" ".join(f"{c}{i}x{i * i}" for i in range(40)) for c in "pq")
    docs = spark.createDataFrame([(1, p), (2, p + "\n" + q), (3, q)], "doc_id long, text string")
    got = sorted((r.doc_id, r.start_word, r.end_word, r.first_doc_id, r.keep) for r in passages.repeated_passages(docs).collect())
    assert got == [(1, 0, 40, 1, True), (2, 0, 40, 1, False), (2, 40, 80, 2, True), (3, 0, 40, 2, False)]


def test_similar_keys_in_full_bands(spark, monkeypatch):
    same = lambda docs, *_: docs.select(F.lit(7).cast("long").alias("band"), "key").union(docs.select(F.lit(8).cast("long"), "key"))
    monkeypatch.setattr(passages, "band_keys", same)                 # every key shares the bands of all others
    monkeypatch.setattr(passages, "shingles_of", lambda docs, wanted: docs.join(wanted, "key"))
    rng = np.random.default_rng(4)
    keys = rng.permutation(240)
    sets = {}
    for i in range(0, 240, 3):
        own = list(range(1000 * i + 100, 1000 * i + 112 + i % 5))
        for j in range(3):                                           # frequent shingles in front, one edit each
            sets[int(keys[i + j])] = [1, 2, 3, *own[:-1], 1000 * i + 900 + j] if j else [1, 2, 3, *own]
    df = spark.createDataFrame(list(sets.items()), "key long, shingles array<long>")
    links = {(r.a, r.b) for r in passages.similar_keys(df, 80, 0.98).collect()}
    brute_links = {(a, b) for a in sets for b in sets if a < b
                   and 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})}
    assert links <= brute_links and brute.components(set(sets), links) == brute.components(set(sets), brute_links)


# --- 6 top-k --------------------------------------------------------------------------------

def test_top_k_waves_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8)], 0) for i in range(300)] + [(300, None, 0), (301, [1.0] * 7 + [None], 0),
            (302, [float("nan")] * 8, 0), (303, [float("inf")] * 8, 0), (304, [1.0] * 5, 0), (305, [1e11] * 8, 0), (7, [1.0] * 8, 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)
    v = topk.integer_vectors(df)
    plain = [(r.vec_id, r.v) for r in v.collect()]
    got = defaultdict(list)
    for r in topk.exact_top_k(v, v.where("vec_id % 50 = 0"), wave_values=20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    for q, x in plain:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in plain if i != q and len(x) == len(y))[:10]
            assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert topk.exact_top_k(v.limit(0), v.limit(0)).count() == 0
    same = topk.integer_vectors(spark.createDataFrame([(100, [1.0, 2.0]), (100, [3.0, 4.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<double>"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score >> 20) for r in topk.exact_top_k(same, same.where("vec_id = 100")).collect())
    assert got == [(100, 1, 100, 11), (100, 1, 100, 11), (100, 2, 7, 3), (100, 2, 7, 7)]


# --- 7 mixing -------------------------------------------------------------------------------

def test_mix_odd_rows(odd, empty, spark):
    rows = mixing.mix_sources(odd.drop("size").withColumn("size", mixing.word_count()).where("doc_id is not null")).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    target = brute.water_fill(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert mixing.mix_sources(empty.withColumn("size", F.lit(1).cast("long"))).count() == 0
    one = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert {(r.target, r.taken) for r in mixing.mix_sources(one).collect()} == {(0.0, 0)}


# --- 8 toxicity -----------------------------------------------------------------------------

@given(st.lists(st.integers(-5, 4), max_size=14))
@settings(max_examples=150, deadline=None)
def test_maximal_segments(score):
    x = [s + 0.01 * (i % 3) for i, s in enumerate(score)]
    got = toxicity.maximal_segments(np.array(x))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute.segments(x)]


@given(st.sets(st.integers(0, (1 << 20) - 1), max_size=30))
def test_packed_slots(slots):
    x = np.array(sorted(slots), np.int32)
    assert toxicity.unpack(toxicity.pack(x)).tolist() == x.tolist()


def test_toxicity_learns(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op8_toxicity"](spark, sf).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg) > 0.9


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1), (1, 0), (5, None), (99, 1), (0, 1)], "doc_id long, toxic int")
    for lab in (labels, labels.where("toxic = 1"), labels.limit(0)):
        model = toxicity.fit(odd, lab)
        rows = toxicity.score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        kept = toxicity.without_toxic(odd, model)
        assert kept.columns == odd.columns and kept.count() == sum(r.score < toxicity.CUT for r in rows)
        assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(empty, labels) is not None


def test_toxicity_calibrates_on_rare_labels(spark):
    ids = spark.range(20_000).select("id", F.abs(F.hash("id", F.lit(8)) % 1_000_000).alias("h")).orderBy(F.desc("h")).limit(6).collect()
    rare = {r.id for r in ids}                                   # none of them in a plain hash sample of 4,000
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"plain{x}" for x in rng.integers(0, 300, 12)) + (" vile nasty horrid filth" * 3 if i in rare else "")) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = toxicity.fit(docs, docs.select("doc_id", F.col("doc_id").isin(rare).cast("int").alias("toxic")))
    assert {r.doc_id for r in toxicity.score(docs, model).collect() if r.score >= toxicity.CUT} == rare


# --- 9 personal data ------------------------------------------------------------------------

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else 0,
                    "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@given(st.text(alphabet="a1@.+-_ ()é\n0", max_size=60))
@settings(max_examples=400, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_pii_query(spark, texts):
    for r in QUERIES["op9_pii"](spark, SMALL).collect():
        s = plain_spans(texts[r.doc_id])
        text = ",".join(f"{PLAIN[k][0]}:{a}:{b}" for a, k, b in s)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in s) for k in range(4)]
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))


def test_pii_bootstrapping_finds_unseen_identifiers(spark, empty, odd):
    rows = [(i, f"please call my extension +1 (555) 010-{1000 + i} today", None) for i in range(8)]
    rows += [(100, "then call my extension 555-01-77123 or wait", None), (101, "the year 20231 was long", None), (102, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string").repartition(3)
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert got[100].spans == "phone:23:35" and got[100].n_found == 1 and got[100].n_phone == 0
    assert got[101].n_found == 0 and got[102].spans == "" and got[102].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(empty).count() == 0 and pii.find_pii(odd).count() == len(ODD)


# --- 10 token files -------------------------------------------------------------------------

@given(st.text(alphabet=st.sampled_from("ab1é日.'s \n\t  \x1c!<|"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_pieces_give_the_same_ids(text):
    e = tokens.encoder(tokens.vocabulary_path())
    assert np.frombuffer(e(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>  y\n", "don<|endoftext|>'t a.<|endoftext|><|endoftext|> 1", "<|endoftext|"])
def test_added_tokens_as_the_library_encodes_them(text):
    from tokenizers import Tokenizer
    fresh = Tokenizer.from_file(tokens.vocabulary_path())
    e = tokens.encoder(tokens.vocabulary_path())
    assert np.frombuffer(e(text), "<u4").tolist() == fresh.encode(text, add_special_tokens=False).ids


def test_piece_cache_stays_bounded():
    e = tokens.PieceEncoder(tokens.vocabulary_path(), cache_bytes=20_000)
    texts = [" ".join(f"w{i}{chr(97 + j % 26)}" + "x" * (j % 3 * 70) for j in range(i, i + 40)) for i in range(0, 400, 4)]
    for t in texts:
        assert np.frombuffer(e(t), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids
        assert e.held <= 40_000


SPACES = " \n\t\r\x85\xa0\u3000\x1c"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(SPACES + "  \n\n" + "abcdefgzABÉß日'.,!?019<|>"), max_size=40))
def test_lines_and_words_give_the_same_ids(text):
    e = tokens.encoder(tokens.vocabulary_path())
    assert np.frombuffer(e(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def check_tokens(rows, docs):
    e, at = tokens.encoder(tokens.vocabulary_path()), 0
    got = {r.doc_id: r for r in rows}
    for d in sorted(docs):
        ids = e.tokenizer.encode(docs[d] or "", add_special_tokens=False).ids + [2]
        r = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_tokens(spark, texts):
    check_tokens(QUERIES["op10_token_ids"](spark, SMALL).collect(), texts)


def test_token_files(spark, odd, empty, tmp_path):
    path = str(tmp_path / "t")
    docs = odd.where("doc_id < 12")
    tokens.write_token_files(docs, path, tokens.vocabulary_path())
    check_tokens(tokens.with_crc32(tokens.read_token_files(spark, path)).collect(), {r[0]: r[1] for r in ODD if r[0] is not None and r[0] < 12})
    whole = {r.doc_id: (r.start, r.n_tokens) for r in tokens.read_token_files(spark, path).drop("ids").collect()}
    got = {r.doc_id for r in tokens.read_token_range(spark, path, 30, 90).collect()}
    assert got == {d for d, (s, n) in whole.items() if s < 90 and s + n > 30}
    import pyarrow.parquet as pq
    meta = pq.ParquetFile(next(f for f in Path(path, "ids").glob("*.parquet") if pq.ParquetFile(f).metadata.num_rows)).metadata.row_group(0)
    by = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert any("DICTIONARY" in e for e in by["ids.list.element"].encodings) and "DELTA_BINARY_PACKED" in by["doc_id"].encodings
    assert by["doc_id"].has_offset_index and by["doc_id"].has_column_index
    tokens.write_token_files(empty, str(tmp_path / "e"), tokens.vocabulary_path())
    assert tokens.read_token_files(spark, str(tmp_path / "e")).count() == 0
    tokens.write_token_files(odd, str(tmp_path / "n"), tokens.vocabulary_path())
    starts = sorted((r.start, r.n_tokens) for r in tokens.read_token_files(spark, str(tmp_path / "n")).collect())
    assert len(starts) == len(ODD) and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_new_words_of_many_texts_are_encoded_together():
    from tokenizers import Tokenizer
    e, calls = tokens.PieceEncoder(tokens.vocabulary_path()), []
    whole = e.encode_words
    e.encode_words = lambda new: calls.append(sorted(new)) or whole(new)
    made = ["a zorb, quux\nhead zorb", "", "b zorb quux! zorb,", "two  blanks", "\n\nc " + "long" * 60 + " zorb"]
    got = e.encode_texts(made)
    assert calls == [sorted({"zorb,", "quux", "zorb", "quux!", "long" * 60})]
    fresh = Tokenizer.from_file(tokens.vocabulary_path())
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [fresh.encode(t, add_special_tokens=False).ids for t in made]
