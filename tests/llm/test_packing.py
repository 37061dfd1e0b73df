import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from txnrisk.llm import packing

ALPHABET = "aAbBéÉ́̈ \x1c\x1d\x85\xa0　'sdtrevm1٣2.,!?漢字ßİΣς\n\t\r\x0b​ﬁⅫ😀"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.vocabulary_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check_pieces(rows, expected, capacity=packing.CAPACITY):
    """Every id of every document in one piece; sequences gapless, full or a power of two."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(docs) == set(expected)
    for d, pieces in docs.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(expected[d])
            assert p["ids_crc32"] == zlib.crc32(np.array(expected[d][at:at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(expected[d])
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == capacity or (at < capacity and at & (at - 1) == 0)


def test_encoder_equals_the_library(library):
    rnd = np.random.default_rng(5)
    enc = packing.WordEncoder(packing.vocabulary_path(), cache_bytes=20_000)
    for _ in range(3000):
        t = "".join(rnd.choice(list(ALPHABET), rnd.integers(0, 30)))
        if rnd.random() < 0.2:
            t = t[:9] + "<|endoftext|>" + t[9:]
        assert np.frombuffer(enc(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert enc.held < 40_000


def test_long_text_in_slices(library, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 1000)
    text = "Wörter und words, " * 2000 + "x" * 5000
    assert np.frombuffer(packing.WordEncoder(packing.vocabulary_path())(text), "<u4").tolist() == \
        library.encode(text, add_special_tokens=False).ids


def brute_assign(lengths, capacity):
    free = packing.capacities(sum(lengths), capacity).tolist()
    cost, out = [0.0] * len(free), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        left = lengths[i]
        while left:
            fits = [s for s in range(len(free)) if free[s] >= left] or [s for s in range(len(free)) if free[s]]
            s = min(fits, key=lambda s: cost[s])
            n = min(left, free[s])
            out.append((i, s, n))
            free[s], left, cost[s] = free[s] - n, left - n, cost[s] + packing.LINEAR * n + packing.QUADRATIC * n * n
    assert not any(free)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_assignment_against_a_plain_form(seed):
    lengths = np.random.default_rng(seed).integers(1, 64, 200)
    got = packing.assign(lengths, 64)
    assert [(i, s, n) for i, _, n, s, _ in got] == brute_assign(lengths.tolist(), 64)


def test_costs_are_balanced():
    lengths = np.random.default_rng(3).integers(1, 400, 5000)
    cost = defaultdict(float)
    for _, _, n, s, _ in packing.assign(lengths, 2048):
        cost[s] += packing.LINEAR * n + packing.QUADRATIC * n * n
    full = [c for s, c in cost.items() if s < int(lengths.sum()) // 2048]
    assert max(full) < 1.03 * min(full)


def test_small_tables(spark, library):
    texts = {1: "a few words", 2: "", 3: None, 4: "long text, " * 3000, 5: "a few words", 6: "no_blanks" * 700}
    docs = spark.createDataFrame([(i, t, i, i) for i, t in texts.items()], "doc_id int, text string, start int, part int")
    pieces = packing.pack_documents(docs, packing.vocabulary_path(), group_tokens=900).selectExpr("*", "crc32(ids) ids_crc32")
    check_pieces(pieces.collect(), {i: ids_of(library, t) for i, t in texts.items()})
    assert packing.pack_documents(docs.where("doc_id < 0"), packing.vocabulary_path()).count() == 0
    same = spark.createDataFrame([(None, "x")] * 3 + [(7, "y")] * 2, "doc_id long, text string")
    assert sorted((r["doc_id"] or 0) for r in packing.pack_documents(same, packing.vocabulary_path()).collect()) == [0, 0, 0, 7, 7]


SMALL = "/root/testdata/sf0.001"


def test_query(spark, library):
    rows = packing.op12_pack(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    check_pieces(rows, {d["doc_id"]: ids_of(library, d["text"]) for d in docs})
