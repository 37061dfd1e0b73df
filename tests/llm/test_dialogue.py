import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnrisk.llm import dialogue

SMALL = "/root/testdata/sf0.001"
LEGAL = re.compile("(s?(ua)+)?")
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_damage(rows):
    """The rows of each conversation after damage, by a plain reading of the contract."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        one = lambda x: " " if x is None else str(x)
        role, text = one(role), one(text)
        case = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out[conv] += [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: ((r[0] is not None, r[0] or 0), r[1].encode(), r[2].encode()))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows, faults):
    """All edits of at most the cost of deleting every row; no use of the grammar's states."""
    best = [(2 * len(rows), "D" * len(rows), ())]

    def go(i, cost, audit, turns):
        if cost > best[0][0]:
            return
        if i == len(rows) and LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in turns)) and (cost, audit) < best[0][:2]:
            best[0] = cost, audit, turns
        for role in ("user", "assistant"):
            go(i, cost + 5, audit + "I", (*turns, (role, "")))
        if i < len(rows):
            _, role, text = rows[i]
            go(i + 1, cost + 2, audit + "D", turns)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                go(i + 1, cost + more, audit + "K", (*turns, (role, text)))
                for new in ("user", "assistant"):
                    go(i + 1, cost + 1 + more, audit + "R", (*turns, (new, text)))
    go(0, 0, "", ())
    return best[0]


def plain(rows):
    out = {}
    for conv, held in plain_damage(rows).items():
        faults = faults_of(held)
        turns = [t for t, _, _ in held if t is not None]
        initials = [r[:1] for _, r, _ in held]
        cost, audit, repaired = brute_repair(held, faults)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def result(df):
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    rnd, out = np.random.default_rng(11), []
    for conv in [*range(400), None]:
        for _ in range(rnd.integers(1, 6)):
            out.append((conv, None if rnd.random() < 0.1 else int(rnd.integers(0, 7)), [None, "system", "user", "user", "assistant", "assistant", "tool", ""][rnd.integers(0, 8)],
                        [None, "", " \n", "Good.", "Cut", "Why? ", "a ", "Good."][rnd.integers(0, 8)]))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("cost", F.lit(1)).withColumn("__conv", F.lit(2))


def test_against_brute_force(table, rows):
    assert result(dialogue.repair_conversations(dialogue.damage(table)).digests()) == plain(rows)


@pytest.mark.parametrize("run_rows", [1, 3])
def test_cut_conversations_give_the_same(table, rows, run_rows):
    cut = dialogue.repair_conversations(dialogue.damage(table), max_rows=2, run_rows=run_rows)
    assert cut.long_ones.count() > 100
    assert result(cut.digests()) == plain(rows)
    whole = dialogue.repair_conversations(dialogue.damage(table))
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, cut.turns().collect()), key=key) == sorted(map(tuple, whole.turns().collect()), key=key)


def test_one_long_conversation(spark):
    long = spark.range(30_000).selectExpr("7L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role",
                                          "if(id % 3 = 0, 'again and again.', concat('row ', id, '.')) text")
    cut = dialogue.repair_conversations(long, run_rows=4_000)
    whole = dialogue.repair_conversations(long, max_rows=1 << 30)
    assert cut.long_ones.count() == 1 and whole.long_ones is None
    assert result(cut.digests()) == result(whole.digests())
    assert result(whole.digests())[7][2] == 10_000 - 2


def test_empty_and_dropped(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.repair_conversations(dialogue.damage(empty)).digests().count() == 0
    gone = spark.createDataFrame([(5, 1, "user", "Hi.", False)], "conv_id long, turn long, role string, text string, live boolean")
    assert result(dialogue.repair_conversations(gone).digests()) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_query(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(dialogue.op13_repair(spark, SMALL)) == plain(given)
