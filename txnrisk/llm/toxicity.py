"""Toxic passages by maximum-scoring segments.

Training: the documents of each label that hold a token, and those that hold a word beginning, are
counted over all labelled documents.  The log-odds of a token are smoothed by a Dirichlet prior
whose mean comes from its word beginning (and that one's from a shorter one, and that one's from
the label share).  Scoring: less a drift that makes the expected token score negative, these are
scanned once per document for all maximal-scoring segments (Ruzzo and Tompa, 1999), in linear time.
Calibration: segment scores follow an extreme-value law; its scale comes from the score
distribution of tokens of label 0, its location from their best segments, and a logistic curve
over the length-corrected scores turns them into a probability."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import fixed_bitmap, flags, read_table, release, save
from .wordhash import ALNUM, blocks, mix, text_bytes, words

#: slots of the hashed count table (tokens and word beginnings)
SLOT_BITS = 20
#: bytes of the word beginnings, longest first
HEADS = (6, 4)
#: strength of the Dirichlet prior, in documents
PRIOR = 6.0
#: taken off each token's log-odds
DRIFT = 0.7
#: log-odds are clipped to plus or minus this
CLIP = 6.0
#: labelled documents that fix the calibration curve: the smallest hashes of each label, half of
#: them of each where there are so many, weighted back to the true share
CALIBRATION_ROWS = 4_000
#: passages are reported when their expected count by chance is below this
EXPECTED = 0.05
CUT = 0.7


def token_slots(column: pa.Array):
    """For each document of an Arrow column: (row, slots), slots of shape (1 + heads, tokens)."""
    data, offs = text_bytes(pc.utf8_lower(column))
    for lo, hi in blocks(offs):
        h, _, _, w = words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], ALNUM, HEADS)
        level = np.arange(len(h), dtype=np.uint64)[:, None]
        slots = (mix(h + level * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
        for i in range(lo, hi):
            yield i, slots[:, w[i - lo]:w[i - lo + 1]]


def pack(slots: np.ndarray) -> bytes:
    """Ascending distinct slots as 16-bit gaps; a gap of 65535 only adds up."""
    gap = np.diff(slots.astype(np.int64), prepend=-1)
    big = gap // 65535
    if not big.any():
        return gap.astype("<u2").tobytes()
    out = np.full(len(gap) + int(big.sum()), 65535, np.int64)
    out[np.cumsum(big + 1) - 1] = gap % 65535
    return out.astype("<u2").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    gap = np.frombuffer(raw, "<u2").astype(np.int64)
    return (np.cumsum(gap) - 1)[gap != 65535]


def log_odds(pos: np.ndarray, neg: np.ndarray, share: float, slots: np.ndarray, own: int | None = None) -> np.ndarray:
    """Smoothed log-odds of each token of one document.  ``own`` (0 or 1): leave the document's own
    count of that label out, for documents that were counted."""
    rate = np.full(slots.shape[1], share)
    for level in range(len(slots) - 1, -1, -1):
        a, b = pos[slots[level]], neg[slots[level]]
        if own is not None:
            a, b = np.maximum(a - own, 0), np.maximum(b - (1 - own), 0)
        rate = (a + PRIOR * rate) / (a + b + PRIOR)
    odds = np.log(rate / (1 - rate)) - np.log(share / (1 - share))
    return np.clip(odds, -CLIP, CLIP) - DRIFT


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, sum) in one pass.  Runs of one sign are merged
    before the scan, which takes constant amortised time per run."""
    if len(score) == 0 or score.max() <= 0:
        return []
    up = score > 0
    edge = np.concatenate([[0], np.flatnonzero(up[1:] != up[:-1]) + 1, [len(score)]])
    total = np.add.reduceat(score, edge[:-1]).tolist()
    edge = edge.tolist()
    done: list[tuple[int, int, float, float]] = []      # first, end, sum before, sum through
    link: list[int] = []                                # of each: the latest earlier one with a smaller sum before
    run = 0.0
    for r, t in enumerate(total):
        before, run = run, run + t
        if t <= 0:
            continue
        first, left, right = edge[r], before, run
        j = len(done) - 1
        while True:
            while j >= 0 and done[j][2] >= left:
                j = link[j]
            if j < 0 or done[j][3] >= right:
                break
            first, left = done[j][0], done[j][2]
            del done[j:], link[j:]
            j -= 1
        done.append((first, edge[r + 1], left, right))
        link.append(j)
    return [(a, b, hi - lo) for a, b, lo, hi in done]


def gumbel_scale(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum p e^(scale * score) = 1 (Karlin and Altschul, 1990)."""
    p = counts / counts.sum()
    if (values[counts > 0] > 0).sum() == 0 or (p * values).sum() >= 0:
        return 1.0
    lo, hi = 1e-6, 20.0
    for _ in range(80):
        mid = (lo + hi) / 2
        if (p * np.exp(np.minimum(mid * values, 500))).sum() < 1:
            lo = mid
        else:
            hi = mid
    return lo


class Model:
    """Token log-odds and the calibration; of fixed size."""

    def __init__(self, pos, neg, share):
        self.pos, self.neg, self.share = pos, neg, share
        self.scale, self.location, self.curve = 1.0, 0.0, np.array([-2.0, 0.0, 0.0])

    def features(self, segments, n: int) -> list[float]:
        """Length-corrected best score and log of the sum of the positive ones."""
        base = self.location + np.log(max(n, 1))
        z = [self.scale * s - base for _, _, s in segments]
        return [max(z, default=-base), float(np.log1p(sum(x for x in z if x > 0)))]

    def probability(self, f) -> float:
        x = self.curve[0] + self.curve[1] * f[0] + self.curve[2] * f[1]
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic coefficients by Newton steps, slopes kept non-negative."""
    mean, std = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / std])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (p - y)) + 0.1 * w
        h = (a * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ a + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
    w[1:] = np.maximum(w[1:], 0)
    return np.concatenate([[w[0] - (w[1:] * mean / std).sum()], w[1:] / std])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from (doc_id, text) and (doc_id, toxic): rows without either are left out, a document
    with several labels counts with each.  With one label or none, the model scores every document
    with the share of label 1 (1/2 without any)."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"))
    n = known.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos")).first()
    total, pos_total = n["n"], n["pos"] or 0
    slots = 1 << SLOT_BITS
    if not 0 < pos_total < total:
        share = pos_total / total if total else 0.5
        m = Model(np.zeros(slots), np.zeros(slots), 0.5)
        m.curve = np.array([np.log((share + 1e-3) / (1 - share + 1e-3)), 0.0, 0.0])
        return m
    share = pos_total / total
    chosen = spark.sparkContext.broadcast(fixed_bitmap(known, F.xxhash64("doc_id")))
    spotted = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", "text", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - 22).alias("spot"))

    def pick(batches):
        keep = flags(chosen.value)
        for b in batches:
            b = b.filter(pa.array(keep[b.column(2).to_numpy(zero_copy_only=False)]))
            if b.num_rows == 0:
                continue
            seen = [pack(np.unique(s)) for _, s in token_slots(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(seen, pa.binary())], names=["doc_id", "seen"])

    train = save(spotted.mapInArrow(pick, "doc_id long, seen binary").join(known, "doc_id"), "toxic-train")

    def count(batches):
        table = np.zeros((2, slots), np.int64)
        for b in batches:
            for raw, y in zip(b.column(0), b.column(1).to_pylist()):
                table[y, unpack(raw.as_buffer())] += 1
        at = np.flatnonzero(table.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(table[1][at]), pa.array(table[0][at])],
                                         names=["slot", "pos", "neg"])

    sums = (train.select("seen", "toxic").mapInArrow(count, "slot int, pos long, neg long")
            .groupBy("slot").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toArrow())   # 2**SLOT_BITS rows at most
    pos, neg = np.zeros(slots), np.zeros(slots)
    at = sums.column("slot").to_numpy()
    pos[at], neg[at] = sums.column("pos").to_numpy(), sums.column("neg").to_numpy()
    model = Model(pos, neg, share)

    drawn, rows = [], {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    for label in (0, 1):
        most = max(CALIBRATION_ROWS // 2, CALIBRATION_ROWS - rows.get(1 - label, 0))
        drawn += (train.where(F.col("toxic") == label).select("doc_id", "toxic").distinct()
                  .orderBy(F.hash("doc_id", F.lit(8)), "doc_id").limit(most).collect())
    ids = spark.createDataFrame(drawn, "doc_id long, toxic int")

    def read(batches):
        for b in batches:
            order = [s.T.reshape(-1) for _, s in token_slots(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(order, pa.list_(pa.int32())), b.column(1)], names=["tokens", "toxic"])

    sample = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic")     # CALIBRATION_ROWS ids
              .mapInArrow(read, "tokens array<int>, toxic int").toArrow())
    release(train)
    grid = np.arange(-(CLIP + DRIFT), CLIP, 0.05)
    hist = np.zeros(len(grid) + 1)
    found = []
    for s, y in zip(sample.column(0).combine_chunks(), sample.column(1).to_pylist()):
        s = s.values.to_numpy(zero_copy_only=False).reshape(-1, 1 + len(HEADS)).T
        v = log_odds(pos, neg, share, s, own=y)
        if y == 0:
            hist += np.bincount(np.searchsorted(grid, v), minlength=len(hist))
        found.append((y, maximal_segments(v), s.shape[1]))
    y = np.array([f[0] for f in found], float)
    if len(set(y)) < 2:
        return model
    model.scale = gumbel_scale(np.concatenate([grid, [CLIP]]) - 0.025, hist)
    null = [model.scale * max((s for _, _, s in seg), default=0.0) - np.log(max(n, 1)) for t, seg, n in found if t == 0]
    model.location = float(np.mean(null) - 0.5772156649)
    weight = np.where(y == 1, rows[1] / (y == 1).sum(), rows[0] / (y == 0).sum())
    model.curve = logistic(np.array([model.features(seg, n) for _, seg, n in found]), y, weight)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, best (length-corrected best segment) and passages (token spans with score and
    the number of such passages expected by chance).  Null and empty texts have no segment and get
    the score of that.  Each row is scored by itself, repeated ones alike; other columns are not read;
    an empty table gives an empty result."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for b in batches:
            score, best, spans = [], [], []
            for _, s in token_slots(b.column(1)):
                n = s.shape[1]
                seg = maximal_segments(log_odds(m.pos, m.neg, m.share, s))
                f = m.features(seg, n)
                score.append(m.probability(f))
                best.append(f[0])
                base = m.location + np.log(max(n, 1))
                spans.append([{"first": a, "end": e, "score": v, "expected": float(np.exp(base - m.scale * v))}
                              for a, e, v in seg if m.scale * v - base > -np.log(EXPECTED)])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()), pa.array(best, pa.float64()), pa.array(spans, kind)],
                                             names=["doc_id", "score", "best", "passages"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, best double, passages array<struct<first:int,end:int,score:double,expected:double>>")


def held_out() -> "F.Column":
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def without_toxic(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) whose text scores below ``cut``; repeated rows
    go or stay together, and an empty table stays empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches):
        m = sent.value
        for b in batches:
            keep = [m.probability(m.features(maximal_segments(log_odds(m.pos, m.neg, m.share, s)), s.shape[1])) < cut
                    for _, s in token_slots(b.column(text))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
