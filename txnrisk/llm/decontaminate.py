"""Benchmark decontamination: n-gram seeds, then local alignment.

Test items are cut into parts of at most 64 words, and every 3-gram of a part is a seed, however
often it occurs: an edited copy may hold none but those that it shares with exact copies.
Documents that hold a seed are joined to the parts of that seed, and the words around it are
aligned with the part (Smith-Waterman: match 1, mismatch and gap -1), which also scores edited and
paraphrased copies.  Pairs with too few words in common to reach the score are not aligned."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import fixed_bitmap, flags, read_table, save
from .wordhash import documents, sequence

GRAM = 3
#: words of a part of an item, and from one part to the next
PART, STRIDE = 64, 32
#: seeds in one cell of so many words share a window, with so many words on both sides
CELL, MARGIN = 64, 96
#: share of a part's words that the alignment score must reach, and the least score
SIMILARITY, LEAST = 0.4, 6

_U = np.uint64
LONGS = pa.list_(pa.int64())


def parts(items: DataFrame) -> DataFrame:
    """(item_id, part, words, grams) of the items with enough words for one n-gram."""
    def run(batches):
        for b, i, h in documents(batches, "text"):
            if len(h) < GRAM:
                continue
            starts = range(0, max(1, len(h) - PART + STRIDE), STRIDE)
            cuts = [h[s:s + PART] for s in starts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array([i] * len(cuts))), pa.array(range(len(cuts)), pa.int32()),
                 pa.array([c.view(np.int64) for c in cuts], LONGS),
                 pa.array([sequence(c, GRAM).view(np.int64) for c in cuts], LONGS)],
                names=["item_id", "part", "words", "grams"])
    return (items.where("item_id is not null").select("item_id", "text")
            .mapInArrow(run, "item_id long, part int, words array<long>, grams array<long>").where("size(grams) > 0"))


def windows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, first, words, grams): the words around the seeds of a document, a row per cell."""
    # the first and the next 22 bits of a gram: chance hits of one bitmap alone would bring many windows
    bits = docs.sparkSession.sparkContext.broadcast(
        (fixed_bitmap(chosen, F.col("gram")), fixed_bitmap(chosen, F.shiftleft("gram", 22))))

    def run(batches):
        keep, also = map(flags, bits.value)
        names, last, ids, rows = ["doc_id", "first", "words", "grams"], None, [], []

        def flush():
            ids, first, words, grams = zip(*rows)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(first, pa.int64()),
                                               pa.array(words, LONGS), pa.array(grams, LONGS)], names=names)

        for b, i, h in documents(batches, "text"):
            if b is not last:
                ids, last = b.column(0).to_pylist(), b
            g = sequence(h, GRAM)
            at = np.flatnonzero(keep[(g >> _U(42)).astype(np.int64)])
            at = at[also[((g[at] << _U(22)) >> _U(42)).astype(np.int64)]]
            for c in np.unique(at // CELL):
                lo = max(0, int(c) * CELL - MARGIN)
                held = np.unique(g[at[at // CELL == c]])
                rows.append((ids[i], lo, h[lo:(int(c) + 1) * CELL + MARGIN].view(np.int64), held.view(np.int64)))
                if len(rows) >= 1000:
                    yield flush()
        if rows:
            yield flush()

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        run, "doc_id long, first long, words array<long>, grams array<long>")


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman over a batch of word-hash rows (padded with different fillers): best score and
    the end in ``b``.  Gaps along ``b`` are a running maximum, so each word of ``a`` is a few array operations."""
    n, w = b.shape
    prev, best, end = np.zeros((n, w + 1), np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    ramp = np.arange(w, dtype=np.int32)
    for i in range(a.shape[1]):
        step = np.where(b == a[:, i:i + 1], 1, -1).astype(np.int32)
        row = np.maximum(np.maximum(prev[:, :-1] + step, prev[:, 1:] - 1), 0)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        at = row.argmax(1)
        top = row[np.arange(n), at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
        prev[:, 1:] = row
    return best, end


def padded(lists, filler: int) -> np.ndarray:
    out = np.full((len(lists), max(map(len, lists))), filler, np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, least: int = LEAST) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): documents of (doc_id, text) that hold a copy
    of a test item of (item_id, text), or of a 64-word part of a longer one; the best place each.

    score is the alignment score as a share of the part's words.  A copy without any unchanged
    three words in a row is not found.  Items with fewer than three words
    and rows without id, text or words take no part; repeated rows count once; of equally good places
    the first one is given; other columns are not read; empty inputs give an empty result.  A task
    holds the words of one document, about 30 times its bytes."""
    cut = save(parts(items), "decon-parts")
    chosen = save(cut.select(F.explode("grams").alias("gram"), "item_id", "part").distinct(), "decon-seeds")
    held = save(windows(docs, chosen), "decon-windows")
    pairs = (held.select("doc_id", "first", F.explode("grams").alias("gram")).join(chosen, "gram")
             .select("doc_id", "first", "item_id", "part").distinct())
    work = (pairs.join(cut.select("item_id", "part", F.col("words").alias("test")), ["item_id", "part"])
            .join(held.select("doc_id", "first", "words"), ["doc_id", "first"])
            .select("doc_id", "item_id", "first", "words", "test"))

    def run(batches):
        for big in batches:
            for lo in range(0, big.num_rows, 256):
                b = big.slice(lo, 256)
                words = [x.values.to_numpy() for x in b.column(3)]
                test = [x.values.to_numpy() for x in b.column(4)]
                n = np.array([len(t) for t in test])
                common = np.array([np.isin(t, x).sum() for t, x in zip(test, words)])       # the score at most
                able = np.flatnonzero((common >= similarity * n) & (common >= np.minimum(least, n)))
                if len(able) == 0:
                    continue
                b, n = b.take(pa.array(able)), n[able]
                words, test = [words[i] for i in able], [test[i] for i in able]
                best, end = align(padded(test, -1), padded(words, -2))
                hit = np.flatnonzero((best >= similarity * n) & (best >= np.minimum(least, n)))
                if len(hit) == 0:
                    continue
                back = [words[i][:end[i]][::-1] for i in hit]
                _, length = align(padded([test[i][::-1] for i in hit], -1), padded(back, -2))
                b = b.take(pa.array(hit))
                first = b.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(best[hit] / n[hit]), pa.array(first + end[hit] - length),
                     pa.array(first + end[hit])], names=["doc_id", "item_id", "score", "start_word", "end_word"])

    found = work.mapInArrow(run, "doc_id long, item_id long, score double, start_word long, end_word long")
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("score", (-F.col("start_word")).alias("s"), "end_word")).alias("m"))
            .select("doc_id", "item_id", "m.score", (-F.col("m.s")).alias("start_word"), "m.end_word"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                        read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
