"""Exact top-k inner product search by columnar branch-and-bound.

Candidates are held in vertical layout (one row per dimension).  Scores are accumulated a block of
dimensions at a time; after each block, a candidate whose partial score plus the product of the
remaining masses (Cauchy-Schwarz) is below the query's k-th best score so far is dropped, and the
next block touches the compacted survivors only.  Queries go through in waves of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import ordered_totals, read_table, save

K = 10
#: integers of all query vectors that one wave sends to the tasks
WAVE_VALUES = 1 << 18
#: candidates per block and dimensions per step
BLOCK = 4096
STEP = 16


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v, row): each component x as floor(scale * x), and a number of its own for each row; written
    once.  Rows whose id or vector is null, or whose vector holds a null or non-finite component, take
    no part."""
    x = F.col(vector)
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    return save(df.where(F.col(vec_id).isNotNull() & x.isNotNull() & good)
                .select(F.col(vec_id).cast("long").alias("vec_id"),
                        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"),
                        F.monotonically_increasing_id().alias("row")), "vectors")


def by_length(lists: pa.Array):
    """(length, places, matrix of vectors) for each vector length of an Arrow batch."""
    at = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    n = np.diff(at)
    for d in np.unique(n):
        rows = np.flatnonzero(n == d)
        yield int(d), rows, values[at[rows][:, None] + np.arange(d)[None, :]].reshape(len(rows), int(d))


class Wave:
    """The queries of one wave with one vector length, and their k best candidates so far."""

    def __init__(self, numbers, ids, rows, vectors, k: int):
        self.numbers, self.ids, self.rows, self.k = numbers, ids, rows, k
        self.order = np.argsort(-(vectors.astype(np.float64) ** 2).sum(0), kind="stable")
        self.q = vectors[:, self.order]
        self.steps = list(range(0, self.q.shape[1], STEP)) or [0]
        tail = np.cumsum((self.q[:, ::-1].astype(np.float64)) ** 2, 1)[:, ::-1]
        self.rest = np.sqrt(np.column_stack([tail, np.zeros(len(tail))]))
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]

    def feed(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> None:
        for lo in range(0, len(ids), BLOCK):
            self.block(ids[lo:lo + BLOCK], rows[lo:lo + BLOCK], np.ascontiguousarray(vectors[lo:lo + BLOCK, self.order].T))

    def block(self, ids: np.ndarray, rows: np.ndarray, vertical: np.ndarray) -> None:
        d = len(vertical)
        largest = float(np.abs(vertical).max(initial=0)) * float(np.abs(self.q).max(initial=0)) * max(d, 1)
        if largest >= 2.0 ** 52:                       # beyond exact doubles: plain 64-bit sums
            for i in range(len(self.ids)):
                self.keep(i, ids, rows, self.q[i] @ vertical)
            return
        c, q = vertical.astype(np.float64), self.q.astype(np.float64)
        mass = np.sqrt(np.vstack([np.cumsum(c[::-1] ** 2, 0)[::-1], np.zeros((1, c.shape[1]))]))
        first = q[:, :STEP] @ c[:STEP]
        for i in range(len(self.ids)):
            floor = self.best[i][1][-1] if len(self.best[i][1]) == self.k else -np.inf
            score, left = first[i], None               # left: indexes of the survivors
            for j in [*self.steps[1:], d]:
                limit = score + self.rest[i, j] * (mass[j] if left is None else mass[j][left])
                alive = np.flatnonzero(limit * (1 + 1e-12) + 1e-3 >= floor)
                left = alive if left is None else left[alive]
                score = score[alive]
                if j < d and len(left):
                    score = score + q[i, j:j + STEP] @ c[j:j + STEP][:, left]
            self.keep(i, ids[left], rows[left], score.astype(np.int64))

    def keep(self, i: int, ids: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        other = rows != self.rows[i]
        ids, score = np.concatenate([self.best[i][0], ids[other]]), np.concatenate([self.best[i][1], score[other]])
        top = np.lexsort((ids, -score))[:self.k]
        self.best[i] = ids[top], score[top]


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = K, wave_values: int = WAVE_VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of each query, ties to
    the smaller vec_id; both inputs are rows (vec_id, v, row) of one :func:`integer_vectors`.

    A query is compared with every row but itself (others may have its vec_id) of its vector length.  Each wave sends
    at most ``wave_values`` integers to the tasks, each task returns k rows per query, and one
    window keeps the best.  A repeated query row is answered as often as it occurs, repeated
    candidates count each; empty inputs give an empty result.  Scores are exact while they fit a
    64-bit integer."""
    spark = vectors.sparkSession
    widest = queries.agg(F.max(F.size("v"))).first()[0]
    wave = max(1, wave_values // max(widest or 1, 1))
    numbered = save(ordered_totals(queries, ["vec_id"], [], "queries"), "numbered-queries")
    n = numbered.count()
    found = None
    for w in range(max(1, -(-n // wave))):
        batch = (numbered.where((F.col("__row_no") >= w * wave) & (F.col("__row_no") < (w + 1) * wave))
                 .select("__row_no", "vec_id", "row", "v").toArrow().combine_chunks())      # at most `wave` rows
        sent = spark.sparkContext.broadcast(batch)

        def search(batches, sent=sent):
            waves: dict[int, Wave] = {}
            for t in sent.value.to_batches():
                number, ids, rows = (t.column(i).to_numpy() for i in range(3))
                for d, at, m in by_length(t.column(3)):
                    waves[d] = Wave(number[at], ids[at], rows[at], m, k)
            for b in batches:
                ids, rows = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
                for d, at, m in by_length(b.column(1)):
                    if d in waves:
                        waves[d].feed(ids[at], rows[at], m)
            for x in waves.values():
                sizes = [len(b[0]) for b in x.best]
                if sum(sizes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(x.numbers, sizes)), pa.array(np.repeat(x.ids, sizes)),
                         pa.array(np.concatenate([b[0] for b in x.best])), pa.array(np.concatenate([b[1] for b in x.best]))],
                        names=["qno", "query_id", "vec_id", "score"])

        part = save(vectors.select("vec_id", "v", "row").mapInArrow(search, "qno long, query_id long, vec_id long, score long"), "wave")
        found = part if found is None else found.union(part)
    order = Window.partitionBy("qno").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP6_SQL = """
with e as materialized (
  select row_number() over () as rn, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.rn, q.vec_id as query_id, c.vec_id,
         coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)::bigint as score
  from e q join e c on q.rn <> c.rn and len(q.v) = len(c.v) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by rn order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10
"""
