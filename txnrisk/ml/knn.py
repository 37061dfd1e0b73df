"""M8: k nearest neighbours, exact, over all train rows.

Up to ``max_matrix_rows`` standardised train rows travel to the tasks as one matrix, and the test rows
stay where they are.  Beyond that, train rows are dealt to the cells of a k-d tree whose pivots come from a
bounded sample, and within a cell to leaves of some hundred rows.  A test row is compared with its nearest
cell first, then with the next few; it meets only leaves whose bounding box lies within the reach found so far,
and at last all others of those.  Both ways give the same neighbours; ties go to the smaller train id."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from ..session import write_scratch
from .pipeline import LABEL, PROB, fit_preprocessing, prepare

MAX_MATRIX_ROWS = 200_000
# distances held at a time: 4M doubles
SLAB = 4_000_000
# cells between pivots at most, sampled rows per cell; train rows of a chunk (a cell, or a part of a crowded one; more
# where there are cells enough), test rows that meet a chunk in one task
PIVOTS = 2_048
SAMPLED = 32
CHUNK_ROWS = 8_192
QUERY_ROWS = 16_384
# rows of a leaf (more, so that the list of leaves stays bounded)
LEAF_ROWS = 256
MAX_LEAVES = 1 << 16
# test rows whose boxes are looked up at a time; cells met before the reach is measured again
LOOKUP = 1_024
NEXT = 4
# test rows that travel to a chunk as one value, and all that a task holds before it hands them on
PACK, PACKED = 4_096, 1 << 17
# share of the squares involved by which rounding may move a squared distance
ROUNDING = 1e-10


def nearest(query: np.ndarray, train: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, squared distances) of the k nearest train vectors of each query, by distance and id.
    A matrix product finds those that may be among them; their squares are summed in column order."""
    size_q, size_t = (query ** 2).sum(1), (train ** 2).sum(1)
    d2 = size_q[:, None] + size_t[None, :] - 2 * query @ train.T
    if k < len(train):
        slack = ROUNDING * (size_q + (size_t.max() if len(size_t) else 0.0)) + 1e-300
        edge = np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * slack
    else:
        edge = np.full(len(query), np.inf)
    out = []
    for q, row, e in zip(query, d2, edge):
        near = np.flatnonzero(row <= e)
        exact = np.cumsum((q - train[near]) ** 2, axis=1)[:, -1]
        best = np.lexsort((ids[near], exact))[:k]
        out.append((near[best], exact[best]))
    return out


def slabs(query: np.ndarray, train: np.ndarray, ids: np.ndarray, k: int):
    step = max(1, SLAB // max(len(train), 1))
    for lo in range(0, len(query), step):
        yield from nearest(query[lo:lo + step], train, ids, k)


def knn_scores(train: DataFrame, test: DataFrame, k: int = 5, cols: list[str] = S.INPUT_FEATURES,
               max_matrix_rows: int = MAX_MATRIX_ROWS, id_col: str = S.TX_ID, label: str = S.TX_FRAUD) -> DataFrame:
    """``test`` plus ``prob_fraud`` = share of frauds among the k nearest train rows (null without any)."""
    cols, n_train, pre = fit_preprocessing(train, cols)
    fitted = pre.transform(prepare(train, cols, label)).select(
        F.col(id_col).alias("tid"), F.col(LABEL).alias("y"), vector_to_array("features").alias("v"))
    keep = test.columns
    base = test.select(*[F.col(c).alias(f"__o_{c}") for c in keep], *[F.col(c).cast("double").alias(c) for c in cols])
    ready = pre.transform(base).select(*[F.col(f"__o_{c}").alias(c) for c in keep], vector_to_array("features").alias("__v"))
    if n_train > max_matrix_rows:
        return _by_pivots(fitted, ready, n_train, k).select(*keep, PROB)
    rows = fitted.toPandas()                        # max_matrix_rows at most
    matrix = np.stack(rows["v"].to_numpy()) if len(rows) else np.zeros((0, len(cols)))
    sent = train.sparkSession.sparkContext.broadcast((matrix, rows["tid"].to_numpy(), rows["y"].to_numpy(dtype="float64")))

    @F.pandas_udf("double")
    def share(v: pd.Series) -> pd.Series:
        vectors, ids, y = sent.value
        if len(vectors) == 0 or len(v) == 0:
            return pd.Series([None] * len(v), dtype="float64")
        return pd.Series([float(y[near].mean()) for near, _ in slabs(np.stack(v.to_numpy()), vectors, ids, k)])

    return ready.select(*keep, share("__v").alias(PROB))


def _matrix(lists: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def cut(v: np.ndarray) -> tuple[int, float] | None:
    """The (input, pivot) that halves the rows at the median of the input with the largest spread."""
    spread = np.ptp(v, axis=0) if len(v) else np.zeros(0)
    if not (spread > 0).any():
        return None
    i = int(np.where(spread > 0, v.var(0), -1.0).argmax())
    pivot = float(np.partition(v[:, i], (len(v) - 1) // 2)[(len(v) - 1) // 2])
    return i, pivot if (v[:, i] > pivot).any() else float(np.max(v[v[:, i] < pivot, i]))


def kd_leaves(v: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row places by leaf of a k-d tree with at most ``rows`` to a leaf; equal rows are cut anywhere."""
    out, stack = [], [np.arange(len(v))]
    while stack:
        at = stack.pop()
        found = cut(v[at]) if len(at) > rows else None
        if found is None:
            out += [at[lo:lo + rows] for lo in range(0, len(at), rows)]
            continue
        right = v[at, found[0]] > found[1]
        stack += [at[right], at[~right]]
    return out


def kd_cuts(v: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """(input, pivot, left, right) per inner node of a tree with about ``cells`` cells; a negative side -c-1 is cell c."""
    nodes: list[list] = []
    done, todo = 0, [(np.arange(len(v)), None, 0)]
    while todo:
        at, parent, side = todo.pop(0)                         # in the order of levels
        found = cut(v[at]) if done + len(todo) + 1 < cells else None
        if found is None:
            me, done = -done - 1, done + 1
        else:
            me = len(nodes)
            nodes.append([*found, 0, 0])
            right = v[at, found[0]] > found[1]
            todo += [(at[~right], me, 2), (at[right], me, 3)]
        if parent is not None:
            nodes[parent][side] = me
    return [tuple(n) for n in nodes]


def kd_cell(v: np.ndarray, cuts: list) -> np.ndarray:
    cell, stack = np.zeros(len(v), np.int64), [(0, np.arange(len(v)))] if cuts else []
    while stack:
        node, at = stack.pop()
        if node < 0:
            cell[at] = -node - 1
        elif len(at):
            i, pivot, left, right = cuts[node]
            side = v[at, i] > pivot
            stack += [(left, at[~side]), (right, at[side])]
    return cell


def box_distances(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """rows x boxes: how far a row lies from a box (0 inside)."""
    total = np.zeros((len(v), len(low)))
    for i in range(v.shape[1]):
        q = v[:, i:i + 1]
        total += np.maximum(np.maximum(low[None, :, i] - q, q - high[None, :, i]), 0) ** 2
    return np.sqrt(total)


def _limit(v: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """The distance of boxes that may hold rows within squared distance ``d2``, rounding included."""
    return np.sqrt(d2) + 1e-6 * (1 + np.abs(v).max(1, initial=0))


def _first(q: np.ndarray, d2: np.ndarray, ids: np.ndarray, y: np.ndarray, k: int):
    """The k nearest of each q, by distance and id."""
    order = np.lexsort((ids, d2, q))
    q, d2, ids, y = q[order], d2[order], ids[order], y[order]
    start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    keep = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q)))) < k
    return q[keep], d2[keep], ids[keep], y[keep]


def within(query: np.ndarray, d2: np.ndarray, leaves: list, k: int):
    """(query, squared distance, id, y): the k nearest rows of all ``leaves`` (ids, y, vectors) for each query, of
    those within its squared distance ``d2``."""
    parts = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0))]
    limit, size_q = _limit(query, d2), (query ** 2).sum(1)
    for ids, y, v in leaves:
        some = np.flatnonzero(box_distances(query, v.min(0)[None], v.max(0)[None])[:, 0] <= limit)
        size_t = (v ** 2).sum(1)
        for lo in range(0, len(some), max(1, SLAB // len(v))):
            at = some[lo:lo + max(1, SLAB // len(v))]
            about = size_q[at, None] + size_t[None, :] - 2 * query[at] @ v.T
            slack = ROUNDING * (size_q[at] + size_t.max()) + 1e-300
            q, row = np.nonzero(about <= (d2[at] + 2 * slack)[:, None])
            q = at[q]
            exact = np.cumsum((query[q] - v[row]) ** 2, axis=1)[:, -1] if v.shape[1] else np.zeros(len(q))
            parts.append(_first(q, exact, ids[row], y[row], k))
    return _first(*(np.concatenate(c) for c in zip(*parts)), k)


def _reach(q: np.ndarray, leaves: list, k: int) -> np.ndarray:
    """A squared distance within which each q has k rows: those of the leaf that it lies nearest to."""
    out = np.full(len(q), 1e300)                               # any distance, where that leaf has fewer
    near = box_distances(q, np.stack([v.min(0) for _, _, v in leaves]), np.stack([v.max(0) for _, _, v in leaves])).argmin(1)
    size_q = (q ** 2).sum(1)
    for n, (_, _, v) in enumerate(leaves):
        mine, size_t = np.flatnonzero(near == n) if len(v) >= k else np.zeros(0, np.int64), (v ** 2).sum(1)
        for lo in range(0, len(mine), max(1, SLAB // len(v))):
            at = mine[lo:lo + max(1, SLAB // len(v))]
            about = size_q[at, None] + size_t[None, :] - 2 * q[at] @ v.T
            out[at] = np.maximum(np.partition(about, k - 1, axis=1)[:, k - 1], 0) + 2 * (ROUNDING * (size_q[at] + size_t.max()) + 1e-300)
    return out


class _Packs:
    """Test rows on their way to the chunks they meet, some thousands as one value."""

    schema = "chunk long, n long, qid binary, q binary, limit binary"

    def __init__(self):
        self.held, self.n = {}, 0

    def add(self, chunk: int, qid: np.ndarray, q: np.ndarray, limit: np.ndarray):
        """Take rows for a chunk; the batches that are ready."""
        self.held.setdefault(chunk, []).append((qid, q, limit))
        self.n += len(qid)
        if sum(len(c[0]) for c in self.held[chunk]) >= PACK:
            yield self._batch([chunk])
        if self.n >= PACKED:
            yield from self.rest()

    def rest(self):
        if self.held:
            yield self._batch(list(self.held))

    def _batch(self, chunks: list[int]) -> pa.RecordBatch:
        rows = []
        for c in chunks:
            qid, q, limit = (np.concatenate(x) for x in zip(*self.held.pop(c)))
            self.n -= len(qid)
            rows.append((c, len(qid), qid.astype(np.int64).tobytes(), q.astype(float).tobytes(), limit.astype(float).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                                          names=["chunk", "n", "qid", "q", "limit"])


def _meet(queries: DataFrame, leaves: DataFrame, k: int) -> DataFrame:
    """(qid, d2, tid, y): the k nearest rows of its ``chunk`` for each test row of ``queries`` (:class:`_Packs`),
    within its squared distance ``limit``.  A chunk with many test rows is met in several tasks, each with its part
    of them and all of the chunk."""
    spark, names = leaves.sparkSession, ["qid", "d2", "tid", "y"]
    parts = queries.groupBy("chunk").agg(F.ceil(F.sum("n") / QUERY_ROWS).cast("int").alias("parts")).orderBy("chunk").collect()     # chunks: PIVOTS rows, and parts of crowded ones
    ends = np.cumsum([r["parts"] for r in parts]).tolist()
    met = F.broadcast(spark.createDataFrame([(r["chunk"], end - r["parts"], r["parts"]) for r, end in zip(parts, ends)], "chunk long, first int, parts int"))
    left = queries.join(met, "chunk").select((F.col("first") + F.pmod(F.xxhash64("qid"), "parts").cast("int")).alias("task"), F.col("qid").alias("id"), F.col("q").alias("v"), "limit", F.lit(None).cast("binary").alias("y"))
    right = leaves.join(met, "chunk").select(F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)).alias("task"), F.col("tid").alias("id"), "v", F.lit(None).cast("binary").alias("limit"), "y")

    def compare(batches):
        tasks: dict[int, tuple[list, list]] = {}
        for b in batches:
            for task, ids, v, limit, y in zip(*(b.column(c).to_pylist() for c in ("task", "id", "v", "limit", "y"))):
                tasks.setdefault(task, ([], []))[y is not None].append((ids, v, limit if y is None else y))
        for task in sorted(tasks):
            rows, packed = tasks.pop(task)
            if not rows or not packed:
                continue
            qid, q, d2 = (np.frombuffer(b"".join(c), t) for c, t in zip(zip(*rows), (np.int64, float, float)))
            q = q.reshape(len(qid), -1)
            packed = [(np.frombuffer(t, np.int64), np.frombuffer(y), np.frombuffer(v).reshape(len(t) // 8, -1)) for t, v, y in packed]
            if np.isinf(d2).all():                             # the first chunk that these meet
                d2 = _reach(q, packed, k)
            at, d2, ids, y = within(q, d2, packed, k)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (qid[at], d2, ids, y)], names=names)

    # a task for each chunk and part: few bytes stand for much work, so sizes must not decide
    return left.unionByName(right).repartitionById(max(1, ends[-1] if ends else 1), F.col("task")).mapInArrow(compare, "qid long, d2 double, tid long, y double")


def _by_pivots(train: DataFrame, test: DataFrame, n_train: int, k: int) -> DataFrame:
    """``test`` (with its vector ``__v``) and ``prob_fraud`` over all rows of ``train`` (tid, y, v)."""
    spark = train.sparkSession
    last = F.lit((1 << 63) - 1)                                # rows without an id come last
    train = write_scratch(train.select(F.coalesce(F.col("tid").cast("long"), last).alias("tid"), "y", "v", F.monotonically_increasing_id().alias("at")), "knn-train")
    cells = min(PIVOTS, math.ceil(n_train / CHUNK_ROWS))
    step = max(1, n_train // (SAMPLED * cells))
    some = train.where(F.pmod("at", F.lit(step)) == 0).select("v").toPandas()                     # SAMPLED rows per cell, and one per task
    cuts = spark.sparkContext.broadcast(kd_cuts(np.stack(some["v"].to_numpy()), cells))

    def assign(batches):
        for b in batches:
            if b.num_rows:
                cell = kd_cell(_matrix(b.column(2), b.num_rows), cuts.value)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=["tid", "y", "v", "at", "cell"])

    placed = write_scratch(train.mapInArrow(assign, "tid long, y double, v array<double>, at long, cell long"), "knn-cells")
    # a cell of very many rows (equal ones cannot be told apart) is dealt over several chunks
    crowd = 4 * max(CHUNK_ROWS, math.ceil(n_train / cells))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / crowd).alias("rings"))          # PIVOTS rows
    dealt = placed.join(F.broadcast(sizes), "cell").select((F.col("cell") * F.lit(1 << 32) + F.pmod("at", "rings")).alias("chunk"), "tid", "y", "v")
    leaf_rows = max(min(LEAF_ROWS, CHUNK_ROWS), math.ceil(2 * n_train / MAX_LEAVES))

    def split(t: pa.Table) -> pa.Table:
        v, ids, y = _matrix(t.column("v"), t.num_rows), t.column("tid").to_numpy(), t.column("y").to_numpy().astype(float)
        at = kd_leaves(v, leaf_rows)
        k = len(at)
        return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()] * k, pa.int64()),
                         **{name: pa.array([f(a).tolist() for a in at], pa.list_(pa.float64())) for name, f in (("low", lambda a: v[a].min(0)), ("high", lambda a: v[a].max(0)))},
                         **{name: pa.array([c[a].tobytes() for a in at], pa.binary()) for name, c in (("tid", ids), ("y", y), ("v", v))}})

    leaves = write_scratch(dealt.groupBy("chunk").applyInArrow(
        split, "chunk long, low array<double>, high array<double>, tid binary, y binary, v binary"), "knn-leaves")
    listed = leaves.select("chunk", "low", "high").toPandas().sort_values("chunk", kind="stable")   # about MAX_LEAVES rows
    low, high = (np.stack(listed[c].to_numpy()) for c in ("low", "high"))
    names, start = np.unique(listed["chunk"].to_numpy(), return_index=True)
    sent = spark.sparkContext.broadcast((names, start, low, high, np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)))

    tests = write_scratch(test.withColumn("__qid", F.monotonically_increasing_id()), "knn-test")

    def home(batches):
        names, _, _, _, low, high = sent.value
        for b in batches:
            for lo in range(0, b.num_rows, LOOKUP):
                part = b.slice(lo, LOOKUP)
                near = box_distances(_matrix(part.column(1), part.num_rows), low, high).argmin(1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[near]), part.column(1)], names=["qid", "chunk", "q"])

    def to_home(batches):
        packs = _Packs()
        for b in batches:
            qid, own, q = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2), b.num_rows)
            for c in np.unique(own).tolist():
                at = np.flatnonzero(own == c)
                yield from packs.add(c, qid[at], q[at], np.full(len(at), np.inf))
        yield from packs.rest()

    def to_others(nearest_ones: bool):
        """To the NEXT chunks nearest to a test row, or to all but these, that lie within its reach."""
        def run(batches):
            names, start, low, high, chunk_low, chunk_high = sent.value
            end, packs = [*start[1:].tolist(), len(low)], _Packs()
            for b in batches:
                for lo in range(0, b.num_rows, LOOKUP):
                    part = b.slice(lo, LOOKUP)
                    qid, own, d2 = (part.column(i).to_numpy() for i in (0, 1, 3))
                    v = _matrix(part.column(2), part.num_rows)
                    limit, far = _limit(v, d2), box_distances(v, chunk_low, chunk_high)
                    far[names[None, :] == own[:, None]] = np.inf
                    ranked = np.zeros(far.shape, bool)
                    some = np.argsort(far, axis=1, kind="stable")[:, :NEXT]
                    np.put_along_axis(ranked, some, True, axis=1)
                    hit = (far <= limit[:, None]) & (ranked if nearest_ones else ~ranked)
                    for c in np.flatnonzero(hit.any(0)).tolist():
                        at = np.flatnonzero(hit[:, c])
                        leaf = slice(int(start[c]), int(end[c]))
                        at = at[(box_distances(v[at], low[leaf], high[leaf]) <= limit[at, None]).any(1)]
                        if len(at):
                            yield from packs.add(int(names[c]), qid[at], v[at], d2[at])
            yield from packs.rest()
        return run

    def reach(best: DataFrame) -> DataFrame:
        """(qid, chunk, q, limit) by the rows found so far; with fewer than k, any chunk may hold the next one."""
        kth = best.groupBy("qid").agg(F.array_sort(F.collect_list("d2")).alias("d2"))          # a few times k values
        return first.join(kth, "qid", "left").select("qid", "chunk", "q", F.coalesce(F.get("d2", F.lit(k - 1)), F.lit(1e300)).alias("limit"))

    first = write_scratch(tests.select(F.col("__qid").alias("qid"), F.col("__v").alias("q")).mapInArrow(home, "qid long, chunk long, q array<double>"), "knn-home")
    best = write_scratch(_meet(write_scratch(first.mapInArrow(to_home, _Packs.schema), "knn-own"), leaves, k), "knn-first")
    more = write_scratch(reach(best).mapInArrow(to_others(True), _Packs.schema), "knn-next")
    best = best.unionByName(write_scratch(_meet(more, leaves, k), "knn-second"))
    more = write_scratch(reach(best).mapInArrow(to_others(False), _Packs.schema), "knn-rest")
    found = best.unionByName(_meet(more, leaves, k))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("d2", "tid"))
    share = (found.select("*", rank.alias("rank")).where(F.col("rank") <= k)
             .groupBy(F.col("qid").alias("__qid")).agg(F.avg("y").alias(PROB)))
    return tests.join(share, "__qid", "left")
