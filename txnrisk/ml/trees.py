"""Trees, bagged trees, forests and boosted trees, all members in one job.

Inputs are binned at quantiles of their group.  A group of up to ``SMALL`` rows goes to several tasks whole,
each of which grows some of its trees.  In larger groups, while a node holds more than ``SMALL`` rows, its
split comes from a histogram (weight and label sum by node, input and bin) that every task sums over its
rows, for all members' nodes of the level at once; rows of smaller nodes are dealt to one task per
node, which grows the rest of that tree there.  Node ids are hashes of their paths and all random
choices follow from them, so a tree does not depend on where the two ways meet.

Fitted trees are a relation, one row per node; see :data:`NODES`.  Small ensembles score from arrays that
every task holds (:class:`TreePredictor`); large ones stay in their table, and each row goes to the parts of
the trees that it reaches (:class:`TreeTable`)."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path, write_scratch
from .frame import GROUP, Y, X, bootstrap_weights, member_features, mixed

BINS = 256
#: rows of a node that one task grows to the end (up to 150 MB there)
SMALL = 1 << 21
#: a row's weight, and its weight times its label from this bit on, add up as one number
LOAD = 26
#: nodes whose histograms one job sums (about 90 kB each at 15 inputs)
SLOTS = 512
#: blocks of trees that the groups which fit a task are grown in (or four to a core), and rows times trees of a block at least
BLOCKS, BLOCK_ROWS = 32, 1 << 19
#: bytes of rows that a task packs before it hands them on
PACK = 32 << 20
#: rows that a predictor routes at a time, and rows times trees in one step
ROUTE, CELLS = 2048, 1 << 16
#: nodes and rows that a scoring task holds, unless one tree has more nodes; a tree of more than TREE_NODES goes in parts
TASK_NODES, TASK_ROWS, TREE_NODES = 1 << 22, 1 << 20, 1 << 21
#: stages between two writings of the scores that a boosting has given its rows
RESCORE = 8
#: partial histograms (tasks times nodes, about 90 kB each) that come straight to the driver
FEW_HISTOGRAMS = 512

#: rows of a part, the piece of a tree that one task holds when the trees stay a table
PART = 1 << 16
#: nodes of an ensemble that the driver collects (about 100 bytes each) and sends with a scoring function
FEW_NODES = 1 << 18
#: scores are summed in units of 2**-48, as whole numbers, so the order of the trees does not matter
UNIT = float(1 << 48)

#: ``part``: the highest node on the way down with at most PART rows; 0 above it
NODES = ("config string, grp long, member int, node long, depth int, input int, threshold double, bin int, "
         "left long, right long, n_rows long, weight double, value double, part long")
ROOT = 1


@dataclass(frozen=True)
class Forest:
    """``members`` trees over the rows of a group, grown until pure (or to ``max_depth``).

    ``max_features``: inputs a member sees; ``per_node``: inputs that a node chooses from (more are
    tried while none can split); without ``bootstrap`` every row counts once."""

    config: str
    group: int
    members: int = 10
    max_features: float | int = 1.0
    per_node: int | None = None
    bootstrap: bool = True
    random_state: int = 10
    max_depth: int | None = None

    def columns(self, member: int, n_inputs: int) -> np.ndarray:
        return member_features(n_inputs, self.max_features, member, self.random_state)

    def weights(self, h: np.ndarray, members=None) -> np.ndarray:
        """rows x members (all, or those named)."""
        members = np.arange(self.members) if members is None else np.asarray(members)
        return bootstrap_weights(h, members, self.random_state) if self.bootstrap else np.ones((len(h), len(members)), np.uint8)


@dataclass(frozen=True)
class Boosting:
    """``stages`` regression trees of ``depth`` levels on the slopes of the log loss; leaves take one
    Newton step, times ``rate``.  Its nodes carry the stage as member; stage -1 is the start."""

    config: str
    group: int
    stages: int = 100
    rate: float = 0.1
    depth: int = 3


def child(node: int, side: int) -> int:
    """Id of a child: a 63-bit hash of the path."""
    h = (2 * node + side) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return (h ^ (h >> 31)) & 0x7FFFFFFFFFFFFFFF


# ------------------------------------------------------------------ bins ---

def bin_edges(rows: DataFrame, n_inputs: int) -> dict[int, list[np.ndarray]]:
    """Per group and input, at most 255 quantiles of the values: bin b holds edge[b-1] < x <= edge[b]."""
    shares = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    found = rows.groupBy(GROUP).agg(*[F.percentile_approx(F.col(X)[i], shares, F.lit(20_000)).alias(f"e{i}") for i in range(n_inputs)],
                                    *[F.max(F.col(X)[i]).alias(f"m{i}") for i in range(n_inputs)]).collect()      # one row per group
    return {r[GROUP]: [np.unique([e for e in r[f"e{i}"] if e < r[f"m{i}"]]) for i in range(n_inputs)] for r in found}


def binned(rows: DataFrame, edges: dict[int, list[np.ndarray]]) -> DataFrame:
    """(grp, bins, y, h), written once: one byte per input."""
    def run(batches):
        for b in batches:
            group = b.column(0).to_numpy(zero_copy_only=False)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(group), -1)
            out = np.zeros(x.shape, np.uint8)
            for g in np.unique(group).tolist():
                at = np.flatnonzero(group == g)
                for i, e in enumerate(edges[g]):
                    out[at, i] = np.searchsorted(e, x[at, i], side="left")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in out], pa.binary()), b.column(2), b.column(3)],
                                             names=[GROUP, "bins", Y, "h"])
    return write_scratch(rows.select(GROUP, X, Y, "h").mapInArrow(run, f"{GROUP} long, bins binary, {Y} double, h long"), "binned")


def _arrays(batch: pa.RecordBatch):
    """(group, bins matrix, y, h) of a batch of :func:`binned`."""
    group, y, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
    raw = b"".join(batch.column(1).to_pylist())
    return group, np.frombuffer(raw, np.uint8).reshape(len(group), -1) if len(group) else np.zeros((0, 1), np.uint8), y, h


# ---------------------------------------------------------------- splits ---

def gini(n, w, v, W, V):
    """Purity of both sides (higher is better); w, v: weight and label sum of the left one."""
    with np.errstate(divide="ignore", invalid="ignore"):
        r, u = W - w, V - v
        return (v * v + (w - v) ** 2) / w + (u * u + (r - u) ** 2) / r


def spread(n, w, v, W, V):
    """How far the means of both sides lie apart, by size."""
    with np.errstate(divide="ignore", invalid="ignore"):
        r, u = W - w, V - v
        return w * r / W * (v / w - u / r) ** 2


def histogram(bins: np.ndarray, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """(3, inputs, BINS): rows, weight and value sum by input and bin."""
    out = np.empty((3, bins.shape[1], BINS))
    for i in range(bins.shape[1]):
        spot = bins[:, i].astype(np.intp)
        out[0, i] = np.bincount(spot, minlength=BINS)
        out[1, i] = np.bincount(spot, w, BINS)
        out[2, i] = np.bincount(spot, v, BINS)
    return out


def best_split(hist: np.ndarray, order: np.ndarray | None, per_node: int | None, score) -> tuple[int, int, int] | None:
    """(place of the input, bin, rows on the left) of the best split; equal ones: the first input and
    bin.  Of ``order``, the first ``per_node`` inputs are tried, and more while none splits."""
    left = hist.cumsum(2)
    total = left[:, :, -1:]
    n = left[0]
    value = score(n, left[1], left[2], total[1], total[2])
    value = np.where((n > 0) & (n < total[0]), value, -np.inf)
    if order is not None:
        some = order[:per_node]
        if not np.isfinite(value[some]).any():
            rest = order[per_node:]
            some = rest[np.isfinite(value[rest]).any(1)][:1]
        drop = np.ones(len(value), bool)
        drop[some] = False
        value[drop] = -np.inf
    at = int(value.argmax())
    if not np.isfinite(value.flat[at]):
        return None
    return at // BINS, at % BINS, int(n.flat[at])


def node_order(node: int, k: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.argsort(mixed(np.uint64(node) + mixed(np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))), kind="stable")


def grow(bins: np.ndarray, w: np.ndarray, v: np.ndarray, node: int, depth: int, max_depth: int | None, per_node: int | None,
         salt: int, score=gini):
    """Grow the subtree of ``node`` from its rows: (node, depth, input place, bin, left, right, rows) of each node."""
    stack = [(node, depth, np.arange(len(w)))]
    wv = w * v
    while stack:
        node, depth, at = stack.pop()
        wn, vn = w[at], wv[at]
        split = None
        if len(at) > 1 and (max_depth is None or depth < max_depth) and (score is spread or 0 < vn.sum() < wn.sum()):
            order = None if per_node is None else node_order(node, bins.shape[1], salt)
            split = best_split(histogram(bins[at], wn, vn), order, per_node, score)
        if split is None:
            yield node, depth, -1, -1, 0, 0, at
            continue
        i, b, _ = split
        side = bins[at, i] <= b
        left, right = child(node, 0), child(node, 1)
        yield node, depth, i, b, left, right, at
        stack += [(right, depth + 1, at[~side]), (left, depth + 1, at[side])]


def _children(nodes: np.ndarray, side: int) -> np.ndarray:
    """:func:`child` of many nodes."""
    with np.errstate(over="ignore"):
        return (mixed(np.uint64(2) * nodes.astype(np.uint64) + np.uint64(side)) & np.uint64(0x7FFFFFFFFFFFFFFF)).astype(np.int64)


def _node_splits(key, load, code, W, V):
    """Best value (-inf: none) and bin of one input for each node.  ``key``: node * BINS + bin of each row, from
    len(W) * BINS on without a node; ``load``: weight and label weight as one number (see LOAD); ``code``: the same
    as 2 * weight + label, or None for rows that stand for several."""
    size = len(W) * BINS
    if code is None or size <= 2 * len(key):
        sums = np.bincount(key, load, size)[:size]
        spot = np.flatnonzero(sums)
        sums = sums[spot]
    else:                                                      # few rows to a node
        rows = np.sort(key << 9 | code)
        rows = rows[:np.searchsorted(rows, size << 9)]
        first = np.flatnonzero(np.append(True, rows[1:] >> 9 != rows[:-1] >> 9))
        spot = rows[first] >> 9
        w = (rows & 511) >> 1
        sums = np.add.reduceat(w + (w * (rows & 1) << LOAD), first).astype(float)
    node = spot // BINS
    start = np.searchsorted(node, np.arange(len(W)))
    total = sums.cumsum()                                      # whole numbers: running sums are exact
    w, v = _loads(total - (total[start] - sums[start])[node])
    value = np.where(w < W[node], gini(None, w, v, W[node], V[node]), -np.inf)
    best = np.maximum.reduceat(value, start)
    hit = np.flatnonzero(value == best[node])
    return best, spot[hit[np.searchsorted(node[hit], np.arange(len(W)))]] % BINS


def _loads(load: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight, label weight) of summed loads."""
    v = np.floor(load * 0.5 ** LOAD)
    return load - v * 2.0 ** LOAD, v


def _picked(bins: np.ndarray, inputs: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Each row's bin at the input of its node (0 for none)."""
    at = np.append(inputs, 0).astype(np.int64).take(slot)
    at *= len(slot)
    at += np.arange(len(slot))
    return bins.ravel().take(at)


def _best_splits(bins, slot, load, code, W, V, order, per_node):
    """(input or -1, bin) of each node's best split, as :func:`best_split` chooses it.  ``slot``: the node (0, 1,
    ...) of each row, len(W) for none; ``bins``: inputs x rows."""
    k, first = len(W), slot * BINS

    def tried(inputs):
        """Value and bin at one input of each node (``inputs``), or at one input of all (a number)."""
        return _node_splits(first + (bins[inputs] if np.ndim(inputs) == 0 else _picked(bins, inputs, slot)), load, code, W, V)

    # ascending, so that the first of equal values is that of the first input
    tries = range(len(bins)) if order is None else np.sort(order[:, :per_node], 1).T
    value, cut = (np.stack(c) for c in zip(*map(tried, tries)))
    best = value.argmax(0)
    every = np.arange(k)
    place, value, cut = (best if order is None else tries[best, every]), value[best, every], cut[best, every]
    for nth in range(per_node, len(bins)) if order is not None else ():
        none = np.flatnonzero(~np.isfinite(value))               # no input splits so far: the next one
        if not len(none):
            break
        name = np.full(k + 1, len(none))
        name[none] = np.arange(len(none))
        at = np.flatnonzero(name[slot] < len(none))
        more = _best_splits(bins[:, at], name[slot[at]], load[at], None if code is None else code[at], W[none], V[none], order[none, nth:nth + 1], len(bins))
        place[none], cut[none] = more
        value[none[more[0] >= 0]] = 0
    found = np.isfinite(value)
    return np.where(found, place, -1), np.where(found, cut, -1)


def grow_levels(bins: np.ndarray, w: np.ndarray, y: np.ndarray, node: int, depth: int, max_depth: int | None, per_node: int | None,
                salt: int, part: int = 0, part_rows: int = PART):
    """The nodes that :func:`grow` finds by :func:`gini`, all of a level together, as arrays: (node, depth,
    input place, bin, left, right, rows, weight, weight of label 1, part).  ``part``: that of the parent;
    ``w``: whole numbers from 1 to 255, ``y``: 0 or 1."""
    if w.sum() >= 2 ** LOAD:
        raise ValueError("too many rows for one task")
    ids, parts = np.array([node], np.int64), np.array([part], np.int64)
    load, code = w + w * y * 2.0 ** LOAD, (2 * w + y).astype(np.int64)
    bins, slot, rows = np.ascontiguousarray(bins.T), np.zeros(len(w), np.int64), None
    if len(bins) == 1:                                         # rows of a bin stay together: one stands for all
        rows, load = np.bincount(bins[0], minlength=BINS).astype(float), np.bincount(bins[0], load, BINS)
        some = np.flatnonzero(rows)
        bins, slot, rows, load, code = some.astype(np.uint8)[None], slot[:len(some)], rows[some], load[some], None
    while len(ids):
        k = len(ids)
        n = np.bincount(slot, rows, k)[:k].astype(np.int64)
        W, V = _loads(np.bincount(slot, load, k)[:k])
        parts = np.where(parts != 0, parts, np.where(n <= part_rows, ids, 0))
        place, cut = np.full(k, -1), np.full(k, -1)
        mixed_up = (n > 1) & (V > 0) & (V < W) & (max_depth is None or depth < max_depth)
        some = int(mixed_up.sum())
        if some:
            slot = np.append(np.where(mixed_up, mixed_up.cumsum() - 1, some), some).take(slot) if some < k else slot
            if np.count_nonzero(slot < some) < 0.9 * len(slot):                      # rows of finished nodes go, many at a time
                live = np.flatnonzero(slot < some)
                bins, slot, load = bins.take(live, 1), slot.take(live), load.take(live)
                rows, code = (None if c is None else c.take(live) for c in (rows, code))
            order = None if per_node is None else node_orders(ids[mixed_up], len(bins), salt)
            place[mixed_up], cut[mixed_up] = _best_splits(bins, slot, load, code, W[mixed_up], V[mixed_up], order, per_node)
        split = place >= 0
        sides = [np.where(split, _children(ids, side), 0) for side in (0, 1)]
        yield ids, np.full(k, depth), place, cut, *sides, n, W, V, parts
        if not split.any():
            return
        taken, ends = split[mixed_up], int(split.sum())
        right = _picked(bins, np.where(taken, place[mixed_up], 0), slot) > np.append(np.where(taken, cut[mixed_up], BINS - 1), BINS - 1).astype(np.uint8).take(slot)
        slot = np.append(np.where(taken, 2 * taken.cumsum() - 2, 2 * ends), 2 * ends).take(slot)
        slot += right
        ids, parts, depth = np.stack([c[split] for c in sides], 1).ravel(), np.repeat(parts[split], 2), depth + 1


def node_orders(nodes: np.ndarray, k: int, salt: int) -> np.ndarray:
    """:func:`node_order` of many nodes, one row each."""
    with np.errstate(over="ignore"):
        return np.argsort(mixed(nodes.astype(np.uint64)[:, None] + mixed(np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))),
                          axis=1, kind="stable")


def _salt(spec: Forest, member: int) -> int:
    return int(mixed(np.array([spec.random_state * 1_000_003 + member], np.uint64))[0])


# ------------------------------------------------------- distributed levels ---

class Top:
    """The nodes of one tree that were split over all tasks."""

    def __init__(self):
        self.split: dict[int, tuple[int, int]] = {}           # node -> (input, bin)

    def arrays(self):
        ids = np.array(sorted(self.split), np.int64)
        inputs = np.array([self.split[i][0] for i in ids.tolist()], np.int64)
        bins = np.array([self.split[i][1] for i in ids.tolist()], np.int64)
        sides = np.array([[child(i, 0), child(i, 1)] for i in ids.tolist()], np.int64).reshape(-1, 2)
        return ids, inputs, bins, sides

    @staticmethod
    def route(arrays, bins: np.ndarray) -> np.ndarray:
        """The node where each row leaves the split ones."""
        ids, inputs, cuts, sides = arrays
        place, node = {k: j for j, k in enumerate(ids.tolist())}, np.full(len(bins), ROOT, np.int64)
        stack = [(ROOT, np.arange(len(bins)))]
        while stack:
            here, at = stack.pop()
            j = place.get(here)
            if j is None:
                node[at] = here
            elif len(at):
                right = bins[at, inputs[j]] > cuts[j]
                stack += [(int(sides[j, 0]), at[~right]), (int(sides[j, 1]), at[right])]
        return node


def _sum_histograms(rows: DataFrame, emit, pick, shape: int) -> list:
    """Sum histograms over all tasks.  ``emit(group, bins, y, h)`` yields (slot, histogram) of a batch;
    ``pick(slot, histogram)`` makes the result row of a slot (a list of doubles)."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for slot, hist in emit(*_arrays(b)):
                total[slot] = total[slot] + hist if slot in total else hist
        for slot, hist in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([hist.ravel()], pa.list_(pa.float64()))], names=["slot", "sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = table.column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1).sum(0)
        slot = table.column("slot")[0].as_py()
        return pa.table({"slot": pa.array([slot], pa.int64()), "sums": pa.array([pick(slot, sums.reshape(3, -1, shape))], pa.list_(pa.float64()))})

    schema = "slot long, sums array<double>"
    return rows.mapInArrow(run, schema).groupBy("slot").applyInArrow(add, schema).collect()        # one short row per slot


def _grow_top(rows: DataFrame, specs: list[Forest], n_rows: dict[int, int], n_inputs: int, small: int):
    """Split all nodes above ``small`` rows, level by level: (tops by (spec, member), finished nodes)."""
    tops: dict[tuple[int, int], Top] = {}
    done: list[tuple] = []
    frontier = [(i, m, ROOT, 0) for i, s in enumerate(specs) if n_rows[s.group] > small for m in range(s.members)]
    for i, m, _, _ in frontier:
        tops[i, m] = Top()
    while frontier:
        now, frontier = frontier[:SLOTS], frontier[SLOTS:]
        slots = {(i, m, node): k for k, (i, m, node, _) in enumerate(now)}
        members: dict[int, list[int]] = {}
        for i, m, _, _ in now:
            if m not in members.setdefault(i, []):
                members[i].append(m)
        arrays = {(i, m): tops[i, m].arrays() for i, ms in members.items() for m in ms}

        def emit(group, bins, y, h):
            for i, ms in members.items():
                at = np.flatnonzero(group == specs[i].group)
                if not len(at):
                    continue
                weight = specs[i].weights(h[at], ms)
                for k, m in enumerate(ms):
                    node = Top.route(arrays[i, m], bins[at])
                    cols = specs[i].columns(m, n_inputs)
                    for node_id in np.unique(node).tolist():
                        slot = slots.get((i, m, node_id))
                        some = np.flatnonzero((node == node_id) & (weight[:, k] > 0)) if slot is not None else ()
                        if len(some):
                            w = weight[some, k].astype(float)
                            yield slot, histogram(bins[at[some]][:, cols], w, w * y[at[some]])

        def pick(slot, hist):
            i, m, node, depth = now[slot]
            n, w, v = hist[:, 0].sum(1)
            pure, deep = not 0 < v < w, specs[i].max_depth is not None and depth >= specs[i].max_depth
            k = hist.shape[1]
            order = None if specs[i].per_node is None else node_order(node, k, _salt(specs[i], m))
            split = None if pure or deep else best_split(hist, order, specs[i].per_node, gini)
            return [n, w, v, *((-1, -1, 0) if split is None else (specs[i].columns(m, n_inputs)[split[0]], split[1], split[2]))]

        for r in _sum_histograms(rows, emit, pick, BINS):
            i, m, node, depth = now[r["slot"]]
            n, w, v, col, cut, left_n = r["sums"]
            done.append((i, m, node, depth, int(col), int(cut), int(n), w, v / w))
            if col >= 0:
                tops[i, m].split[node] = int(col), int(cut)
                frontier += [(i, m, child(node, side), depth + 1) for side, size in ((0, left_n), (1, n - left_n)) if size > small]
    return tops, done


def fit_forests(rows: DataFrame, specs: list[Forest], edges: dict[int, list[np.ndarray]], n_rows: dict[int, int], small: int = SMALL,
                part_rows: int = PART) -> DataFrame:
    """The node table (:data:`NODES`) of all ``specs`` over :func:`binned` rows, written once.  ``value``
    of a node is its share of label 1."""
    specs = [s for s in specs if n_rows.get(s.group)]
    near, wide = ([s for s in specs if (n_rows[s.group] <= small) == way] for way in (True, False))
    parts = [fit(rows, some, edges, n_rows, small, part_rows) for fit, some in ((_fit_near, near), (_fit_wide, wide)) if some]
    out = parts[0] if parts else rows.sparkSession.createDataFrame([], NODES)
    return write_scratch(out.unionByName(parts[1]) if len(parts) > 1 else out, "nodes")


def _grown(s: Forest, m: int, levels, cols: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
    """Node rows of :func:`grow_levels`; ``cuts``: inputs x bins."""
    ids, depths, place, cut, left, right, n, total, positive, part = (np.concatenate(c) for c in zip(*levels))
    col, k = np.where(place >= 0, cols[place], -1), len(ids)
    data = [pa.array([s.config] * k), pa.array(np.full(k, s.group)), pa.array(np.full(k, m)), pa.array(ids), pa.array(depths), pa.array(col),
            pa.array(cuts[col, cut], mask=place < 0), pa.array(cut), pa.array(left), pa.array(right), pa.array(n), pa.array(total), pa.array(positive / total), pa.array(part)]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(data, _NODE_TYPES)], schema=_NODE_SCHEMA)


def _cut_table(edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.append(e, np.zeros(BINS - len(e))) for e in edges])


def _fit_near(rows: DataFrame, specs: list[Forest], edges, n_rows: dict[int, int], small: int, part_rows: int) -> DataFrame:
    """Trees of groups that fit a task.  All rows of a group go to each of its blocks, a number of trees to a task."""
    n_inputs, tasks = len(next(iter(edges.values()))), rows.sparkSession.sparkContext.defaultParallelism
    groups = sorted({s.group for s in specs})
    blocks: list[tuple[int, list[tuple[int, int]]]] = []       # (group, its trees (spec, member))
    first: dict[int, tuple[int, int]] = {}
    for g in groups:
        # trees of one member follow each other: they share their weights where the random states agree
        trees = sorted((m, i) for i, s in enumerate(specs) if s.group == g for m in range(s.members))
        k = min(len(trees), max(1, n_rows[g] * len(trees) // BLOCK_ROWS), max(1, max(BLOCKS, 4 * tasks) // len(groups)))
        first[g] = len(blocks), k
        blocks += [(g, [(i, m) for m, i in trees[j * len(trees) // k:(j + 1) * len(trees) // k]]) for j in range(k)]

    def chunks(batches):
        """Rows as bytes, a chunk of a group to a row."""
        for b in batches:
            group = b.column(0).to_numpy(zero_copy_only=False)
            for g in groups:
                at = np.flatnonzero(group == g)
                if len(at):
                    _, bins, y, h = _arrays(b.take(pa.array(at)))
                    yield pa.RecordBatch.from_arrays([pa.array([g], pa.int64()), *(pa.array([c.tobytes()], pa.binary()) for c in (bins, y.astype(np.uint8), h))],
                                                     names=[GROUP, "bins", Y, "h"])

    def finish(batches):
        found: dict[int, list] = {}
        for b in batches:
            for block, *c in zip(*(b.column(n).to_pylist() for n in ("block", "bins", Y, "h"))):
                found.setdefault(block, []).append(c)
        for block in sorted(found):
            g, trees = blocks[block]
            bins, y, h = (np.frombuffer(b"".join(c), t) for c, t in zip(zip(*found.pop(block)), (np.uint8, np.uint8, np.int64)))
            bins, y, cuts, drawn = np.ascontiguousarray(bins.reshape(len(y), -1).T), y.astype(float), _cut_table(edges[g]), None
            for i, m in trees:
                s = specs[i]
                if drawn is None or drawn[0] != (m, s.random_state, s.bootstrap):
                    w = s.weights(h, [m])[:, 0]
                    at = np.flatnonzero(w)
                    drawn = (m, s.random_state, s.bootstrap), at, w[at].astype(float), y[at]
                _, at, w, label = drawn
                cols = s.columns(m, n_inputs)
                if len(at):
                    mine = np.stack([bins[c].take(at) for c in cols])
                    yield _grown(s, m, grow_levels(mine.T, w, label, ROOT, 0, s.max_depth, s.per_node, _salt(s, m), 0, part_rows), cols, cuts)

    packed = rows.where(F.col(GROUP).isin(groups)).mapInArrow(chunks, f"{GROUP} long, bins binary, {Y} binary, h binary")
    spans = [F.when(F.col(GROUP) == g, F.sequence(F.lit(lo), F.lit(lo + k - 1))) for g, (lo, k) in first.items()]
    dealt = packed.withColumn("block", F.explode(F.coalesce(*spans)))
    return dealt.repartitionById(len(blocks), F.col("block")).mapInArrow(finish, NODES)


def _fit_wide(rows: DataFrame, specs: list[Forest], edges, n_rows: dict[int, int], small: int, part_rows: int) -> DataFrame:
    """Trees of larger groups: :func:`_grow_top`, then a task per node."""
    spark, n_inputs = rows.sparkSession, len(next(iter(edges.values())))
    tops, done = _grow_top(rows, specs, n_rows, n_inputs, small)
    arrays = {key: top.arrays() for key, top in tops.items()}
    leaves = {(i, m, node) for i, m, node, _, col, *_ in done if col < 0}

    def deal(batches):
        """Each row, packed by member and the node it is in, once per member with a weight."""
        packs: dict[tuple[int, int, int], list] = {}
        size = 0

        def flush():
            out = [(i, m, node, *(b"".join(x) for x in zip(*parts))) for (i, m, node), parts in packs.items()]
            packs.clear()
            types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["spec", "member", "node", "bins", "w", "y"])

        for b in batches:
            group, bins, y, h = _arrays(b)
            for i, s in enumerate(specs):
                at = np.flatnonzero(group == s.group)
                if not len(at):
                    continue
                weight, label, mine = s.weights(h[at]), y[at].astype(np.uint8), bins[at]
                for m in range(s.members):
                    some = np.flatnonzero(weight[:, m])
                    node = Top.route(arrays[i, m], mine[some]) if (i, m) in arrays else np.full(len(some), ROOT, np.int64)
                    cols = s.columns(m, n_inputs)
                    for node_id in np.unique(node).tolist():
                        if (i, m, node_id) in leaves:
                            continue
                        pick = some[node == node_id]
                        packs.setdefault((i, m, node_id), []).append(
                            (np.ascontiguousarray(mine[pick][:, cols]).tobytes(), weight[pick, m].tobytes(), label[pick].tobytes()))
                        size += len(pick) * (len(cols) + 2)
                if size > PACK:
                    size = 0
                    yield flush()
        if packs:
            yield flush()

    parts: dict[tuple[int, int, int], int] = {}
    below: dict[tuple[int, int, int], tuple[int, int]] = {}   # depth and parent's part of the nodes under those split here
    for i, m, node, depth, col, _, n, *_ in done:              # parents first
        parts[i, m, node] = below.get((i, m, node), (0, 0))[1] or (node if n <= part_rows else 0)
        if col >= 0:
            below.update({(i, m, child(node, side)): (depth + 1, parts[i, m, node]) for side in (0, 1)})

    def finish(table: pa.Table) -> pa.Table:
        i, m, node = (table.column(c)[0].as_py() for c in ("spec", "member", "node"))
        s = specs[i]
        cols = s.columns(m, n_inputs)
        join = lambda c: np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8)
        w, y = join("w").astype(float), join("y").astype(float)
        bins = join("bins").reshape(len(w), len(cols))
        depth, part = below.get((i, m, node), (0, 0))
        levels = grow_levels(bins, w, y, node, depth, s.max_depth, s.per_node, _salt(s, m), part, part_rows)
        return pa.Table.from_batches([_grown(s, m, levels, cols, _cut_table(edges[s.group]))])

    local = (rows.mapInArrow(deal, "spec int, member int, node long, bins binary, w binary, y binary")
             .groupBy("spec", "member", "node").applyInArrow(finish, NODES))
    if done:
        local = local.unionByName(spark.createDataFrame(
            [(specs[i].config, specs[i].group, m, node, depth, col, float(edges[specs[i].group][col][cut]) if col >= 0 else None, cut,
              child(node, 0) if col >= 0 else 0, child(node, 1) if col >= 0 else 0, n, w, share, parts[i, m, node]) for i, m, node, depth, col, cut, n, w, share in done], NODES))
    return local


_NODE_NAMES = [c.split()[0] for c in NODES.split(", ")]
_NODE_TYPES = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[c.split()[1]] for c in NODES.split(", ")]
_NODE_SCHEMA = pa.schema(list(zip(_NODE_NAMES, _NODE_TYPES)))


# -------------------------------------------------------------- boosting ---

def _stage_rows(s: Boosting, stage: int, tree: list, edges) -> list[tuple]:
    """Node rows of one stage; ``tree``: (node, depth, input, bin, left, right, rows, weight, value)."""
    return [(s.config, s.group, stage, n, d, col, float(edges[s.group][col][cut]) if col >= 0 else None, cut, a, b, rows, w, value, 0)
            for n, d, col, cut, a, b, rows, w, value in tree]


def _start(positive: float, rows: float) -> float:
    share = min(max(positive / rows, 1e-12), 1 - 1e-12)
    return math.log(share / (1 - share))


def _leaf(slope: float, curve: float) -> float:
    return slope / curve if abs(curve) > 1e-150 else 0.0


def boost(bins: np.ndarray, y: np.ndarray, s: Boosting):
    """Yield the (stage, tree) pairs of a group that fits a task."""
    start = _start(float(y.sum()), len(y))
    yield -1, [(ROOT, 0, -1, -1, 0, 0, len(y), float(len(y)), start)]
    f, bins = np.full(len(y), start), np.ascontiguousarray(bins.T)
    whole = np.stack([np.bincount(c, minlength=BINS) for c in bins]).astype(float)
    for stage in range(s.stages):
        p = 1 / (1 + np.exp(-f))
        slope, curve, tree = y - p, p * (1 - p), []
        frontier, slot = [ROOT], np.zeros(len(y), np.int64)   # slot: the place in the frontier, len(frontier) for none
        for depth in range(s.depth + 1):
            ends, k = [], len(frontier)
            if not depth:
                n, v = whole[:, None], np.stack([np.bincount(c, slope, BINS) for c in bins])[:, None]
            elif depth < s.depth:
                first, n, v = slot * BINS, np.empty((len(bins), k, BINS)), np.empty((len(bins), k, BINS))
                for i, c in enumerate(bins):
                    key = first + c
                    n[i] = np.bincount(key, minlength=k * BINS)[:k * BINS].reshape(k, BINS)
                    v[i] = np.bincount(key, slope, k * BINS)[:k * BINS].reshape(k, BINS)
            place, cut = np.zeros(k, np.int64), np.full(k, BINS)
            for j, node in enumerate(frontier):
                split = best_split(np.stack([n[:, j], n[:, j], v[:, j]]), None, None, spread) if depth < s.depth and n[0, j].sum() > 1 else None
                if split is None:
                    at = np.flatnonzero(slot == j)
                    value = _leaf(float(slope[at].sum()), float(curve[at].sum()))
                    f[at] += s.rate * value
                    tree.append((node, depth, -1, -1, 0, 0, len(at), float(len(at)), value))
                    continue
                place[j], cut[j], _ = split
                ends += [child(node, 0), child(node, 1)]
                size = int(n[0, j].sum())
                tree.append((node, depth, int(place[j]), int(cut[j]), *ends[-2:], size, float(size), 0.0))
            if not ends:
                break
            right = _picked(bins, place, slot) > np.append(cut, BINS).take(slot)
            taken = cut < BINS
            slot = np.append(np.where(taken, 2 * taken.cumsum() - 2, len(ends)), len(ends)).take(slot)
            slot += right
            frontier = ends
        yield stage, tree


class _Tree:
    """The tree that one boosting grows in its present stage."""

    def __init__(self):
        self.top, self.rows, self.frontier = Top(), [], [(ROOT, 0)]


def _pack_wide(batches):
    """Rows (spec, bins, y, f) as bytes, those of one boosting in a batch as one row; bins by input."""
    for b in batches:
        spec, y, f = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
        bins = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(len(spec), -1) if len(spec) else np.zeros((0, 1), np.uint8)
        for i in np.unique(spec).tolist():
            at = np.flatnonzero(spec == i)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in (np.ascontiguousarray(bins[at].T), y[at], f[at]))],
                                             names=["spec", "bins", Y, "f"])


def _wide_rows(batch: pa.RecordBatch, specs: dict[int, Boosting], past: dict[int, list]):
    """Per row of :func:`_pack_wide` of ``specs``: its place, spec, bins (rows x inputs), labels and scores so far."""
    for k, (i, bins, y, f) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
        if i in specs:
            y, score = np.frombuffer(y), np.frombuffer(f)
            bins = np.frombuffer(bins, np.uint8).reshape(-1, len(y)).T
            for arrays, ids, values in past[i]:
                score = score + specs[i].rate * values[np.searchsorted(ids, Top.route(arrays, bins))]
            yield k, i, bins, y, score


def _level(rows: DataFrame, tasks: int, specs: dict[int, Boosting], past, trees: dict[int, _Tree]) -> dict[tuple[int, int], np.ndarray]:
    """Per (spec, node) of all frontiers: (3, inputs, BINS), rows, slope and curvature sum by input and bin."""
    slots = [(i, node) for i, t in trees.items() for node, _ in t.frontier]
    now = {i: {node: k for k, (j, node) in enumerate(slots) if i == j} for i in trees}
    arrays = {i: t.top.arrays() for i, t in trees.items()}

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for _, i, bins, y, f in _wide_rows(b, {i: specs[i] for i in trees}, past):
                p = 1 / (1 + np.exp(-f))
                slope, curve, node, k = y - p, p * (1 - p), Top.route(arrays[i], bins), len(now[i])
                if not k:
                    continue
                ids = np.array(sorted(now[i]), np.int64)
                place = np.minimum(np.searchsorted(ids, node), k - 1)
                first = np.where(ids[place] == node, place, k) * BINS        # rows of no frontier node come last
                hist = np.empty((k, 3, bins.shape[1], BINS))
                for c in range(bins.shape[1]):
                    spot = first + bins[:, c]
                    for j, weight in enumerate((None, slope, curve)):
                        hist[:, j, c] = np.bincount(spot, weight, (k + 1) * BINS)[:k * BINS].reshape(k, BINS)
                for j, node_id in enumerate(ids.tolist()):
                    slot = now[i][node_id]
                    if hist[j, 0, 0].any():
                        total[slot] = total[slot] + hist[j] if slot in total else hist[j]
        for slot, hist in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([hist.ravel()], pa.list_(pa.float64()))], names=["slot", "sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = table.column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1).sum(0)
        return pa.table({"slot": table.column("slot")[:1], "sums": pa.array([sums], pa.list_(pa.float64()))})

    schema = "slot long, sums array<double>"
    parts = rows.mapInArrow(run, schema)
    few = tasks * len(slots) <= FEW_HISTOGRAMS
    found: dict[tuple[int, int], np.ndarray] = {}
    for b in (parts if few else parts.groupBy("slot").applyInArrow(add, schema)).toArrow().to_batches():   # a histogram per slot, or FEW_HISTOGRAMS
        sums = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        for k, hist in zip(b.column(0).to_pylist(), sums):
            hist = hist.reshape(3, -1, BINS)
            found[slots[k]] = found[slots[k]] + hist if slots[k] in found else hist
    return found


def _boost_wide(rows: DataFrame, specs: dict[int, Boosting], edges) -> list[tuple]:
    """The same trees for groups of any size.  Each level of a stage, of all boostings at once, is one
    histogram job; the sums of the last leaves come from their parents' histograms.  Rows keep their
    scores in a written table that is brought up to date every ``RESCORE`` stages, so a pass costs the
    same in late stages as in early ones."""
    spark = rows.sparkSession
    tagged = rows.withColumn("spec", F.explode(_spec_tags(specs))).select("spec", "bins", Y)
    counted = {r["spec"]: (r["n"], r["p"]) for r in tagged.groupBy("spec").agg(F.count(F.lit(1)).alias("n"), F.sum(Y).alias("p")).collect()}
    start = {i: _start(p, n) for i, (n, p) in counted.items()}
    specs = {i: s for i, s in specs.items() if i in start}
    out = [r for i, s in specs.items() for r in _stage_rows(s, -1, [(ROOT, 0, -1, -1, 0, 0, counted[i][0], float(counted[i][0]), start[i])], edges)]
    scored = tagged.withColumn("f", F.coalesce(*[F.when(F.col("spec") == i, F.lit(float(f))) for i, f in start.items()]))
    state = write_scratch(scored.select("spec", "bins", Y, "f").mapInArrow(_pack_wide, f"spec int, bins binary, {Y} binary, f binary"), "boost-rows")
    past: dict[int, list] = {i: [] for i in specs}            # (arrays, leaf ids, leaf values) of the stages that f does not hold

    def advance(known: dict[int, list]):
        def run(batches):
            for b in batches:
                f = b.column(3).to_pylist()
                for at, _, _, _, score in _wide_rows(b, specs, known):
                    f[at] = score.tobytes()
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(f, pa.binary())], names=["spec", "bins", Y, "f"])
        return run

    tasks = state.rdd.getNumPartitions()
    tables = [scratch_path(spark, f"boost-{uuid.uuid4().hex}") for _ in range(2)]              # written in turns
    for stage in range(max(s.stages for s in specs.values()) if specs else 0):
        trees = {i: _Tree() for i, s in specs.items() if stage < s.stages}
        if stage and stage % RESCORE == 0:
            table = tables[stage // RESCORE % 2]
            state.mapInArrow(advance(past), state.schema).write.mode("overwrite").parquet(table)
            state, past = spark.read.schema(state.schema).parquet(table), {i: [] for i in specs}
            tasks = state.rdd.getNumPartitions()
        while any(t.frontier for t in trees.values()):
            found = _level(state, tasks, specs, past, trees)
            for i, t in trees.items():
                s, later = specs[i], []
                for node, depth in t.frontier:
                    n, slope, curve = hist = found[i, node]
                    size = n[0].sum()
                    split = best_split(np.stack([n, n, slope]), None, None, spread) if size > 1 and depth < s.depth else None
                    if split is None:
                        t.rows.append((node, depth, -1, -1, 0, 0, int(size), size, _leaf(slope[0].sum(), curve[0].sum())))
                        continue
                    col, cut, _ = split
                    ends = child(node, 0), child(node, 1)
                    t.rows.append((node, depth, col, cut, *ends, int(size), size, 0.0))
                    t.top.split[node] = col, cut
                    if depth + 1 < s.depth:
                        later += [(c, depth + 1) for c in ends]
                        continue
                    for c, side in zip(ends, (hist[:, col, :cut + 1], hist[:, col, cut + 1:])):
                        rest, v, w = side.sum(1)
                        t.rows.append((c, depth + 1, -1, -1, 0, 0, int(rest), rest, _leaf(v, w)))
                t.frontier = later
        for i, t in trees.items():
            leaves = sorted((r[0], r[8]) for r in t.rows if r[2] < 0)
            past[i].append((t.top.arrays(), np.array([k for k, _ in leaves]), np.array([v for _, v in leaves])))
            out += _stage_rows(specs[i], stage, [tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in t.rows], edges)
    return out


def _spec_tags(specs: dict[int, Boosting]):
    """The numbers of the boostings that a row takes part in, as an array column."""
    return F.filter(F.array(*[F.when(F.col(GROUP) == s.group, F.lit(i)) for i, s in specs.items()]), lambda t: t.isNotNull())


def fit_boosting(rows: DataFrame, specs: list[Boosting], edges: dict[int, list[np.ndarray]], n_rows: dict[int, int], small: int = SMALL) -> DataFrame:
    """The node table of all ``specs`` over :func:`binned` rows, written once.  Groups of up to ``small``
    rows are boosted in one task each, larger ones by histogram jobs."""
    spark = rows.sparkSession
    near = {i: s for i, s in enumerate(specs) if 0 < n_rows.get(s.group, 0) <= small}
    wide = {i: s for i, s in enumerate(specs) if n_rows.get(s.group, 0) > small}
    out = spark.createDataFrame(_boost_wide(rows, wide, edges) if wide else [], NODES)
    if near:
        def finish(table: pa.Table) -> pa.Table:
            s = specs[table.column("spec")[0].as_py()]
            bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(table.num_rows, -1)
            order = np.argsort(table.column("h").to_numpy(), kind="stable")          # sums in the order of the rows' hashes
            nodes = [r for stage, tree in boost(bins[order], table.column(Y).to_numpy()[order], s) for r in _stage_rows(s, stage, tree, edges)]
            return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), _NODE_TYPES)], names=_NODE_NAMES)

        out = out.unionByName(rows.withColumn("spec", F.explode(_spec_tags(near))).groupBy("spec").applyInArrow(finish, NODES))
    return write_scratch(out, "nodes")


# ------------------------------------------------------------ prediction ---

class TreePredictor:
    """Trees as arrays over all nodes; rows go down all trees level by level."""

    kind = "trees"

    def __init__(self, nodes: pa.Table, rate: float | None = None):
        self.nodes, self.rate = nodes.select([c for c in _NODE_NAMES[2:] if c in nodes.column_names]), rate
        t = self.nodes.to_pandas().sort_values(["member", "node"], ignore_index=True)
        self.start = float(t.loc[t["member"] < 0, "value"].sum())
        t = t[t["member"] >= 0].reset_index(drop=True)
        ids, member = t["node"].to_numpy(), t["member"].to_numpy()
        first = np.flatnonzero(np.append(True, member[1:] != member[:-1])) if len(t) else np.zeros(0, np.int64)
        self.ids, self.members = ids, member
        self.roots, self.sides = [], np.zeros((len(t), 2), np.int64)
        for lo, hi in zip(first, [*first[1:], len(t)]):
            self.roots.append(lo + int(np.searchsorted(ids[lo:hi], ROOT)))
            for k, c in enumerate(("left", "right")):
                self.sides[lo:hi, k] = lo + np.searchsorted(ids[lo:hi], t[c].to_numpy()[lo:hi])
        self.roots = np.array(self.roots, np.int64)
        self.input, self.threshold, self.value = t["input"].to_numpy(), t["threshold"].to_numpy(dtype=float), t["value"].to_numpy(dtype=float)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """rows x trees: the place among the nodes of the leaf that each row reaches."""
        parts = [self._leaves(x[lo:lo + max(1, CELLS // max(len(self.roots), 1))]) for lo in range(0, len(x), max(1, CELLS // max(len(self.roots), 1)))]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.roots)), np.int64)

    def _leaves(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, len(x))
        first = np.repeat(np.arange(len(x)) * x.shape[1], len(self.roots))
        x, sides, live = np.ascontiguousarray(x).ravel(), self.sides.ravel(), np.flatnonzero(self.input.take(at) >= 0)
        node, first = at.take(live), first.take(live)
        while len(live):
            node = sides.take(2 * node + (x.take(first + self.input.take(node)) > self.threshold.take(node)))
            on = self.input.take(node) >= 0
            if not on.all():
                done, on = np.flatnonzero(~on), np.flatnonzero(on)
                at[live.take(done)] = node.take(done)
                live, node, first = live.take(on), node.take(on), first.take(on)
        return at.reshape(-1, len(self.roots))

    def sums(self, x: np.ndarray) -> np.ndarray:
        """The leaf values of all trees added up."""
        parts = [self.value[self.leaves(x[lo:lo + ROUTE])].sum(1) for lo in range(0, len(x), ROUTE)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def table(self) -> pa.Table:
        return self.nodes

    def state(self) -> dict:
        return {"rate": self.rate}

    @classmethod
    def of(cls, table: pa.Table, state: dict) -> "TreePredictor":
        return cls(table, state["rate"])


class TreeTable:
    """Trees of a :class:`Forest` that stay a table of nodes.  A row goes down the nodes above the parts
    where it lies (they hold more than PART rows each, so there are few), and then to each part it reaches:
    rows and nodes travel once per tree, whatever their number.  Inputs count by their place among the
    thresholds of the trees."""

    kind, rate = "trees", None

    def __init__(self, nodes: DataFrame):
        self.nodes = nodes.select(_NODE_NAMES[2:])
        self.cuts: dict[int, np.ndarray] = {}                  # input -> threshold by bin
        for r in self.nodes.where("input >= 0").groupBy("input").agg(F.collect_set(F.struct("bin", "threshold")).alias("cuts")).collect():   # BINS per input at most
            cuts = dict(map(tuple, r["cuts"]))
            used = sorted(cuts)
            # a bin that is no threshold takes the next one that is: no row is told apart by it
            self.cuts[r["input"]] = np.array([cuts[used[k]] for k in np.searchsorted(used, np.arange(used[-1] + 1))])
        self.members = sorted(r["member"] for r in self.nodes.where(F.col("node") == ROOT).select("member").distinct().collect())   # one row per tree
        self.tops = {m: Top() for m in self.members}
        self.top_leaves: dict[tuple[int, int], float] = {}
        for r in self.nodes.where("part = 0").select("member", "node", "input", "bin", "value").collect():   # nodes of more than PART rows
            if r["input"] >= 0:
                self.tops[r["member"]].split[r["node"]] = r["input"], r["bin"]
            else:
                self.top_leaves[r["member"], r["node"]] = r["value"]

    def table(self) -> DataFrame:
        return self.nodes

    def state(self) -> dict:
        return {"rate": self.rate}

    def _routed(self, rows: DataFrame, load, width: int, last, schema: str) -> DataFrame:
        """What ``rows`` (x first) give in the leaves they reach.  ``load(batch)`` gives a function of a member's
        place -> (rows kept, their ``width`` bytes each); ``last(member, leaf ids, leaf values, place of each row's
        leaf, bytes)`` gives the result columns (``schema``) of a part, or of a leaf above the parts."""
        members, cuts, leaves = self.members, self.cuts, self.top_leaves
        arrays = [self.tops[m].arrays() for m in members]
        names = [c.split()[0] for c in schema.split(", ")]

        def reached(batches):
            """(member, part or leaf above the parts, bins, bytes) of the rows there."""
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                bins = np.zeros(x.shape, np.uint8)
                for i, c in cuts.items():
                    bins[:, i] = np.searchsorted(c, x[:, i], side="left")
                take = load(batch)
                for k, m in enumerate(members):
                    kept, data = take(k)
                    mine = bins[kept]
                    node = Top.route(arrays[k], mine)
                    for part in np.unique(node).tolist():
                        at = np.flatnonzero(node == part)
                        yield m, part, mine[at], data[at]

        def deal(batches):
            packs: dict[tuple[int, int], list] = {}
            size = 0

            def flush():
                out = [(*key, *(b"".join(c) for c in zip(*parts))) for key, parts in packs.items()]
                packs.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                                  names=["member", "part", "bins", "load"])

            for m, part, bins, data in reached(batches):
                if (m, part) in leaves:
                    continue
                packs.setdefault((m, part), []).append((bins.tobytes(), data.tobytes()))
                size += bins.nbytes + data.nbytes
                if size > PACK:
                    size = 0
                    yield flush()
            if packs:
                yield flush()

        def above(batches):
            """Rows that end above the parts need no other task."""
            for m, part, _, data in reached(batches):
                if (m, part) in leaves:
                    out = last(m, np.array([part]), np.array([leaves[m, part]]), np.zeros(len(data), np.int64), data)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)

        def down(key, nodes: pa.Table, dealt: pa.Table) -> pa.Table:
            m, part = (k.as_py() for k in key)
            data = np.frombuffer(b"".join(dealt.column("load").to_pylist()), np.uint8).reshape(-1, width)
            ids, col, cut, left, right, value = (nodes.column(c).to_numpy() for c in ("node", "input", "bin", "left", "right", "value"))
            order = np.argsort(ids)
            ids, col, cut, value = ids[order], col[order], cut[order], value[order]
            sides = np.stack([np.searchsorted(ids, c[order]) for c in (left, right)], 1)
            at = np.full(len(data), np.searchsorted(ids, part))
            if len(data):
                bins = np.frombuffer(b"".join(dealt.column("bins").to_pylist()), np.uint8).reshape(len(data), -1)
                live = np.flatnonzero(col[at] >= 0)
                while len(live):
                    here = at[live]
                    at[live] = sides[here, (bins[live, col[here]] > cut[here]).astype(np.int64)]
                    live = live[col[at[live]] >= 0]
            return pa.Table.from_arrays([pa.array(c) for c in last(m, ids, value, at, data)], names=names)

        dealt = rows.mapInArrow(deal, "member int, part long, bins binary, load binary")
        nodes = self.nodes.where("part != 0").select("member", "part", "node", "input", "bin", "left", "right", "value")
        out = nodes.groupBy("member", "part").cogroup(dealt.groupBy("member", "part")).applyInArrow(down, schema)
        return out.unionByName(rows.mapInArrow(above, schema)) if leaves else out

    def scores(self, rows: DataFrame) -> DataFrame:
        """(row, share): the mean leaf value over all trees of each of ``rows`` (x, row)."""
        def load(batch):
            ids = batch.column(1).to_numpy().astype(np.int64)[:, None].view(np.uint8)
            return lambda k: (np.arange(len(ids)), ids)

        def last(m, ids, value, at, data):
            return np.ascontiguousarray(data).view(np.int64).ravel(), np.rint(value * UNIT).astype(np.int64)[at]

        sizes = [r["count"] for r in self.nodes.groupBy("member").count().collect()]                # one row per tree
        units = self._routed(rows, load, 8, last, "row long, units long") if max(sizes) > TREE_NODES else self._whole(rows, sum(sizes))
        units = units.groupBy("row").agg(F.sum("units").alias("units"))
        return units.select("row", (F.col("units") / F.lit(UNIT * len(self.members))).alias("share"))

    def _whole(self, rows: DataFrame, n_nodes: int) -> DataFrame:
        """(row, units) per row and block of trees: a task has whole trees of a block and some of the rows."""
        members, cuts, tasks = self.members, self.cuts, rows.sparkSession.sparkContext.defaultParallelism
        shares = max(1, math.ceil(rows.count() / TASK_ROWS))
        blocks = min(len(members), max(math.ceil(n_nodes / TASK_NODES), math.ceil(2 * tasks / shares)))
        schema = "member int, block int, share int, a binary, b binary, c binary"
        names = [c.split()[0] for c in schema.split(", ")]
        place = {m: k for k, m in enumerate(members)}

        def row(*values):
            return [pa.array([v], t) for v, t in zip(values, (pa.int32(),) * 3 + (pa.binary(),) * 3)]

        def pack(t: pa.Table) -> pa.Table:
            """A tree: input and bin and children's places of its nodes (a leaf leads to itself), and the root's place and all units."""
            ids, col, cut, left, right, value = (t.column(c).to_numpy() for c in ("node", "input", "bin", "left", "right", "value"))
            order = np.argsort(ids)
            ids, col, cut, value, every = ids[order], col[order], cut[order], value[order], np.arange(len(ids))
            sides = np.stack([np.where(col >= 0, np.searchsorted(ids, c[order]), every) for c in (left, right)], 1).astype(np.int32)
            m, units = t.column("member")[0].as_py(), np.append(np.searchsorted(ids, ROOT), np.rint(value * UNIT).astype(np.int64))
            return pa.Table.from_arrays(row(m, place[m] % blocks, None, np.stack([col, cut], 1).astype(np.int16).tobytes(), sides.tobytes(), units.tobytes()),
                                        names=names)

        def bin_rows(batches):
            for batch in batches:
                if batch.num_rows:
                    x, ids = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), batch.column(1).to_numpy().astype(np.int64)
                    bins = np.zeros(x.shape, np.uint8)
                    for i, c in cuts.items():
                        bins[:, i] = np.searchsorted(c, x[:, i], side="left")
                    share = int(mixed(ids[:1].view(np.uint64))[0] % np.uint64(shares))
                    yield pa.RecordBatch.from_arrays(row(None, None, share, bins.tobytes(), ids.tobytes(), None), names=names)

        def meet(batches):
            trees, parts = [], []
            for b in batches:
                for m, _, _, *c in zip(*(b.column(n).to_pylist() for n in names)):
                    (parts if m is None else trees).append(c)
            trees = [(*np.frombuffer(a, np.int16).reshape(-1, 2).astype(np.int64).T, np.frombuffer(b, np.int32).astype(np.int64), np.frombuffer(c, np.int64)) for a, b, c in trees]
            for bins, ids, _ in parts:
                ids, bins = np.frombuffer(ids, np.int64), np.frombuffer(bins, np.uint8)
                first, total = np.arange(len(ids)) * (len(bins) // len(ids)), np.zeros(len(ids), np.int64)
                for col, cut, sides, units in trees:
                    at, live, base = np.full(len(ids), -1), np.arange(len(ids)), first
                    here, units, step = np.full(len(ids), units[0]), units[1:], 0
                    while len(live):
                        step += 1
                        if step % 4 == 1:                      # rows in leaves stay there; now and then they are set aside
                            on = col.take(here) >= 0
                            if not on.all():
                                at[live] = here
                                on = np.flatnonzero(on)
                                live, here, base = live.take(on), here.take(on), base.take(on)
                        here = sides.take(2 * here + (bins.take(base + np.maximum(col.take(here), 0)) > cut.take(here)))
                    total += units.take(at)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["row", "units"])

        trees = self.nodes.groupBy("member").applyInArrow(pack, schema).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        dealt = rows.mapInArrow(bin_rows, schema).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        met = trees.unionByName(dealt).repartitionById(blocks * shares, F.col("block") * F.lit(shares) + F.col("share"))
        return met.mapInArrow(meet, "row long, units long")

    def totals(self, rows: DataFrame, spec: Forest) -> DataFrame:
        """As :func:`leaf_totals`, of ``rows`` (x, y, h)."""
        def load(batch):
            y, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            w, y = spec.weights(h), y.astype(np.uint8)

            def take(k):
                at = np.flatnonzero(w[:, k])
                return at, np.stack([w[at, k], y[at]], 1)
            return take

        def last(m, ids, value, at, data):
            w = data[:, 0].astype(float)
            weight, positive = np.bincount(at, w, len(ids)), np.bincount(at, w * data[:, 1], len(ids))
            hit = np.flatnonzero(weight)
            return np.full(len(hit), m, np.int32), ids[hit], weight[hit], positive[hit]

        found = self._routed(rows, load, 2, last, "member int, node long, weight double, positive double")
        return found.groupBy("member", "node").agg(F.sum("weight").alias("weight"), F.sum("positive").alias("positive"))


def ensemble(nodes: DataFrame, rate: float | None = None, few: int = FEW_NODES) -> TreePredictor | TreeTable:
    """The trees of a node table: on the driver while they are few, else left in their table."""
    if rate is None and "part" in nodes.columns and nodes.limit(few + 1).count() > few:
        return TreeTable(nodes)
    return TreePredictor(nodes.toArrow(), rate)


def leaf_totals(rows: DataFrame, predictor: TreePredictor | TreeTable, spec: Forest) -> DataFrame:
    """(member, node, weight, positive): what the rows (grp, x, y, h) of the spec's group add up to in each
    leaf, routed by their own values, with the bootstrap weights drawn again."""
    if isinstance(predictor, TreeTable):
        return predictor.totals(rows.where(F.col(GROUP) == spec.group).select(X, Y, "h"), spec)
    sent = rows.sparkSession.sparkContext.broadcast(predictor)

    def run(batches):
        p = sent.value
        for b in batches:
            y, h = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            w = spec.weights(h).astype(float)
            at = np.concatenate([p.leaves(x[lo:lo + ROUTE]) for lo in range(0, len(y), ROUTE)])
            weight = np.bincount(at.ravel(), w.ravel(), len(p.value))
            positive = np.bincount(at.ravel(), (w * y[:, None]).ravel(), len(p.value))
            hit = np.flatnonzero(weight)
            yield pa.RecordBatch.from_arrays([pa.array(p.members[hit], pa.int32()), pa.array(p.ids[hit], pa.int64()), pa.array(weight[hit]), pa.array(positive[hit])],
                                             names=["member", "node", "weight", "positive"])

    return (rows.where(F.col(GROUP) == spec.group).select(GROUP, X, Y, "h").mapInArrow(run, "member int, node long, weight double, positive double")
            .groupBy("member", "node").agg(F.sum("weight").alias("weight"), F.sum("positive").alias("positive")))
