"""Penalised logistic regressions, any number of them fitted together.

Each pass over the rows sums loss, slope and curvature (a Gram matrix of the inputs, weighted by
p (1 - p) and the bootstrap) of every unfinished fit at once; the driver then takes one damped Newton
step per fit, on at most ``inputs + 1`` unknowns.  With an L1 penalty the step minimises the quadratic
model plus the penalty by coordinate descent.  A dozen passes fit a whole grid of folds, penalties and
bootstrap members.  Large groups are first fitted on a share of their rows; from there, few passes over
all rows lead to the same optimum."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import write_scratch
from .frame import GROUP, Y, X, bootstrap_weights, member_features

MAX_PASSES = 200
#: a fit is done when no slope of penalty + C * (sum of losses) exceeds this share of C * rows
TOL = 1e-10
#: partial sums (tasks times unfinished fits, about 1 kB each) that come straight to the driver
FEW = 4096
#: rows of one group packed as one value, and packs that a pass takes at a time
PACK, PACKS = 32, 64
#: numbers of rows times fits that a step holds at a time (less than a core's cache)
CELLS = 1 << 16
#: groups of so many rows start from a fit of one pack in SHARE, where that has enough rows of both labels
LARGE, SHARE, ENOUGH = 1 << 18, 16, 500
#: up to so many fits of a group take a matrix product each; more share the products of the inputs
SINGLE = 8


@dataclass(frozen=True)
class Logit:
    """One fit: penalty(w) + C * sum of log losses, over the rows of one group.

    ``member`` (with ``max_features`` and ``random_state``) makes it a bootstrap member; -1 takes
    every row once and all inputs.  ``penalised_intercept`` treats the intercept as a weight."""

    config: str
    group: int
    penalty: str = "l2"
    C: float = 1.0
    penalised_intercept: bool = False
    member: int = -1
    max_features: float | int = 1.0
    random_state: int = 10


class LogitPredictor:
    """Mean probability of the members; ``weights`` has a row per member, the intercept last."""

    kind = "logit"

    def __init__(self, weights: np.ndarray):
        self.weights = np.asarray(weights, float)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights[:, :-1].T + self.weights[:, -1]
        return (1 / (1 + np.exp(-np.clip(z, -700, 700)))).mean(1)

    def table(self) -> pa.Table:
        """The model as a relation: (member, input, weight); the intercept is input -1."""
        m, p = self.weights.shape
        return pa.table({"member": pa.array(np.repeat(np.arange(m), p)), "input": pa.array(np.tile([*range(p - 1), -1], m)),
                         "weight": pa.array(self.weights.ravel())})

    def state(self) -> dict:
        return {}

    @classmethod
    def of(cls, table: pa.Table, state: dict) -> "LogitPredictor":
        t = table.to_pandas()
        t["input"] = t["input"].where(t["input"] >= 0, 1 << 30)
        return cls(t.sort_values(["member", "input"])["weight"].to_numpy().reshape(t["member"].nunique(), -1))


def packed(rows: DataFrame) -> DataFrame:
    """(grp, x, y, h) with the numbers of up to ``PACK`` rows of a group as bytes, written once: every
    pass then hands few long values to Python instead of each input of each row."""
    def run(batches):
        for b in batches:
            group, y, h = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(group), -1)
            out = []
            for g in np.unique(group).tolist():
                at = np.flatnonzero(group == g)
                for k in range(0, len(at), PACK):
                    some = at[k:k + PACK]
                    out.append((g, x[some].tobytes(), y[some].tobytes(), h[some].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=[GROUP, X, Y, "h"])
    return write_scratch(rows.select(GROUP, X, Y, "h").mapInArrow(run, f"{GROUP} long, {X} binary, {Y} binary, h binary"), "packed")


def _gram(xg: np.ndarray, weight: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Per fit (column of ``weight``): the upper half of the Gram matrix of the weighted inputs; of fits with
    one input (``single``), the squares and the products with the intercept."""
    i, j = np.triu_indices(xg.shape[1])
    if weight.shape[1] <= SINGLE:
        return np.stack([(xg.T @ (xg * w[:, None]))[i, j] for w in weight.T])
    few = np.flatnonzero((i == j) | (j == xg.shape[1] - 1))
    out, ends = np.zeros((weight.shape[1], len(i))), [0, *(np.flatnonzero(np.diff(single)) + 1).tolist(), len(single)]
    for lo, hi in zip(ends, ends[1:]):
        at = few if single[lo] else np.arange(len(i))
        out[lo:hi, at] = weight[:, lo:hi].T @ (xg[:, i[at]] * xg[:, j[at]])
    return out


def _part(xg: np.ndarray, y: np.ndarray, s: np.ndarray, weights: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Per fit: loss, slope and curvature of some rows; ``s``: rows x fits, how often a row counts."""
    z = xg @ weights.T
    e = np.clip(z, -700, 700)
    np.exp(np.negative(e, out=e), out=e)
    p = 1 / (1 + e)
    losses = np.log1p(e)
    losses += np.multiply(z, 1 - y[:, None], out=z)
    loss = np.einsum("ij,ij->j", s, losses)
    e *= p                                                     # 1 - p
    p *= s
    e *= p
    p -= s * y[:, None]
    return np.column_stack([loss, p.T @ xg, _gram(xg, e, single)])


def _draws(fits: list[Logit]) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """The (random state, members) whose draws the fits need, and each fit's column among them; column 0 is for
    fits that take every row once.  Configurations share their draws."""
    names = [(f.random_state, f.member) if f.member >= 0 else None for f in fits]
    known = sorted({n for n in names if n})
    states = [(state, np.array([m for s, m in known if s == state])) for state in sorted({s for s, _ in known})]
    columns = {None: 0, **{n: k + 1 for k, n in enumerate(known)}}
    return states, np.array([columns[n] for n in names])


def _counts(draws, h: np.ndarray) -> np.ndarray:
    """rows x fits: how often each row counts."""
    states, columns = draws
    drawn = [np.ones((len(h), 1), np.uint8), *(bootstrap_weights(h, members, state) for state, members in states)]
    return np.concatenate(drawn, 1).astype(float).take(columns, 1)


def _sums(rows: DataFrame, fits: dict[int, list[Logit]], weights: dict[int, np.ndarray], numbers: dict[int, list[int]], few: bool) -> dict[int, np.ndarray]:
    """Per fit number: loss, slope (inputs + 1) and the upper half of the curvature, over :func:`packed`
    rows.  With ``few`` partial sums (see :data:`FEW`) they are added up where they arrive, otherwise by tasks."""
    sent = rows.sparkSession.sparkContext.broadcast((fits, weights, numbers))

    def run(batches):
        fits, weights, numbers = sent.value
        single = {g: np.array([f.member >= 0 and not isinstance(f.max_features, float) and f.max_features == 1 for f in some]) for g, some in fits.items()}
        draws, total = {g: _draws(some) for g, some in fits.items()}, {}
        for b in batches:
            group = b.column(0).to_numpy(zero_copy_only=False)
            for g in np.unique(group).tolist():
                if g not in fits:
                    continue
                mine = np.flatnonzero(group == g)
                for k in range(0, len(mine), PACKS):
                    x, y, h = (b"".join(b.column(c).take(pa.array(mine[k:k + PACKS])).to_pylist()) for c in (1, 2, 3))
                    y, h = np.frombuffer(y), np.frombuffer(h, np.int64)
                    xg = np.column_stack([np.frombuffer(x).reshape(len(y), -1), np.ones(len(y))])
                    step = max(PACK, CELLS // len(fits[g]))
                    for lo in range(0, len(y), step):
                        at = slice(lo, lo + step)
                        part = _part(xg[at], y[at], _counts(draws[g], h[at]), weights[g], single[g])
                        total[g] = total[g] + part if g in total else part
        for g, part in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[g], pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(part.ravel()), part.shape[1]).cast(pa.list_(pa.float64()))],
                names=["fit", "sums"])

    def add(table: pa.Table) -> pa.Table:
        m = table.column("sums").combine_chunks()
        total = m.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1).sum(0)
        return pa.table({"fit": table.column("fit")[:1], "sums": pa.array([total], pa.list_(pa.float64()))})

    schema = "fit long, sums array<double>"
    parts = rows.mapInArrow(run, schema)
    out = (parts if few else parts.groupBy("fit").applyInArrow(add, schema)).toArrow()        # FEW rows, or one per fit
    found: dict[int, np.ndarray] = {}
    for n, v in zip(out.column("fit").to_pylist(), out.column("sums").to_pylist()):
        found[n] = found[n] + np.array(v) if n in found else np.array(v)
    return found


class _Fit:
    """The state of one fit between passes."""

    def __init__(self, spec: Logit, n_inputs: int, rows: int):
        self.spec, self.q = spec, n_inputs + 1
        cols = np.arange(n_inputs) if spec.member < 0 else member_features(n_inputs, spec.max_features, spec.member, spec.random_state)
        self.at = np.append(cols, n_inputs)
        self.free = np.zeros(len(self.at), bool)              # unknowns without a penalty
        self.free[-1] = not spec.penalised_intercept
        self.w = np.zeros(self.q)
        self.trial, self.direction, self.step = self.w.copy(), None, 1.0
        self.value, self.done, self.limit = np.inf, rows == 0, TOL * spec.C * max(rows, 1)

    def penalty(self, w: np.ndarray) -> float:
        v = w[self.at][~self.free]
        return float(np.abs(v).sum() if self.spec.penalty == "l1" else 0.5 * (v @ v))

    def take(self, sums: np.ndarray) -> None:
        """Accept or shorten the trial step, then choose the next one."""
        C = self.spec.C
        value = self.penalty(self.trial) + C * sums[0]
        if value > self.value + 1e-13 * abs(self.value) and self.step > 1e-6:
            self.step /= 2
            self.trial = self.w.copy()
            self.trial[self.at] += self.step * self.direction
            return
        self.w, self.value, self.step = self.trial, value, 1.0
        slope = C * sums[1:1 + self.q][self.at]
        curve = np.zeros((self.q, self.q))
        curve[np.triu_indices(self.q)] = sums[1 + self.q:]
        curve = curve + np.triu(curve, 1).T
        curve = C * curve[np.ix_(self.at, self.at)] + 1e-12 * C * np.eye(len(self.at))
        w = self.w[self.at]
        if self.spec.penalty == "l1":
            self.done = violation(slope, w, self.free) <= self.limit
            self.direction = l1_step(slope, curve, w, self.free)
        else:
            slope = slope + np.where(self.free, 0, w)
            self.done = np.abs(slope).max() <= self.limit
            self.direction = -np.linalg.solve(curve + np.diag(np.where(self.free, 0.0, 1.0)), slope)
        self.trial = self.w.copy()
        self.trial[self.at] += self.direction


def violation(slope: np.ndarray, w: np.ndarray, free: np.ndarray) -> float:
    """How far the L1 optimality (KKT) conditions are missed: slope of the losses against the penalty's."""
    zero = np.maximum(np.abs(slope) - 1, 0)
    return float(np.where(free, np.abs(slope), np.where(w == 0, zero, np.abs(slope + np.sign(w)))).max())


def l1_step(slope: np.ndarray, curve: np.ndarray, w: np.ndarray, free: np.ndarray, sweeps: int = 2000) -> np.ndarray:
    """Minimise slope * d + d' curve d / 2 + the absolute sum of the penalised w + d, by coordinates."""
    d, lean = np.zeros(len(w)), slope.copy()                  # lean: slope of the quadratic model at d
    for _ in range(sweeps):
        largest = 0.0
        for j in range(len(w)):
            at = w[j] + d[j]
            new = at - lean[j] / curve[j, j]
            if not free[j]:
                new = np.sign(new) * max(abs(new) - 1 / curve[j, j], 0.0)
            if new != at:
                lean += curve[:, j] * (new - at)
                largest = max(largest, abs(new - at) * np.sqrt(curve[j, j]))
                d[j] = new - w[j]
        if largest < 1e-12:
            break
    return d


def _passes(rows: DataFrame, fits: list[_Fit], max_passes: int) -> None:
    """Newton passes over :func:`packed` rows until all fits are done."""
    tasks = rows.rdd.getNumPartitions()
    for _ in range(max_passes):
        active = [i for i, f in enumerate(fits) if not f.done]
        if not active:
            break
        numbers: dict[int, list[int]] = {}
        for i in active:
            numbers.setdefault(fits[i].spec.group, []).append(i)
        sums = _sums(rows, {g: [fits[i].spec for i in some] for g, some in numbers.items()},
                     {g: np.array([fits[i].trial for i in some]) for g, some in numbers.items()}, numbers, tasks * len(active) <= FEW)
        for i in active:
            if i in sums:
                fits[i].take(sums[i])
            else:
                fits[i].done = True


def _starts(rows: DataFrame, some: DataFrame, specs: list[Logit], n_inputs: int, n_rows: dict[int, int]) -> dict[Logit, np.ndarray]:
    """Weights fitted on a share of the packs, of the groups that have enough rows in it."""
    def run(batches):
        for b in batches:
            group, y = b.column(0).to_numpy(zero_copy_only=False), [np.frombuffer(v) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(group), pa.array([len(v) for v in y], pa.int64()), pa.array([int(v.sum()) for v in y], pa.int64())], names=[GROUP, "n", "p"])

    counted = some.select(GROUP, Y).mapInArrow(run, f"{GROUP} long, n long, p long").groupBy(GROUP).agg(F.sum("n").alias("n"), F.sum("p").alias("p")).collect()   # one row per group
    n = {r[GROUP]: r["n"] for r in counted if min(r["p"], r["n"] - r["p"]) >= ENOUGH}
    fits = {s: _Fit(replace(s, C=s.C * n_rows[s.group] / n[s.group]), n_inputs, n[s.group]) for s in specs if s.group in n}
    for f in fits.values():
        f.limit *= 1e5                                         # a start need not be exact
    _passes(some, list(fits.values()), 20)
    return {s: f.w for s, f in fits.items() if f.done}


def fit_logits(rows: DataFrame, specs: list[Logit], n_inputs: int, n_rows: dict[int, int], max_passes: int = MAX_PASSES) -> dict[Logit, np.ndarray]:
    """Weights (the intercept last) of every fit over ``rows`` (grp, x, y, h) of its group."""
    fits = [_Fit(s, n_inputs, n_rows.get(s.group, 0)) for s in specs]
    rows = packed(rows)
    large = [s for s in specs if n_rows.get(s.group, 0) >= LARGE]
    if large:
        share = F.col(GROUP).isin(sorted({s.group for s in large})) & (F.pmod(F.xxhash64("h"), F.lit(SHARE)) == 0)
        starts = _starts(rows, write_scratch(rows.where(share), "packed-share"), large, n_inputs, n_rows)
        for f in fits:
            f.trial = starts.get(f.spec, f.trial)
    _passes(rows, fits, max_passes)
    return {f.spec: f.w for f in fits}
