"""Model inputs of many training groups at once (M1, M2): one row per transaction with its group
(a fold, or 0), label and standardised inputs as an array.

Means fill nulls, and the population deviation after filling scales; both are learned per group from
one aggregate.  An input without values, or without spread, is 0 in every row."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S

GROUP, X, Y = "grp", "x", "y"


@dataclass
class Scaling:
    """Per group: rows, and mean and deviation (0 where constant) of each input."""

    cols: list[str]
    n: dict[int, int]
    mean: dict[int, np.ndarray]
    std: dict[int, np.ndarray]

    def vector(self, group: int = 0) -> Column:
        """The standardised inputs of one group as an array expression over the raw columns."""
        return F.array(*[self._z(F.col(c).cast("double"), F.lit(float(m)), F.lit(float(1 / s if s else 0.0)))
                         for c, m, s in zip(self.cols, self.mean[group], self.std[group])])

    @staticmethod
    def _z(value: Column, mean: Column, scale: Column) -> Column:
        return (F.coalesce(F.nanvl(value, mean), mean) - mean) * scale

    def apply(self, rows: DataFrame, group: Column, *keep: Column) -> DataFrame:
        """(grp, x, *keep): each row standardised as its group was learned."""
        table = rows.sparkSession.createDataFrame(
            [(g, self.mean[g].tolist(), [1 / s if s else 0.0 for s in self.std[g].tolist()]) for g in self.n],
            f"{GROUP} bigint, __mean array<double>, __scale array<double>")        # one row per group
        x = F.array(*[self._z(F.col(c).cast("double"), F.col("__mean")[i], F.col("__scale")[i]) for i, c in enumerate(self.cols)])
        return (rows.withColumn(GROUP, group.cast("bigint")).join(F.broadcast(table), GROUP)
                .select(GROUP, x.alias(X), *keep))

    def state(self) -> dict:
        return {"cols": self.cols, "n": {str(g): n for g, n in self.n.items()},
                "mean": {str(g): v.tolist() for g, v in self.mean.items()}, "std": {str(g): v.tolist() for g, v in self.std.items()}}

    @classmethod
    def of(cls, state: dict) -> "Scaling":
        arrays = lambda d: {int(g): np.array(v) for g, v in d.items()}
        return cls(state["cols"], {int(g): n for g, n in state["n"].items()}, arrays(state["mean"]), arrays(state["std"]))


def fit_scaling(train: DataFrame, cols: list[str] = S.INPUT_FEATURES, group: Column | None = None) -> Scaling:
    """Learn the scaling of every group of ``train`` (all rows are group 0 without ``group``)."""
    rows = train.select((F.lit(0) if group is None else group).cast("bigint").alias(GROUP),
                        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    stats = rows.groupBy(GROUP).agg(
        F.count(F.lit(1)).alias("__n"), *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.var_pop(c).alias(f"v_{c}") for c in cols],
        *[F.count(c).alias(f"c_{c}") for c in cols]).collect()                     # one row per group
    out = Scaling(list(cols), {}, {}, {})
    for r in stats:
        empty = [c for c in cols if not r[f"c_{c}"]]
        if empty:
            warnings.warn(f"inputs without values count as constant: {empty}")
        out.n[r[GROUP]] = r["__n"]
        out.mean[r[GROUP]] = np.array([r[f"m_{c}"] or 0.0 for c in cols])
        var = np.array([(r[f"v_{c}"] or 0.0) * r[f"c_{c}"] / r["__n"] for c in cols])
        out.std[r[GROUP]] = np.where(var > 1e-24 * np.maximum(out.mean[r[GROUP]] ** 2, 1e-300), np.sqrt(var), 0.0)
    return out


def inputs(train: DataFrame, scaling: Scaling, group: Column | None = None, id_col: str = S.TX_ID, label: str = S.TX_FRAUD) -> DataFrame:
    """(grp, x, y, h): labelled rows ready for the fits; ``h`` is a 64-bit hash of the row's id."""
    rows = train.where(F.col(label).isNotNull())
    keep = F.col(label).cast("double").alias(Y), F.xxhash64(F.col(id_col).cast("string")).alias("h")
    if group is None and 0 in scaling.n:                       # literals: generated code, no join
        return rows.select(F.lit(0).cast("bigint").alias(GROUP), scaling.vector().alias(X), *keep)
    return scaling.apply(rows, F.lit(0) if group is None else group, *keep)


# ------------------------------------------------------------ bootstrap ---

#: cumulative Poisson(1) probabilities of 0, 1, 2, ... as shares of 2**32
_POISSON = np.floor(np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, n + 1, dtype=float)) for n in range(12)]) * 2.0 ** 32).astype(np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bootstrap_weights(h: np.ndarray, members: np.ndarray, random_state: int) -> np.ndarray:
    """Poisson(1) weight of each row (by its id's hash) in each member: rows x members.  It depends on
    nothing else, so partitions and reruns agree."""
    with np.errstate(over="ignore"):
        salt = mixed(members.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(random_state % (1 << 64)))
        u = (mixed(h.view(np.uint64)[:, None] + salt[None, :]) >> np.uint64(32)).astype(np.uint32)
    out = np.zeros(u.shape, np.uint8)
    for limit in _POISSON.astype(np.uint32):
        out += (u >= limit).view(np.uint8)
    return out


def member_features(n_features: int, max_features, member: int, random_state: int) -> np.ndarray:
    """The sorted inputs a member sees: ``max_features`` of them (a count, or a share as a float)."""
    k = max(1, int(max_features * n_features)) if isinstance(max_features, float) else max(1, min(int(max_features), n_features))
    return np.sort(np.random.default_rng([random_state, member]).choice(n_features, k, replace=False))
