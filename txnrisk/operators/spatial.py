"""Radius (theta) join as a grid equi-join (J6) and per-customer terminal lists (A10).

Customers lie in square cells of side r.  A cell with many of them is split into quarters, again and
again, until a part holds few, by its counted density; coincident customers are dealt to numbered
shares at last.  A terminal is copied to the parts that come within r of it and hold customers, which
is its own cell and, near a border, its neighbours.  The join is an equi-join on the part, and the exact
distance test is a residual filter: work is proportional to the pairs that share a neighbourhood, and a
dense city is spread over as many tasks as it has parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..session import write_scratch

# Coordinates derived from ids for the driver tables (the
# reference draws them uniformly in [0, 100)).
CUSTOMER_X_MUL, CUSTOMER_Y_MUL = 37, 91
TERMINAL_X_MUL, TERMINAL_Y_MUL = 53, 29
COORD_MOD, COORD_DIV = 1000, 10.0
RADIUS = 5.0
# customers of a part, and how often a cell's sides are halved at most
PART_CUSTOMERS = 512
MAX_HALVINGS = 6


def _coord(id_col: str, mul: int) -> Column:
    return ((F.col(id_col) * mul) % COORD_MOD).cast("double") / F.lit(COORD_DIV)


def customer_points(tx: DataFrame) -> DataFrame:
    c = tx.select(S.CUSTOMER_ID).where(F.col(S.CUSTOMER_ID).isNotNull()).distinct()
    return c.select(S.CUSTOMER_ID, _coord(S.CUSTOMER_ID, CUSTOMER_X_MUL).alias("x_customer_id"),
                    _coord(S.CUSTOMER_ID, CUSTOMER_Y_MUL).alias("y_customer_id"))


def terminal_points(tx: DataFrame) -> DataFrame:
    t = tx.select(S.TERMINAL_ID).where(F.col(S.TERMINAL_ID).isNotNull()).distinct()
    return t.select(S.TERMINAL_ID, _coord(S.TERMINAL_ID, TERMINAL_X_MUL).alias("x_terminal_id"),
                    _coord(S.TERMINAL_ID, TERMINAL_Y_MUL).alias("y_terminal_id"))


def _box_gap(at: str, low: Column, side: Column | float) -> Column:
    """Distance along one axis from a coordinate to the span [low, low + side]."""
    return F.greatest(low - F.col(at), F.col(at) - low - side, F.lit(0.0))


def radius_join(customers: DataFrame, terminals: DataFrame, r: float = RADIUS, part_customers: int = PART_CUSTOMERS) -> DataFrame:
    """Pairs (CUSTOMER_ID, TERMINAL_ID, distance) with distance strictly below r."""
    cx, cy, tx, ty = "x_customer_id", "y_customer_id", "x_terminal_id", "y_terminal_id"
    placed = customers.select(S.CUSTOMER_ID, cx, cy, F.floor(F.col(cx) / r).alias("__gx"), F.floor(F.col(cy) / r).alias("__gy"))
    # 2 ** halvings parts along each side of a cell, and shares of a part where that is not enough
    crowd = F.col("__n") / F.lit(float(part_customers))
    halvings = F.least(F.greatest(F.ceil(F.log2(F.greatest(crowd, F.lit(1.0))) / 2), F.lit(0)), F.lit(MAX_HALVINGS))
    cells = write_scratch(placed.groupBy("__gx", "__gy").agg(F.count(F.lit(1)).alias("__n"))
                          .select("__gx", "__gy", F.pow(F.lit(2), halvings).cast("int").alias("__cuts"), "__n")
                          .select("__gx", "__gy", "__cuts", F.greatest(F.ceil(crowd / (F.col("__cuts") * F.col("__cuts"))), F.lit(1)).cast("int").alias("__shares")), "cells")
    key = ["__gx", "__gy", "__px", "__py", "__share"]
    part = lambda c, g: F.least(F.floor((F.col(c) - F.col(g) * r) / (F.lit(r) / F.col("__cuts"))), F.col("__cuts") - 1).cast("int")
    cust = placed.join(cells, ["__gx", "__gy"]).select(
        S.CUSTOMER_ID, cx, cy, "__gx", "__gy", part(cx, "__gx").alias("__px"), part(cy, "__gy").alias("__py"),
        F.pmod(F.xxhash64(S.CUSTOMER_ID), "__shares").cast("int").alias("__share"))
    steps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    near = (terminals.select(S.TERMINAL_ID, tx, ty, F.inline(steps))
            .select(S.TERMINAL_ID, tx, ty, (F.floor(F.col(tx) / r) + F.col("dx")).alias("__gx"), (F.floor(F.col(ty) / r) + F.col("dy")).alias("__gy")))
    # a little more than r, so that rounding of a border never loses a part
    reach = r * (1 + 1e-9)
    close = lambda x, y: x * x + y * y <= F.lit(reach * reach)
    near = near.where(close(_box_gap(tx, F.col("__gx") * r, r), _box_gap(ty, F.col("__gy") * r, r))).join(cells, ["__gx", "__gy"])
    side = F.lit(r) / F.col("__cuts")
    spans = lambda: F.sequence(F.lit(0), F.col("__cuts") - 1)
    term = (near.withColumn("__px", F.explode(spans())).where(_box_gap(tx, F.col("__gx") * r + F.col("__px") * side, side) <= reach)
            .withColumn("__py", F.explode(spans()))
            .where(close(_box_gap(tx, F.col("__gx") * r + F.col("__px") * side, side), _box_gap(ty, F.col("__gy") * r + F.col("__py") * side, side)))
            .withColumn("__share", F.explode(F.sequence(F.lit(0), F.col("__shares") - 1)))
            .select(S.TERMINAL_ID, tx, ty, *key))
    dx, dy = F.col(cx) - F.col(tx), F.col(cy) - F.col(ty)
    dist = F.sqrt(dx * dx + dy * dy)
    return cust.join(term, key).select(S.CUSTOMER_ID, S.TERMINAL_ID, dist.alias("distance")).where(F.col("distance") < F.lit(r))


def terminals_within_radius(customers: DataFrame, terminals: DataFrame, r: float = RADIUS) -> DataFrame:
    """A10: per customer the sorted terminal list and its length; customers
    without any terminal in reach keep an empty list and 0."""
    pairs = radius_join(customers, terminals, r)
    lists = pairs.groupBy(S.CUSTOMER_ID).agg(F.sort_array(F.collect_list(S.TERMINAL_ID)).alias("available_terminals"))
    out = customers.join(lists, S.CUSTOMER_ID, "left")
    arr = F.coalesce(F.col("available_terminals"), F.array().cast("array<bigint>"))
    return out.select(*customers.columns, arr.alias("available_terminals"),
                      F.size(arr).cast("bigint").alias("nb_terminals"))
