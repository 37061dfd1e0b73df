"""Fraud labelling by rules and compromise intervals.

The reference draws its samples with seeded random generators.  Here every
draw is a deterministic hash order instead: the n entities of day s follow each
other in md5 order from a place given by md5 of s, and the third of a day's matches are
the smallest ``md5("<TRANSACTION_ID>:<s>")``.  Same shape of result, same
result in every engine and on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schema as S
from ..session import write_scratch
from .prefix import bucketed_running_sum

START = "start_day"
END = "end_day"
# days of a bin of the interval joins
BIN_DAYS = 7
# a draw is sorted once so few rows (or fewer) are left of it; digits of the md5 by which it narrows down
SELECT_ROWS = 100_000
DIGITS = 3


def _md5_key(id_col: Column, day_col: Column) -> Column:
    return F.md5(F.concat(id_col.cast("string"), F.lit(":"), day_col.cast("string")))


def amount_rule(threshold=S.AMOUNT_RULE_THRESHOLD) -> Column:
    """Rule 1 predicate."""
    return F.col(S.TX_AMOUNT) > F.lit(threshold)


def last_start_day(tx: DataFrame) -> int:
    """Intervals start on days 0 .. max(TX_TIME_DAYS) - 1 (one scalar to the driver)."""
    m = tx.agg(F.max(S.TX_TIME_DAYS)).first()[0]
    return -1 if m is None else int(m) - 1


def sample_per_day(entities: DataFrame, id_col: str, n: int, last_day: int) -> DataFrame:
    """For each start day 0..last_day, n distinct entities.

    Entities are ranked once by md5(id), with a bucketed running count; day d
    draws the n ranks that follow ``md5(d)`` (as a number, modulo the entity
    count).  Only the drawn (day, rank) rows exist, joined to the ranks by
    equality, so the work is entities + n x days, not entities x days."""
    spark = entities.sparkSession
    if last_day < 0:
        return spark.createDataFrame([], f"{START} bigint, {id_col} bigint")
    e = entities.where(F.col(id_col).isNotNull()).select(id_col).distinct().withColumn("__h", F.md5(F.col(id_col).cast("string")))
    ranked = write_scratch(bucketed_running_sum(
        e, [], F.conv(F.substring("__h", 1, 3), 16, 10).cast("int"), [F.col("__h"), F.col(id_col)],
        {"__r": F.lit(1).cast("bigint")}, peers=False).select(id_col, (F.col("__r") - 1).alias("__r")), "ranked")
    total = ranked.count()
    first = F.conv(F.substring(F.md5(F.col(START).cast("string")), 1, 8), 16, 10).cast("bigint")
    draws = (spark.range((last_day + 1) * min(n, total))
             .select(F.expr(f"id div {max(min(n, total), 1)}").alias(START), F.expr(f"id % {max(min(n, total), 1)}").alias("__j"))
             .select(START, F.pmod(first + F.col("__j"), F.lit(max(total, 1))).alias("__r")))
    return draws.join(ranked, "__r").select(START, id_col)


def intervals(sampled: DataFrame, days: int) -> DataFrame:
    """(start_day, id) -> (start_day, end_day, id), end exclusive."""
    return sampled.select("*", (F.col(START) + F.lit(days)).alias(END))


BIN = "__bin"


def _binned(ivals: DataFrame, id_col: str) -> DataFrame:
    """(id, bin, intervals): each interval in every bin of ``BIN_DAYS`` days that it meets, one row per
    entity and bin.  An entity is drawn once a day at most, so a row lists at most
    ``BIN_DAYS`` + length intervals.  Written, so that the planner knows its size: it broadcasts a
    small table by itself and shuffles a large one."""
    bins = F.sequence(F.floor(F.col(START) / BIN_DAYS), F.floor((F.col(END) - 1) / BIN_DAYS))
    return write_scratch(ivals.where(F.col(END) > F.col(START)).select("*", F.explode(bins).alias(BIN))
                         .groupBy(F.col(id_col).alias("__iid"), F.col(BIN).alias("__ibin"))
                         .agg(F.collect_set(F.struct(START, END)).alias("__iv")), "intervals")


def _with_intervals(tx: DataFrame, ivals: DataFrame, id_col: str, out: str, how: str = "left") -> DataFrame:
    """``tx`` with the intervals of its entity that hold the row's day (an equi-join on
    entity and bin; a row lies in one bin, so none is duplicated)."""
    d = F.col(S.TX_TIME_DAYS)
    j = tx.join(_binned(ivals, id_col), (F.col(id_col) == F.col("__iid")) & (F.floor(d / BIN_DAYS) == F.col("__ibin")), how)
    return j.select(*tx.columns, F.filter("__iv", lambda iv: (iv[START] <= d) & (d < iv[END])).alias(out))


def in_intervals(tx: DataFrame, ivals: DataFrame, id_col: str, flag: str) -> DataFrame:
    """J4 as a flag: does the row's entity have an interval covering its day?"""
    return _with_intervals(tx, ivals, id_col, "__held").select(
        *tx.columns, (F.coalesce(F.size("__held"), F.lit(0)) > 0).alias(flag))


def interval_matches(tx: DataFrame, ivals: DataFrame, id_col: str) -> DataFrame:
    """One output row per (interval, transaction) it contains, with the interval's start and end."""
    return _with_intervals(tx, ivals, id_col, "__held", "inner").select(*tx.columns, F.inline("__held"))


def draw_limits(matches: DataFrame, fraction_den: int = 3, select_rows: int = SELECT_ROWS) -> DataFrame:
    """Per start day of (start_day, TRANSACTION_ID) rows, the md5 and id (``__lh``, ``__lid``) of the
    floor(n / fraction_den)-th smallest; days with none are absent.

    A selection, not a ranking: rows are counted by the first digits of their md5, the bucket in
    which the day's rank falls is counted by further digits while it is large, and only that
    bucket's rows are sorted in the end."""
    rows = write_scratch(matches.select(START, S.TX_ID, _md5_key(F.col(S.TX_ID), F.col(START)).alias("__h")), "draws")
    day = Window.partitionBy(START)
    wanted, width = None, DIGITS
    while True:
        hist = rows.groupBy(START, F.substring("__h", 1, width).alias("__b")).agg(F.count(F.lit(1)).alias("__c"))
        if wanted is None:
            hist = hist.select("*", F.floor(F.sum("__c").over(day) / fraction_den).alias("__k"))
        else:
            hist = hist.join(wanted, START)
        upto = F.sum("__c").over(day.orderBy("__b"))
        cross = write_scratch(hist.select("*", upto.alias("__to")).where("__k > 0 and __to >= __k and __to - __c < __k")
                              .select(START, "__b", "__c", (F.col("__k") - F.col("__to") + F.col("__c")).alias("__k")), "draw-buckets")
        largest = cross.agg(F.max("__c")).first()[0] or 0
        rows = rows.withColumn("__b", F.substring("__h", 1, width)).join(cross.select(START, "__b"), [START, "__b"]).drop("__b")
        if largest <= select_rows or width >= 30:
            break
        rows, wanted, width = write_scratch(rows, "draws"), cross.select(START, "__k"), width + DIGITS
    rank = F.row_number().over(day.orderBy("__h", S.TX_ID))
    return (rows.select("*", rank.alias("__r")).join(cross.select(START, "__k"), START).where("__r = __k")
            .select(START, F.col("__h").alias("__lh"), F.col(S.TX_ID).alias("__lid")))


def _drawn(h: Column, limit_h: Column, limit_id: Column) -> Column:
    return (h < limit_h) | ((h == limit_h) & (F.col(S.TX_ID) <= limit_id))


def sample_fraction(matches: DataFrame, fraction_den: int = 3) -> DataFrame:
    """Per start day, the floor(n / fraction_den) matches with the smallest
    md5(TRANSACTION_ID:start_day)."""
    limits = write_scratch(draw_limits(matches.select(START, S.TX_ID), fraction_den), "draw-limits")
    return (matches.join(limits, START).where(_drawn(_md5_key(F.col(S.TX_ID), F.col(START)), F.col("__lh"), F.col("__lid")))
            .select(*matches.columns))


def label_fraud(tx: DataFrame, terminal_ivals: DataFrame, customer_ivals: DataFrame,
                threshold=S.AMOUNT_RULE_THRESHOLD, factor: int = S.CUSTOMER_AMOUNT_FACTOR) -> DataFrame:
    """TX_FRAUD / TX_FRAUD_SCENARIO by the three rules, later rules win.

    Rule 3 multiplies the amount by ``factor`` once per sampled interval that holds the row.  A first
    pass over (id, customer, day) finds each start day's limit of the draw; the labels are then one
    pass over the rows, each compared with the limits of its own intervals: no row is ranked or
    joined by its id.  The limits are attached to the intervals, a row per drawn customer and bin."""
    base = tx.select(*[c for c in tx.columns if c not in (S.TX_FRAUD, S.TX_FRAUD_SCENARIO)])
    slim = base.select(S.TX_ID, S.CUSTOMER_ID, S.TX_TIME_DAYS)
    limits = draw_limits(interval_matches(slim, customer_ivals, S.CUSTOMER_ID).select(START, S.TX_ID))
    d = F.col(S.TX_TIME_DAYS)
    limited = (_binned(customer_ivals, S.CUSTOMER_ID).select("__iid", "__ibin", F.inline("__iv")).join(limits, START)
               .groupBy("__iid", "__ibin").agg(F.collect_list(F.struct(START, END, "__lh", "__lid")).alias("__iv")))
    rows = in_intervals(base, terminal_ivals, S.TERMINAL_ID, "__r2")
    cols = rows.columns
    allr = rows.join(write_scratch(limited, "limited-intervals"),
                     (F.col(S.CUSTOMER_ID) == F.col("__iid")) & (F.floor(d / BIN_DAYS) == F.col("__ibin")), "left")
    hits = F.filter("__iv", lambda iv: (iv[START] <= d) & (d < iv[END]) & _drawn(_md5_key(F.col(S.TX_ID), iv[START]), iv["__lh"], iv["__lid"]))
    allr = allr.select(*cols, F.coalesce(F.size(hits), F.lit(0)).alias("__k")).withColumn("__k", F.greatest("__k", F.lit(0)))
    r1 = amount_rule(threshold)
    scen = (F.when(F.col("__k") > 0, 3).when(F.col("__r2"), 2).when(r1, 1).otherwise(0)).cast("bigint")
    amount = F.when(F.col("__k") > 0,
                    (F.col(S.TX_AMOUNT) * F.pow(F.lit(factor), F.col("__k")).cast("decimal(20,0)"))
                    .cast(tx.schema[S.TX_AMOUNT].dataType)).otherwise(F.col(S.TX_AMOUNT))
    out = [amount.alias(c) if c == S.TX_AMOUNT else F.col(c) for c in cols if not c.startswith("__")]
    first_rule = (F.when(r1, 1).when(F.col("__r2"), 2).when(F.col("__k") > 0, 3)).cast("bigint")
    return allr.select(*out, (scen > 0).cast("bigint").alias(S.TX_FRAUD), scen.alias(S.TX_FRAUD_SCENARIO),
                       first_rule.alias("FIRST_RULE"))


def rule_counts(labelled: DataFrame) -> DataFrame:
    """Frauds newly flagged by each rule (rule order 1, 2, 3)."""
    return (labelled.where(F.col("FIRST_RULE").isNotNull())
            .groupBy(F.col("FIRST_RULE").alias("rule")).agg(F.count(F.lit(1)).alias("n_new_frauds")))
