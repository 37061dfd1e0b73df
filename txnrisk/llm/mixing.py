"""Mixing sources to target weights by capped water-filling.

Each source gets a share of a word budget in proportion to its weight.  A source whose share is
above ``max_epochs`` times its own size is clamped there, and the rest of the budget is shared
again among the others until none is above its cap.  Inside a source every document is repeated
``floor(target / size)`` whole times; the remaining fraction is dealt to the documents in a seeded
hash order until the target is met, the last one taking a part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import ordered_totals, read_table, save

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)          # the budget: 3/2 of all words
MAX_EPOCHS = 2
SEED = 7

WORDS_SQL = r"cast(regexp_count(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as long)"


def word_count() -> "F.Column":
    return F.expr(WORDS_SQL)


def water_fill(sources: DataFrame, budget_times_two: int, max_epochs: int) -> tuple[float, float]:
    """The water level: the words per unit of weight for sources that stay below their cap.

    ``sources`` holds (weight, source_size).  Each round is one aggregate over the sources, exact
    in integers: clamp those at or below the level, share what is left.  The level only rises, so
    it ends after as many rounds as there are distinct clamping steps."""
    level_num, level_den = -1, 1
    while True:
        capped = F.expr(f"cast(source_size as decimal(38,0)) * {2 * max_epochs} * {level_den} "
                        f"<= cast(weight as decimal(38,0)) * {level_num}")
        r = sources.agg(F.sum(F.when(capped, F.col("source_size"))).alias("clamped"),
                        F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if not r["open"]:
            return level_num, 2 * level_den
        num, den = budget_times_two - 2 * max_epochs * (r["clamped"] or 0), r["open"]
        if (num, den) == (level_num, level_den):
            return num, 2 * den
        level_num, level_den = num, den


def mix_sources(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """From (doc_id, source, size): doc_id, size, source_size, target, taken, source.

    Sources in code-point order, null last, take the weights in turn.  A document of size 0 takes
    nothing; a source without words has target 0; repeated rows are documents of their own; an
    empty table gives an empty result.  The same input and seed give the same result in any
    partitioning."""
    order = [F.col("source").isNull(), F.col("source")]
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = ordered_totals(sizes, order, ["source_size"], "sources")
    sources = save(ranked.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("__row_no") % len(weights) + 1).cast("int"))), "weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    num, den = water_fill(sources, total * share[0] * 2 // share[1], max_epochs)
    level = F.lit(float(num)) / F.lit(float(den))
    plan = sources.select(
        F.col("source").alias("__source"), "source_size", F.col("__before_source_size").alias("__base"),
        F.least(level * F.col("weight"), F.col("source_size").cast("double") * max_epochs).alias("target"))
    plan = plan.withColumn("__words", F.floor(F.col("target") + 0.5).cast("long")).withColumn(
        "__whole", F.when(F.col("source_size") > 0, F.expr("__words div source_size")).otherwise(F.lit(0)).cast("long"))
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    dealt = ordered_totals(docs.select("doc_id", "source", "size").withColumn("__draw", draw),
                           [*order, "__draw", "doc_id", "size"], ["size"], "deal")
    joined = dealt.join(plan, dealt["source"].eqNullSafe(plan["__source"]))
    rest = F.col("__words") - F.col("__whole") * F.col("source_size") - (F.col("__before_size") - F.col("__base"))
    return joined.select(
        "doc_id", "size", "source_size", "target",
        (F.col("__whole") * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))).alias("taken"), "source")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = save(read_table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size")), "mix-input")
    return mix_sources(docs)


OP7_SQL = r"""
with recursive d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
         [3, 1, 2][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int] as weight
  from d group by source),
r as (
  select *, sum(source_size) over w as caps, sum(weight) over (order by source_size::double / weight, source
           range between current row and unbounded following) as open_weight
  from s window w as (order by source_size::double / weight, source rows between unbounded preceding and 1 preceding)),
lv as (
  select (1.5::double * (select sum(source_size) from s) - 2 * coalesce(caps, 0)) as num, open_weight as den,
         source_size, weight, caps from r),
pick as (
  select num / den as lvl from lv where 2.0 * source_size > num / den * weight
  order by coalesce(caps, 0), source_size::double / weight limit 1),
t as (
  select source, source_size,
         coalesce(least((select lvl from pick) * weight, 2.0 * source_size), 0)::double as target from s),
e as (
  select d.*, t.source_size, t.target, floor(t.target + 0.5)::bigint as words,
         coalesce(sum(d.size) over (partition by d.source order by md5('7:' || d.doc_id::varchar), d.doc_id, d.size
           rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (case when source_size > 0 then words // source_size else 0 end * size
        + greatest(0, least(words - case when source_size > 0 then words // source_size else 0 end * source_size - before, size)))::bigint as taken,
       source
from e
"""
