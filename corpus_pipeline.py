"""Corpus pipeline: toxic documents go, one document of each near-duplicate group stays, documents
with benchmark passages go, sources are mixed to target weights, and the rest is cut into shards.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is
written as Parquet and read again.  All stages but the last keep the columns of ``documents``, and any
others that the rows have.  An empty table stays empty in every stage, and rows equal in all columns
are treated alike, but that near duplicates keeps one of them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import decontaminate, jaccard, mixing, sharding, toxicity
from txnrisk.llm.tables import fixed_bitmap, in_bitmap, read_table, save

#: flags (2**24: 2 MB, whatever the corpus) that tell most of the rows that stay from those that may go
GONE_BITS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.  Null and empty texts stay."""
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.without_toxic(docs, toxicity.fit(docs.select("doc_id", "text"), labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on 5-word shingles, the smallest doc_id stays,
    once.  Texts without words, and rows without doc_id, stay as they are.  Where one doc_id stands
    for several texts, each text is a document of its own, which comes after those of other ids."""
    name = F.xxhash64("text")
    several = save(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.min(name).alias("lo"), F.max(name).alias("hi"))
                   .where("lo <> hi").select("__id"), "pipeline-several")
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    docs_ = docs.join(several, docs["doc_id"] == several["__id"], "left").withColumn(
        "__key", F.when(F.col("__id").isNotNull(), own).otherwise(F.col("doc_id").cast("long"))).drop("__id")
    groups = save(jaccard.jaccard_groups(docs_.select(F.col("__key").alias("doc_id"), "text"), k=5, percent=80), "pipeline-groups").withColumnRenamed("doc_id", "__key")
    out = groups.where("component_id <> __key").select("__key").distinct()
    again = groups.where("n_shingles > 0").groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key")
    # a bitmap finds the rows that may be concerned; the others stay where they are, and their texts do not travel
    mark = in_bitmap(spark, fixed_bitmap(out.union(again), F.xxhash64("__key"), GONE_BITS), F.xxhash64("__key"))
    marked = docs_.withColumn("__mark", mark)
    kept = marked.where("__mark").join(out, "__key", "left_anti")
    return (marked.where("not __mark").unionByName(kept.join(again, "__key", "left_anti"))
            .unionByName(kept.join(again, "__key", "left_semi").dropDuplicates(["__key"])).select(docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    found = decontaminate.contaminated(docs.select("doc_id", "text"), read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated as the mix takes them: whole repetitions, and one more where the fractional
    one takes at least half of the words.  Documents without words, and rows without doc_id, stay once.
    Rows of one doc_id are taken alike, by the smallest source and size among them."""
    one = F.min(F.struct("source", mixing.word_count().alias("size"))).alias("one")
    sizes = save(docs.where("doc_id is not null").groupBy("doc_id").agg(one).select("doc_id", "one.source", "one.size"), "pipeline-sizes")
    copies = mixing.mix_sources(sizes).select(
        "doc_id", F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(1).cast("int").alias("__copies"))
    return (docs.join(copies, "doc_id", "left").withColumn("__copies", F.coalesce("__copies", F.lit(1))).where("__copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(docs.columns))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """40 shards of equal row counts along the Hilbert curve over source, language and size."""
    ordered = sharding.hilbert_order(docs, sharding.document_dims(docs), ["doc_id", F.xxhash64("text")])
    return sharding.cut_runs(ordered)


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("mixing", mix), ("sharding", shard)]

#: stages 1 to 3 are beyond SQL; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
