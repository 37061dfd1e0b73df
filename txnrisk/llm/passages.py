"""Substring dedup by paragraph MinHash banding.

A paragraph ends at the end or start of a line of at least SHINGLE words, and elsewhere (also across
shorter lines) where the content says so: at words whose two-word hash is the smallest within
RADIUS words on both sides.  A passage is therefore cut alike
wherever it stands, also in the middle of other text.  Paragraphs whose MinHash signatures collide
in a band are compared on their exact sets of 5-word shingles; components of the similar ones are
clusters, one occurrence of each stays, and the neighbouring others are joined to removable passages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import components, fixed_bitmap, flags, read_table, release, save
from .wordhash import blocks, mix, sequence, text_bytes, words

SHINGLE = 5
SIMILARITY = 80         # percent
RECALL = 0.98
RADIUS = 4
#: words of the repeated paragraphs of a passage, at least, and words between two of them, at most
PASSAGE, GAP = 20, 4

_U = np.uint64
_K = _U(0x9E3779B97F4A7C15)


def tune_bands(similarity: float, recall: float, rows: int = 2) -> tuple[int, int]:
    """(bands, rows): the fewest bands of so many rows that find a pair at ``similarity`` with
    probability ``recall``."""
    bands = 1
    while 1 - (1 - similarity ** rows) ** bands < recall:
        bands += 1
    return bands, rows


def cut(g: np.ndarray, line_start: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """First words of the paragraphs of a block of documents, from the hash that starts at each
    word, the words that start a line, and the word offsets of the documents.

    A line start between two lines of fewer than SHINGLE words cuts nothing, and neither does the
    content so close to a line start that cuts: pieces under SHINGLE words stand alone, never two together."""
    n = len(g)
    doc = np.searchsorted(offs, np.arange(n), "right") - 1
    at = np.arange(n) + RADIUS * (doc + 1)                     # RADIUS fillers between documents
    wide = np.full(n + RADIUS * (len(offs) + 1), np.iinfo(np.uint64).max, np.uint64)
    wide[at] = g
    left = np.minimum.reduce([wide[at - d] for d in range(1, RADIUS + 1)])
    right = np.minimum.reduce([wide[at + d] for d in range(1, RADIUS + 1)])
    first = (g < left) & (g <= right)
    begins = np.zeros(n, bool)
    begins[offs[:-1][offs[:-1] < n]] = True
    line = np.flatnonzero(line_start | begins)
    long = np.diff(np.concatenate([line, [n]])) >= SHINGLE
    mark = line[long | np.concatenate([[True], long[:-1]]) | begins[line]]
    edge = np.concatenate([mark, [n]])
    for d in range(1, SHINGLE):
        first[edge[edge >= d] - d] = False
        first[edge[edge + d < n] + d] = False
    first[mark] = True
    return np.flatnonzero(first)


def paragraphs(batches, text: str = "text"):
    """Per block of documents: (batch, document of each paragraph, its first word in the document,
    its words, key of its shingles, all shingles of the block, range of its shingles)."""
    for b in batches:
        data, offs = text_bytes(b.column(b.schema.get_field_index(text)))
        for lo, hi in blocks(offs):
            raw = data[offs[lo]:offs[hi]]
            h, start, _, w = words(raw, offs[lo:hi + 1] - offs[lo])
            if len(h) < SHINGLE:
                continue
            lines = np.cumsum(raw == 10)[start]
            line_start = np.concatenate([[True], lines[1:] != lines[:-1]])
            g = np.concatenate([sequence(h, 2), h[-1:]])
            first = cut(g, line_start, w)
            size = np.diff(np.concatenate([first, [len(h)]]))
            keep = size >= SHINGLE
            first, size = first[keep], size[keep]
            if len(first) == 0:
                continue
            shingles = np.concatenate([sequence(h, SHINGLE), np.zeros(SHINGLE, np.uint64)])
            span = first, first + size - SHINGLE + 1
            doc = np.searchsorted(w, first, "right") - 1
            key = mix(by_range(np.add, mix(shingles + _K), span) + size.astype(np.uint64)).view(np.int64)
            yield b, lo + doc, first - w[doc], size, key, shingles, span


def by_range(f, x: np.ndarray, span) -> np.ndarray:
    """f over x[a:b] for each of the ascending, disjoint ranges; x has a value beyond the last."""
    return f.reduceat(x, np.stack(span, 1).ravel())[::2]


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, first, n, key) of every paragraph."""
    def run(batches):
        for b, doc, first, size, key, _, _ in paragraphs(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(key)],
                names=["doc_id", "first", "n", "key"])
    return docs.mapInArrow(run, "doc_id long, first int, n int, key long")


def band_keys(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, key): MinHash band values of the distinct paragraphs of each block."""
    def run(batches):
        for _, _, _, _, key, shingles, span in paragraphs(batches):
            key, one = np.unique(key, return_index=True)
            for band in range(bands):
                value = np.full(len(span[0]), band + 1, np.uint64)
                for row in range(rows):
                    low = by_range(np.minimum, mix(shingles ^ mix(np.array([band * rows + row + 1], np.uint64))), span)
                    value = mix(value * _K + low)
                yield pa.RecordBatch.from_arrays([pa.array(value[one].view(np.int64)), pa.array(key)], names=["band", "key"])
    return docs.mapInArrow(run, "band long, key long")


def shingles_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, shingles) of the wanted paragraphs."""
    bits = docs.sparkSession.sparkContext.broadcast(fixed_bitmap(wanted, F.col("key")))

    def run(batches):
        keep = flags(bits.value)
        for _, _, _, _, key, shingles, span in paragraphs(batches):
            key, one = np.unique(key, return_index=True)
            hit = keep[(key.view(np.uint64) >> _U(42)).astype(np.int64)]
            sets = [np.unique(shingles[span[0][i]:span[1][i]]).view(np.int64) for i in one[hit]]
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(sets, pa.list_(pa.int64()))], names=["key", "shingles"])

    return (docs.mapInArrow(run, "key long, shingles array<long>").join(wanted, "key", "left_semi").dropDuplicates(["key"]))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose shingle sets are similar enough."""
    side = lambda c: sets.select(F.col("key").alias(c), F.col("shingles").alias(f"s{c}"))
    common = F.size(F.array_intersect("sa", "sb"))
    return save(pairs.join(side("a"), "a").join(side("b"), "b")
                .where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b"), "passage-links")


def unjoined(near: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of keys of one band in different components that can still be similar: sets
    of like size with a common shingle among the first of both, rare ones first (of n shingles,
    n - ceil(percent n) + 1), which similar sets always have.  Bands of up to three keys have none."""
    bands = near.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 2").select("band")
    member = near.select("band", "key").union(near.select("band", F.col("hub").alias("key"))).distinct().join(bands, "band")
    member = member.join(groups.withColumnRenamed("node", "key"), "key", "left").select(
        "band", "key", F.coalesce("component", "key").alias("component"))
    mixed = member.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    member = save(member.join(mixed.select("band"), "band"), "passage-members")
    token = (sets.join(member.select("key").distinct(), "key")
             .select("key", F.size("shingles").alias("n"), F.explode("shingles").alias("token")))
    df = token.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    first = (token.join(df.where("df > 1"), "token")                # a lone shingle takes its place but joins nothing
             .groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
             .withColumn("lone", F.col("n") - F.size("t"))
             .withColumn("most", F.expr(f"n - cast(({percent} * n + 99) div 100 as int) + 1 - lone")).where("most > 0")
             .select("key", "n", F.explode(F.slice("t", F.lit(1), F.col("most"))).alias("t"))
             .select("key", "n", F.col("t.token").alias("token")))
    entry = save(member.join(first, "key"), "passage-prefixes")
    x, y = entry.alias("x"), entry.alias("y")
    return (x.join(y, ["band", "token"]).where("x.component < y.component")
            .where(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
            .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct())


def similar_keys(docs: DataFrame, percent: int, recall: float) -> DataFrame:
    """(a, b): pairs of keys that link all similar paragraphs that share a band.

    In each band, a key is first compared with the band's smallest key and with the one before it, so
    a band of many variants costs two comparisons for each.  A second round compares the keys of a
    band that no path joins yet, where :func:`unjoined` does not exclude that they are similar."""
    bands, rows = tune_bands(percent / 100, recall)
    w = Window.partitionBy("band").orderBy("key")
    near = save(band_keys(docs, bands, rows)
                .withColumn("before", F.lag("key").over(w)).withColumn("hub", F.first("key").over(w))
                .where("before <> key").select("band", "key", "before", "hub"), "passage-near")
    pairs = save(near.select("key", F.explode(F.array_distinct(F.array("before", "hub"))).alias("other"))
                 .select(F.least("other", "key").alias("a"), F.greatest("other", "key").alias("b")).distinct(), "passage-pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    sets = save(shingles_of(docs, wanted), "passage-sets")
    links = verified(pairs, sets, percent)
    release(pairs)
    more = verified(unjoined(near, sets, components(links, "passages-first"), percent), sets, percent)
    release(sets)
    release(near)
    return links.union(more)


def repeated_passages(docs: DataFrame, percent: int = SIMILARITY, recall: float = RECALL, passage: int = PASSAGE) -> DataFrame:
    """(doc_id, start_word, end_word, n_paragraphs, cluster, first_doc_id, keep): stretches with at
    least ``passage`` words in paragraphs that occur again, in the same or another document, cut
    where first occurrences and repeats meet.

    ``keep`` marks the rows that stay (the first occurrence, by doc_id and place, of all their
    paragraphs); the others can be removed.  ``first_doc_id`` is the smallest document with one of
    its paragraphs.  Rows without id, text or words have none; repeated rows occur in place of each
    other and stay; of equal paragraphs the first by doc_id and place counts as the first; other
    columns are not read; an empty table gives an empty result."""
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    occ = save(occurrences(docs), "passage-occurrences", {"compression": "zstd"})
    groups = components(similar_keys(docs, percent, recall), "passages").withColumnRenamed("node", "key")
    # counted by key first: only keys that can repeat meet the occurrences again
    by_key = occ.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("d"))
    likely = save(by_key.join(groups, "key", "left").where("c > 1 or component is not null")
                  .select("key", F.coalesce("component", "key").alias("cluster"), "c", "d"), "passage-keys")
    many = (likely.groupBy("cluster").agg(F.sum("c").alias("c"), F.min("d").alias("first_doc_id"))
            .where("c > 1").select("cluster", "first_doc_id"))
    repeated = save(likely.select("key", "cluster").join(many, "cluster"), "passage-repeated")
    again = save(occ.join(repeated, "key").select("doc_id", "first", "n", "cluster", "first_doc_id"), "passage-again")
    release(occ)
    heads = again.where("doc_id = first_doc_id").groupBy("cluster").agg(F.min("first").alias("head"))
    marked = again.join(heads, "cluster").withColumn("keeps", (F.col("doc_id") == F.col("first_doc_id")) & (F.col("first") == F.col("head")))
    w = Window.partitionBy("doc_id").orderBy("first", "n")                       # one document each
    apart = F.col("first") > F.lag(F.col("first") + F.col("n")).over(w) + GAP
    turn = F.col("keeps") != F.lag("keeps").over(w)
    return (marked.withColumn("stretch", F.sum(F.when(apart, 1).otherwise(0)).over(w))
            .withColumn("run", F.sum(F.when(apart | turn, 1).otherwise(0)).over(w))
            .withColumn("words", F.sum("n").over(Window.partitionBy("doc_id", "stretch"))).groupBy("doc_id", "run")
            .agg(F.min("first").cast("long").alias("start_word"), F.max(F.col("first") + F.col("n")).cast("long").alias("end_word"),
                 F.first("words").alias("words"), F.count(F.lit(1)).alias("n_paragraphs"), F.min("cluster").alias("cluster"),
                 F.min("first_doc_id").alias("first_doc_id"), F.min("keeps").alias("keep"))
            .where(F.col("words") >= passage).drop("run", "words"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents"))
