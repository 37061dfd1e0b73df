"""N-gram Jaccard self-join with rare-first prefix filtering, and its groups of linked documents.

Documents become sets of k-word shingles; equal sets are one class from the start.  All shingles
are put in one global order, rare ones first, by a counting sketch over the whole corpus.  Two sets
with similarity of at least t share one of their first ``n - ceil(t n) + 1`` shingles, so only
those prefixes are joined.  Pairs then pass length, positional and suffix filters, and are verified
on the whole sets, each pair once.

Large groups of copies are not expanded: a first round compares every set with one hub per shared
prefix shingle, and the exact round joins only sets that no link has put in one group yet."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import components, fixed_bitmap, flags, read_table, release, save
from .wordhash import documents, mix, shingle_set

#: counters of the sketch (2**22 of 4 bytes: 16 MB, whatever the corpus) and counters per row
SKETCH_BITS = 22
SKETCH_ROW = 1 << 16
#: first-level partial sums of the sketch
SKETCH_SALT = 16
#: parts of the token space in the suffix filter: one bit each
PARTS = 1024

_U = np.uint64


def class_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit sums that stand for a set of shingles."""
    a = mix(shingles + _U(1)).sum(dtype=_U)
    b = mix(shingles ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U) ^ _U(len(shingles))
    return int(mix(np.array([a]))[0].astype(np.int64)), int(b.astype(np.int64))


def counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> _U(64 - SKETCH_BITS)).astype(np.int64)


def rare_first(shingles: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The set in the global order: by sketch count, then by value."""
    return shingles[np.lexsort((shingles, sketch[counter(shingles)]))]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def linked(common: int, na: int, nb: int, percent: int) -> bool:
    return 100 * common >= percent * (na + nb - common)


def profile(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, c1, c2, n, bits) by document, and the sketch of all shingle counts.  ``bits``: whether the
    set has an odd number of shingles in each part of the token space.

    One pass writes both: the rows of the documents, and from each task its part of the sketch in
    blocks, which are then added up in two salted steps of bounded memory."""
    names = ["doc_id", "c1", "c2", "n", "bits", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        rows, sets, last, ids = [], [], None, []

        def flush():
            np.add.at(total, counter(np.concatenate(sets)), 1)
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
            rows.clear()
            sets.clear()
            return out

        size = 0
        for b, i, h in documents(batches, "text"):
            if b is not last:
                ids, last = b.column(0).to_pylist(), b
            s = shingle_set(h, k)
            odd = np.bincount((s & _U(PARTS - 1)).astype(np.int64), minlength=PARTS) & 1
            rows.append((ids[i], *class_key(s), len(s), np.packbits(odd.astype(np.uint8)).view(np.int64), None))
            sets.append(s)
            size += len(s) + 50
            if size >= 1_000_000:
                size = 0
                yield flush()
        if rows:
            yield flush()
        for r in range(len(total) // SKETCH_ROW):
            part = total[r * SKETCH_ROW:(r + 1) * SKETCH_ROW]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip((None, None, None, -1 - r, None, part.astype("<u4").tobytes()), kinds)], names=names)

    both = save(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, c1 long, c2 long, n long, bits array<long>, counts binary"),
                "jaccard-profile", {"compression": "zstd"})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for r, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(raw, "<u4")
                sums[r] = sums[r] + v if r in sums else v
        for r, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([v.astype("<u4").tobytes()], pa.binary())],
                                             names=["n", "counts"])

    blocks = both.where("n < 0").select("n", "counts", (F.spark_partition_id() % SKETCH_SALT).alias("salt"))
    part = blocks.repartition("n", "salt").select("n", "counts").mapInArrow(add, "n long, counts binary")
    rows = part.repartition("n").mapInArrow(add, "n long, counts binary").toArrow()      # 16 MB at most
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r, raw in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
        sketch[(-1 - r) * SKETCH_ROW:-r * SKETCH_ROW] = np.frombuffer(raw, "<u4")
    return both.where("n >= 0").drop("counts"), sketch


def rows_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(text) of the documents whose doc_id is among ``nodes`` (node), and of a few others: a bitmap of fixed
    size thins them before any text is looked at."""
    bits = docs.sparkSession.sparkContext.broadcast(fixed_bitmap(nodes, F.xxhash64("node")))

    def run(batches):
        keep = flags(bits.value)
        for b in batches:
            spot = (b.column(0).to_numpy().view(_U) >> _U(42)).astype(np.int64)
            yield b.filter(pa.array(keep[spot])).select(["text"])

    return docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("h"), "text").mapInArrow(run, "text string")


def prefixes(docs: DataFrame, k: int, percent: int, sketch) -> DataFrame:
    """(token, c1, pos): the prefix shingles of every class, once per task."""
    def run(batches):
        counts, seen, out, size = sketch.value, set(), [], 0

        def flush():
            r = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["token", "c1", "pos"])
            out.clear()
            return r

        for _, _, h in documents(batches, "text"):
            s = shingle_set(h, k)
            key = class_key(s)
            if len(s) == 0 or key in seen:
                continue
            seen.add(key)
            p = prefix_length(len(s), percent)
            out.append((rare_first(s, counts)[:p].view(np.int64), np.full(p, key[0]), np.arange(p, dtype=np.int32)))
            size += p
            if size >= 100_000:
                size = 0
                yield flush()
        if out:
            yield flush()

    return docs.select("text").mapInArrow(run, "token long, c1 long, pos int")


def sets_of(docs: DataFrame, k: int, wanted: DataFrame, name: str) -> DataFrame:
    """(node, set) for the wanted classes (c1, c2, node): their whole shingle sets."""
    bits = docs.sparkSession.sparkContext.broadcast(fixed_bitmap(wanted, F.col("c1")))

    def run(batches):
        keep, seen, out, size = flags(bits.value), set(), [], 0

        def flush():
            r = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                                           names=["c1", "c2", "set"])
            out.clear()
            return r

        for _, _, h in documents(batches, "text"):
            s = shingle_set(h, k)
            key = class_key(s)
            if len(s) == 0 or key in seen or not keep[(key[0] & 0xFFFFFFFFFFFFFFFF) >> 42]:
                continue
            seen.add(key)
            out.append((*key, s.tobytes()))
            size += s.nbytes
            if size >= 1 << 22:
                size = 0
                yield flush()
        if out:
            yield flush()

    made = rows_of(docs, wanted).mapInArrow(run, "c1 long, c2 long, set binary")
    # one class for each node, so that a class's copies go where the join has put them: the sets travel once
    one = wanted.groupBy("node").agg(F.min(F.struct("c1", "c2")).alias("c")).select("node", "c.c1", "c.c2")
    return save(made.join(one, ["c1", "c2"]).dropDuplicates(["c1", "c2"]).select("node", "set"), name)


def by_suffix(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that pass the suffix filter."""
    side = lambda c: classes.select(F.col("node").alias(c), F.struct("n", "bits").alias(f"s_{c}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(suffix_near("s_a", "s_b", percent)).select("a", "b"))


def verified(docs: DataFrame, k: int, percent: int, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar enough; each is looked at once."""
    likely = save(pairs, "jaccard-likely")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = sets_of(docs, k, save(classes.select("c1", "c2", "node").join(nodes, "node"), "jaccard-wanted"), "jaccard-sets")

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(linked(common, len(x), len(y), percent))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}"))
    links = save(likely.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
                 .mapInArrow(run, "a long, b long"), "jaccard-links")
    release(sets)
    release(likely)
    return links


def near(a: str, b: str, percent: int) -> "F.Column":
    """Length and positional filters of two prefix entries with the same token."""
    return F.expr(f"""100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)
        and (least({a}.pos, {b}.pos) + 1 + least({a}.n - {a}.pos, {b}.n - {b}.pos) - 1) * {100 + percent}
            >= {percent} * ({a}.n + {b}.n)""")


def suffix_near(a: str, b: str, percent: int) -> "F.Column":
    """Suffix filter: each shingle that only one of two sets holds changes one part's parity, so the sets
    differ by at least as many shingles as they have parts of different parity; too many rule the pair out."""
    differ = " + ".join(f"bit_count({a}.bits[{i}] ^ {b}.bits[{i}])" for i in range(PARTS // 64))
    return F.expr(f"{differ} <= {a}.n + {b}.n - 2 * (({percent} * ({a}.n + {b}.n) + {99 + percent}) div {100 + percent})")


def jaccard_groups(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id.

    Words are maximal runs outside white space with A-Z lower-cased; a text with fewer than ``k``
    words is one shingle; a null, empty or blank text has none and is linked with nothing.  Two
    documents are linked when 100 * common >= percent * union, and the component is the smallest
    doc_id reachable by links.  Repeated rows are equal sets; a row without doc_id links to its
    equals and opens no component of its own; an empty table gives an empty result."""
    spark = docs.sparkSession
    prof, counts = profile(docs, k)
    classes = save(prof.where("n > 0 and doc_id is not null").groupBy("c1", "c2")
                   .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bits").alias("bits")), "jaccard-classes")
    # entries meet by token in one shuffle; tokens of one class alone are dropped before anything is written
    whole = Window.partitionBy("token")
    entries = (prefixes(rows_of(docs, classes), k, percent, spark.sparkContext.broadcast(counts))
               .select("*", F.min("c1").over(whole).alias("lo"), F.max("c1").over(whole).alias("hi")).where("lo <> hi").drop("lo", "hi"))
    open_ = save(entries.join(classes.select("c1", "node", "n"), "c1"), "jaccard-shared")
    # one hub for each token, chosen by a mask, so that a group of copies has many hubs
    masked = F.min(F.col("c1").bitwiseXOR(F.col("token"))).alias("h")
    hubs = (open_.groupBy("token").agg(masked).select("token", F.col("h").bitwiseXOR(F.col("token")).alias("c1"))
            .join(open_, ["token", "c1"]).groupBy("token").agg(F.min("node").alias("node"), F.min("n").alias("n"), F.min("pos").alias("pos")))
    star = (open_.alias("x").join(hubs.alias("y"), "token").where("x.node <> y.node").where(near("x", "y", percent))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    links = verified(docs, k, percent, by_suffix(star, classes, percent), classes)
    groups = components(links, "jaccard")
    # the exact round: all prefix pairs that no path joins yet
    split = open_.join(groups, "node", "left").select(
        "token", "node", "n", "pos", F.coalesce("component", "node").alias("component"))
    mixed = split.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rest = save(split.join(mixed.select("token"), "token").join(classes.select("node", "bits"), "node"), "jaccard-rest")
    cross = (rest.alias("x").join(rest.alias("y"), "token").where("x.component < y.component")
             .where(near("x", "y", percent)).where(suffix_near("x", "y", percent))
             .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    more = verified(docs, k, percent, cross, classes)
    release(open_)
    release(rest)
    if more.limit(1).count():
        groups = components(links.union(more), "jaccard")
    named = classes.select("c1", "c2", "node").join(groups, "node", "left").select(
        "c1", "c2", F.coalesce("component", "node").alias("component"))
    return prof.join(named, ["c1", "c2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"), k=3, percent=90)

