"""Exact ranked lexical search over sparse ball trees.

A document is a sparse vector of integer term scores; an item's score is its inner product with the
item's terms.  Each task cuts its documents into sets of bounded size and builds a ball tree over each:
a node is split between two far documents, down to small leaves, and holds its centroid, the radius
around it, and how far its documents reach in each single term.  With s terms in the item, no document
of a node scores above ``centroid * item + sqrt(s) * radius``, nor above the sum of its reach over the
item's terms; both are rounded up, and the lower one bounds the subtree.  Subtrees are taken best
first, and left when the bound is below the item's floor: the k-th best score so far, which starts
with that of a bounded sample of the documents.  Leaves are scored exactly in 64-bit integers.

Scores count terms by 64-bit hash.  Items go through in waves of bounded size."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import fixed_bitmap, flags, ordered_totals, read_table, save
from .wordhash import ALNUM, blocks, text_bytes, words

K = 50
#: terms of all items that one wave sends to the tasks
WAVE_TERMS = 8192
#: documents of a tree (4 bytes a document and term of the wave), and of a leaf
TREE_DOCS = 2048
LEAF_DOCS = 32
#: documents that are searched first, for the items' floors alone
FLOOR_DOCS = 16_384
#: bits of the map of item terms that thins the vectors
BITS = 22
#: a bound of doubles is raised by this share of itself, far more than rounding takes
SLACK = 1e-9
NO_ID = -(1 << 63)


def term_counts(texts: DataFrame, key: str, kept: np.ndarray | None = None) -> DataFrame:
    """(key, n, terms, tf): terms with repeats, and the hashes and counts of the distinct ones (of those
    whose first bits ``kept`` flags).  Terms are runs of letters, digits and non-ASCII bytes, A-Z folded."""
    schema = f"{key} long, n long, terms array<long>, tf array<int>"

    def count(batches):
        wanted = None if kept is None else flags(kept)
        for b in batches:
            data, offs = text_bytes(b.column(1))
            for lo, hi in blocks(offs):
                h, _, _, at = words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], ALNUM)
                doc = np.repeat(np.arange(hi - lo), np.diff(at))
                if wanted is not None:
                    keep = wanted[(h >> np.uint64(64 - BITS)).astype(np.int64)]
                    h, doc = h[keep], doc[keep]
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, bool))
                tf = np.diff(np.append(new, len(h)))
                cuts = pa.array(np.searchsorted(doc[new], np.arange(hi - lo + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(np.diff(at)), pa.ListArray.from_arrays(cuts, pa.array(h[new].view(np.int64))),
                     pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int32)))], names=[key, "n", "terms", "tf"])

    return texts.select(F.col(key).cast("long").alias(key), "text").mapInArrow(count, schema)


class Tree:
    """A ball tree over documents given as rows of (column, value); ``weights`` by column."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, cols: np.ndarray, values: np.ndarray, weights: np.ndarray):
        self.ids, self.cols, self.starts = ids, cols, starts
        self.weights = weights
        self.weighted = weights[cols].astype(np.float64) * values
        self.squares = np.add.reduceat(self.weighted ** 2, starts[:-1])
        self.order: list[np.ndarray] = []
        self.nodes: list[tuple[int, int]] = []            # children, or (-1, leaf number)
        self.centroids, self.reach, self.radius = [], [], []
        self.build(np.arange(len(ids)))
        self.centroids, self.reach, self.radius = np.array(self.centroids), np.array(self.reach), np.array(self.radius)
        place = np.concatenate(self.order)
        self.ends = np.cumsum([0, *map(len, self.order)])
        spot = np.empty(len(ids), np.int64)
        spot[place] = np.arange(len(ids))
        self.ids = ids[place]
        self.table = np.zeros((len(weights), len(ids)), np.int32)     # one row per term: a leaf is a slice
        self.table[cols, np.repeat(spot, np.diff(starts))] = values

    def entries(self, rows: np.ndarray):
        """Indexes of all entries of the rows, and where each row begins among them."""
        n = self.starts[rows + 1] - self.starts[rows]
        begins = np.cumsum(n) - n
        return np.repeat(self.starts[rows] - begins, n) + np.arange(int(n.sum())), begins

    def build(self, rows: np.ndarray) -> int:
        at, begins = self.entries(rows)
        cols, values, squares = self.cols[at], self.weighted[at], self.squares[rows]
        middle = np.bincount(cols, values, len(self.weights)) / len(rows)
        apart = lambda v: np.maximum(squares + v @ v - 2 * np.add.reduceat(values * v[cols], begins), 0)
        far = apart(middle)
        number = len(self.nodes)
        self.nodes.append((-1, len(self.order)))
        self.centroids.append(middle)
        # the squares cancel, so their rounding is raised before the root
        self.radius.append(math.sqrt(float(far.max()) + SLACK * (float(squares.max()) + float(middle @ middle))))
        self.reach.append(None)
        if len(rows) <= LEAF_DOCS:
            top = np.zeros(len(self.weights))
            np.maximum.at(top, cols, values)
            self.reach[number] = top
            self.order.append(rows)
            return number
        one = self.dense(rows[int(far.argmax())])
        to_one = apart(one)
        side = to_one - apart(self.dense(rows[int(to_one.argmax())]))
        left = side < 0
        if min(left.sum(), len(rows) - left.sum()) < LEAF_DOCS // 4:
            left = np.zeros(len(rows), bool)
            left[np.argsort(side, kind="stable")[:len(rows) // 2]] = True
        a, b = self.build(rows[left]), self.build(rows[~left])
        self.nodes[number] = a, b
        self.reach[number] = np.maximum(self.reach[a], self.reach[b])
        return number

    def dense(self, row: int) -> np.ndarray:
        out = np.zeros(len(self.weights))
        at = slice(self.starts[row], self.starts[row + 1])
        out[self.cols[at]] = self.weighted[at]
        return out

    def bounds(self, terms: list[np.ndarray], indicator: np.ndarray) -> np.ndarray:
        """The bound of each node (rows) for each item (columns)."""
        ball = self.centroids @ indicator + np.outer(self.radius, np.sqrt([len(t) for t in terms]))
        return np.minimum(ball, self.reach @ indicator) * (1 + SLACK) + 1

    def search(self, terms: np.ndarray, bounds: np.ndarray, best: "Best") -> int:
        """Offer the item's best documents; returns the leaves that were scored."""
        weights, scored, heap = self.weights[terms][:, None], 0, [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < best.floor:
                break
            a, b = self.nodes[node]
            if a >= 0:
                for child in (a, b):
                    if bounds[child] >= best.floor:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            lo, hi = self.ends[b], self.ends[b + 1]
            best.offer(self.ids[lo:hi], (self.table[terms, lo:hi] * weights).sum(0))
            scored += 1
        return scored


class Best:
    """The k best (score, id) of an item so far: higher scores first, then smaller ids."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, max(floor, 1)
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.floor
        if not good.any():
            return
        ids, scores = np.concatenate([self.ids, ids[good]]), np.concatenate([self.scores, scores[good]])
        top = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[top], scores[top]
        if len(top) == self.k:
            self.floor = max(self.floor, int(self.scores[-1]))


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _search(vectors: DataFrame, wave: list, vocabulary: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int,
            floors: dict[int, int], k: int, tree_docs: int) -> DataFrame:
    """(qno, doc_id, score): what each task finds for the wave's items, k rows an item at most."""
    sent = vectors.sparkSession.sparkContext.broadcast((wave, vocabulary, weights, floors))

    def search(batches):
        wave, vocabulary, weights, floors = sent.value
        terms = [t for _, t in wave]
        indicator = np.zeros((len(vocabulary), len(wave)))
        for i, t in enumerate(terms):
            indicator[t, i] = 1
        best = [Best(k, floors.get(q, 1)) for q, _ in wave]

        def flush(parts):
            ids, n, cols, values = (np.concatenate(x) for x in zip(*parts))
            tree = Tree(ids, np.concatenate([[0], np.cumsum(n)]), cols, values, weights)
            bounds = tree.bounds(terms, indicator)
            for i in np.argsort(-bounds[0]).tolist():
                tree.search(terms[i], bounds[:, i], best[i])

        parts, held = [], 0
        for b in batches:
            ids = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            length = b.column(1).to_numpy(zero_copy_only=False)
            lists, tf = b.column(2), b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            found = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            cols = np.searchsorted(vocabulary, found)
            cols[cols == len(vocabulary)] = 0
            known = np.flatnonzero(vocabulary[cols] == found)
            doc = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))[known]
            cols, tf = cols[known], tf[known]
            m = 50 + (50 * length * n_docs) // n_terms
            values = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
            rows, begins = np.unique(doc, return_index=True)
            sizes = np.diff(np.append(begins, len(doc)))
            for lo in range(0, len(rows), tree_docs):
                hi = min(lo + tree_docs, len(rows))
                at = slice(begins[lo], begins[hi] if hi < len(rows) else len(doc))
                parts.append((ids[rows[lo:hi]], sizes[lo:hi], cols[at], values[at]))
                held += hi - lo
                if held >= tree_docs:
                    flush(parts)
                    parts, held = [], 0
        if parts:
            flush(parts)
        sizes = [len(x.ids) for x in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([q for q, _ in wave], sizes)), pa.array(np.concatenate([x.ids for x in best])),
                 pa.array(np.concatenate([x.scores for x in best]))], names=["qno", "doc_id", "score"])

    return vectors.mapInArrow(search, "qno long, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qno").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, wave_terms: int = WAVE_TERMS, tree_docs: int = TREE_DOCS,
                  floor_docs: int = FLOOR_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` highest scores above 0 of each row of ``items``
    (item_id, text) over all rows of ``docs`` (doc_id, text), ties to the smaller doc_id.

    Each row of ``docs`` is a document and each row of ``items`` an item, also where ids repeat or are
    null; a null doc_id comes first among ties.  Texts without terms (null, empty, marks only) match
    nothing; items without a match have no rows, nor has an empty table.  Other columns are not read.

    Counts are taken over all documents.  ``floor_docs`` documents, by hash, are searched first; that
    sets where the search of all documents starts to prune, never what it finds.  Memory of a task:
    one document's terms, and 4 bytes for each of ``tree_docs`` documents and of the wave's terms
    (``wave_terms``, or those of one longer item)."""
    spark = docs.sparkSession
    numbered = save(ordered_totals(items.select("item_id", "text"), ["item_id", "text"], [], "items").withColumnRenamed("__row_no", "qno"), "items")
    asked = save(term_counts(numbered, "qno").where("n > 0"), "item-terms")
    wanted = asked.select(F.explode("terms").alias("term")).distinct()
    kept = fixed_bitmap(wanted, F.col("term"), BITS)
    vectors = save(term_counts(docs, "doc_id", kept).where("n > 0"), "vectors")
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    waves = ordered_totals(asked.select("qno", "terms", F.size("terms").alias("size")), ["qno"], ["size"], "waves")
    waves = save(waves.withColumn("wave", F.floor(F.col("__before_size") / wave_terms)), "item-waves")
    weighted = save(waves.select("wave", F.explode("terms").alias("term")).distinct().join(counts, "term"), "item-df")
    found = None
    for (wave,) in waves.select("wave").distinct().orderBy("wave").collect():      # wave_terms terms each
        known = weighted.where(F.col("wave") == wave).select("term", "df").toArrow()
        if not known.num_rows:
            continue
        vocabulary = known.column(0).to_numpy().view(np.uint64)
        order = np.argsort(vocabulary)
        vocabulary = vocabulary[order]
        weights = np.array([term_weight(n_docs, int(df)) for df in known.column(1).to_numpy()[order]], np.int64)
        batch = []
        for r in waves.where(F.col("wave") == wave).select("qno", "terms").collect():
            t = np.array(r["terms"], np.int64).view(np.uint64)
            spot = np.minimum(np.searchsorted(vocabulary, t), len(vocabulary) - 1)
            spot = spot[vocabulary[spot] == t]
            if len(spot):
                batch.append((r["qno"], spot))
        args = batch, vocabulary, weights, n_docs, n_terms
        every = max(1, n_docs // floor_docs)
        sample = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(every)) == 0)
        floors = {r["qno"]: r["score"] for r in _top(_search(sample, *args, {}, k, tree_docs), k).where(F.col("rank") == k).collect()}
        part = save(_search(vectors, *args, floors, k, tree_docs), "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "qno long, doc_id long, score long")
    return (_top(found, k).join(numbered.select("qno", "item_id"), "qno")
            .select(F.col("item_id").cast("long").alias("item_id"), F.col("rank").cast("int").alias("rank"),
                    F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
with d as (
  select row_number() over () as dno, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
i as (
  select row_number() over () as qno, item_id, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
c as (select count(*)::bigint as n_docs, sum(len(t))::bigint as n_terms from d where len(t) > 0),
q as (select qno, item_id, unnest(t) as term from i),
p as (
  select dno, doc_id, term, count(*)::bigint as tf, any_value(n)::bigint as n
  from (select dno, doc_id, len(t) as n, unnest(t) as term from d) where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from p, c group by term, n_docs),
s as (
  select qno, item_id, dno, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * n_docs) // n_terms)))))::bigint as score
  from q join p using (term) join w using (term), c group by all),
r as (select *, row_number() over (partition by qno order by score desc, doc_id nulls first) as rank from s where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 50
"""
