"""SimHash near-duplicates by a self-join of a binary trie.

Equal fingerprints are one trie leaf (grouped with a map-side combine, so a
huge group of copies is one row).  The self-join walks pairs of trie nodes of
equal depth together, starting from (root, root): the children of a pair
inherit its differing bits plus those of their own labels, and a pair beyond
the error budget is dropped with everything below it.  As long as a node of a pair
has more than ``LEAF`` fingerprints, Spark joins the pair with its children
(two bits a step); then the pair's two small subtries are
walked the same way inside a task.  A crowded prefix therefore just goes deeper: no
node is too large for a task, and no candidate is dropped.

A task returns only a spanning forest of the links it found, which keeps every
component and never all pairs of a group.  Components give each document the
smallest doc_id that it can reach.

Defined results: texts without words (null, empty, blank) have fingerprint
zero; 1 to k-1 words are one shingle; very long texts count whole; repeated rows link like copies; null
doc_ids take part but never name a component, unless it has no other; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import byte_words, free_name, written
from .components import connected_components

# --- fixed values: shingle length, seed, error budget ---------------------------
SHINGLE = 3
SEED = 42
MAX_BITS = 2

LEAF = 1024            # fingerprints of a node that a task walks
STEP = 2               # bits per step of the distributed walk
LOCAL_STEP = 4         # bits per step inside a task
KEYS_BROADCAST = 1_000_000


def fingerprint(words: list[bytes], k: int = SHINGLE) -> int:
    """64-bit SimHash of all k-word shingles, repeats included."""
    if not words:
        return 0
    if len(words) < k:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = 2 * ones > len(h)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document; fp as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(byte_words(t.as_py()), k) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                        F.col(text).alias("text"))
            .mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint"))


def _prefix(col, depth: int):
    """The first ``depth`` bits as a number."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(col, 64 - depth)


def node_pairs(points: DataFrame, n: int, max_bits: int = MAX_BITS, leaf: int = LEAF):
    """Walks pairs of trie nodes from the root; yields (depth, pairs) with pairs
    (a, b, diff), a <= b, whose nodes both have at most ``leaf`` fingerprints."""
    spark = points.sparkSession
    pairs = spark.createDataFrame([(0, 0, 0)], "a long, b long, diff int")
    depth = 0
    aim = min(62, max(0, math.ceil(math.log2(max(1, n) / (leaf / 4)))))   # where even nodes are small
    while True:
        while depth < aim:
            depth += STEP
            nodes = points.groupBy(_prefix(F.col("fp"), depth).alias("c")).agg(F.count(F.lit(1)).alias("n"))
            nodes = nodes.withColumn("p", F.shiftrightunsigned("c", STEP))
            one = nodes.select(F.col("p").alias("pa"), F.col("c").alias("ca"), F.col("n").alias("na"))
            two = nodes.select(F.col("p").alias("pb"), F.col("c").alias("cb"), F.col("n").alias("nb"))
            diff = (F.col("diff") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << STEP) - 1)))).cast("int")
            pairs = (pairs.join(one, F.col("a") == F.col("pa")).join(two, F.col("b") == F.col("pb"))
                     .withColumn("diff", diff).where((F.col("diff") <= max_bits) & (F.col("ca") <= F.col("cb")))
                     .select(F.col("ca").alias("a"), F.col("cb").alias("b"), "diff", "na", "nb"))
            pairs = written(pairs, "trie-pairs")
            if depth < aim:
                pairs = pairs.drop("na", "nb")
        if depth == 0:
            yield 0, pairs
            return
        small = F.greatest("na", "nb") <= leaf
        yield depth, pairs.where(small).select("a", "b", "diff")
        pairs = pairs.where(~small).select("a", "b", "diff")
        if depth >= 64 or pairs.isEmpty():
            return
        aim = depth + STEP


def close_pairs(a: np.ndarray, b: np.ndarray, depth: int, diff: int, same: bool, max_bits: int = MAX_BITS):
    """Indices (i, j) of fingerprints of two sorted subtries within the budget,
    by a simultaneous walk, LOCAL_STEP bits at a time."""
    def tree(x):
        """Per depth: start of every node, label of its last bits, range of its children."""
        levels, starts = [], np.array([0])
        for d in range(depth, 64, LOCAL_STEP):
            width = min(LOCAL_STEP, 64 - d)
            key = x >> np.uint64(64 - d - width)
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            labels = (key[new] & np.uint64((1 << width) - 1)).astype(np.int64)
            first = np.searchsorted(new, starts)
            last = np.append(first[1:], len(new))
            levels.append((first, last - first, labels))
            starts = new
        return levels, starts

    ta, sa = tree(a)
    tb, sb = tree(b)
    pi, pj, pd = np.array([0]), np.array([0]), np.array([diff])
    for (fa, na, la), (fb, nb, lb) in zip(ta, tb, strict=True):
        ca, cb = na[pi], nb[pj]
        each = ca * cb
        at = np.repeat(np.arange(len(pi)), each)
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        i, j = fa[pi[at]] + nth // cb[at], fb[pj[at]] + nth % cb[at]
        d = pd[at] + np.bitwise_count(la[i] ^ lb[j])
        ok = d <= max_bits
        if same:
            ok &= i <= j
        pi, pj, pd = i[ok], j[ok], d[ok]
    ends = sa[pi], sb[pj]
    if same:
        off = ends[0] != ends[1]
        return ends[0][off], ends[1][off]
    return ends


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each index's component under the links (i, j)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, low[i], m)
        np.minimum.at(new, low[j], m)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, low):
            return low
        low = new


def near_links(points: DataFrame, n: int, max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """(a, b): links between distinct fingerprints that span every component of
    the relation "at most max_bits bits differ".  ``points``: distinct fp."""
    def walk(batches, depth):
        for b in batches:
            out_a, out_b = [], []
            for a_ids, b_ids, same, diff in zip(b.column(0), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                x = np.sort(a_ids.values.to_numpy().view(np.uint64))
                y = x if same else np.sort(b_ids.values.to_numpy().view(np.uint64))
                i, j = close_pairs(x, y, depth, diff, same, max_bits)
                if not len(i):
                    continue
                both = x if same else np.concatenate([x, y])
                low = forest(i, j if same else j + len(x), len(both))
                moved = np.flatnonzero(low != np.arange(len(both)))
                out_a.append(both[low[moved]].view(np.int64))
                out_b.append(both[moved].view(np.int64))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    links = None
    for depth, pairs in node_pairs(points, n, max_bits, leaf):
        # only nodes of this depth that are in a pair: small by construction
        nodes = (points.groupBy(_prefix(F.col("fp"), depth).alias("node"))
                 .agg(F.count(F.lit(1)).alias("n"), F.collect_list("fp").alias("fps")) if depth == 0 else
                 points.withColumn("node", _prefix(F.col("fp"), depth))
                 .join(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "node", "left_semi")
                 .groupBy("node").agg(F.collect_list("fp").alias("fps")))
        one = nodes.select(F.col("node").alias("a"), F.col("fps").alias("fa"))
        two = nodes.select(F.col("node").alias("b"), F.col("fps").alias("fb"))
        rows = (pairs.join(one, "a").join(two, "b")
                .select("fa", "fb", (F.col("a") == F.col("b")).alias("same"), "diff"))
        part = rows.mapInArrow(lambda it, d=depth: walk(it, d), "a bigint, b bigint")
        links = part if links is None else links.unionAll(part)
    return links


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
                max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, group (smallest fingerprint of
    its component) and component_id (smallest doc_id of it)."""
    fps = written(fingerprints(docs, doc_id, text, k), "fingerprints")
    points = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "points")
    links = near_links(points.select("fp"), points.count(), max_bits, leaf)
    comp = connected_components(links).select(F.col("vertex").alias("fp"), F.col("component").alias("group"))
    of = points.join(comp, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    lows = of.groupBy("group").agg(F.min("low").alias("component_id"))
    named = of.join(lows, "group").select("fp", "group", "component_id")
    return fps.join(named, "fp").select("doc_id", "text_hash", "fp", "group", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The documents without near-duplicates: of each group the one with the
    smallest doc_id (for equal ids the smallest text hash, of identical rows one)."""
    groups = written(near_groups(docs, doc_id, text, **kw), "groups")
    first = (groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"), F.count(F.lit(1)).alias("n"))
             .select(F.col("k.doc_id").alias("doc_id"), F.col("k.text_hash").alias("text_hash"), "n"))
    first = written(first, "group-heads")
    key_id, key_hash, many = (free_name(docs.columns, c) for c in ("head_id", "head_hash", "head_rows"))
    heads = first.select(F.col("doc_id").alias(key_id), F.col("text_hash").alias(key_hash), F.col("n").alias(many))

    def kept(heads, rows):
        heads = F.broadcast(heads) if rows <= KEYS_BROADCAST else heads.hint("shuffle_hash")
        return docs.join(heads, F.col(doc_id).cast("long").eqNullSafe(F.col(key_id)) & (F.xxhash64(F.col(text)) == F.col(key_hash)), "left_semi")

    single = kept(heads.where(F.col(many) == 1), first.where("n = 1").count())
    repeats = first.where("n > 1").count()
    if repeats == 0:
        return single.select(*docs.columns)
    again = kept(heads.where(F.col(many) > 1), repeats)
    return single.unionAll(again.dropDuplicates([doc_id, text])).select(*docs.columns)
