"""Vector compression by product codes, learned and applied over a trie of parts.

Every vector becomes integers (floor of ``SCALE`` times a component) and is cut into ``PARTS``
consecutive parts; each part position has a codebook of up to ``ENTRIES`` integer entries.
Spark counts the *distinct* parts of every position once (copies collapse before the
shuffle) and writes them in lexicographic order.  A run of that order is a trie over the
dimensions, walked depth first: a node carries the vector of squared distances
accumulated so far to all entries, every child adds one dimension to its parent's vector, and so
parts with a common prefix share its sums.  A leaf takes the argmin and adds its part, times
its number of occurrences, to the sums of that entry.  The walk takes a block of leaves at a
time; the stack of accumulated vectors along the last leaf's path goes on to the next block.

A round reads the distinct parts in parallel, returns at most one partial row per task and entry, and
Spark adds the partials; the driver holds codebooks only (parts x entries integers).
The last assignment walks the parts of the vectors themselves, batch by batch, without a shuffle.

Defined results: rows whose vector is null, or holds a null, NaN or infinite component, are
dropped, and so are vectors of another length than that of the first kept row (by id); a
length that does not divide by the number of parts gives parts that differ by one
component.  Repeated rows each give a row and count each; null ids come last;
fewer kept rows than entries give that many entries; ties go to the lower index; null labels are
one label; an empty table (or only dropped rows) gives no rows; extra columns are ignored.
Components beyond +-2^24 after scaling are computed with unbounded integers (beyond a long they stay at
its ends), errors beyond a long stay at the largest long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import maybe_broadcast, written

# --- fixed values: scale, parts, entries and rounds of the contract --------------------
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

BLOCK = 8192                # leaves walked at a time
EXACT_LONG = 1 << 24        # components up to this size: sums of squares fit a long
FLUSH = 1 << 31             # weight after which partial sums leave int64 for unbounded integers
LABELS_BROADCAST = 200_000
LONG_MAX = (1 << 63) - 1


def cuts(dims: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """(start, end) of consecutive parts, equal where ``dims`` divides by ``parts``."""
    return [(dims * i // parts, dims * (i + 1) // parts) for i in range(parts)]


class TrieWalk:
    """Depth-first walk over sorted parts of one position, by blocks of leaves."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries                      # (k, d)
        self.last = None                            # the last leaf of the block before
        self.stack: list[np.ndarray] = []           # accumulated vectors along its path

    def block(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of every row of (n, d)."""
        n, d = rows.shape
        if d == 0:
            return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=rows.dtype)
        # new[i, j]: row i starts a node at depth j + 1 that the row before does not lie in
        differs = np.empty((n, d), dtype=bool)
        differs[1:] = rows[1:] != rows[:-1]
        differs[0] = rows[0] != self.last if self.last is not None else True
        new = np.logical_or.accumulate(differs, axis=1)
        carried = self.stack if self.last is not None else [None] * d
        above, kept, stack = None, None, []
        for j in range(d):
            at = np.flatnonzero(new[:, j])
            gap = rows[at, j][:, None] - self.entries[None, :, j]
            step = gap * gap
            if j:
                step += above[kept[at]]
            # node 0 of a level is the node that the last block ended in, if there is one
            level = step if carried[j] is None else np.concatenate([carried[j][None], step])
            kept = np.cumsum(new[:, j]) - (carried[j] is None)
            above = level
            stack.append(level[kept[-1]])
        self.last, self.stack = rows[-1], stack
        near = above.argmin(axis=1)
        found = above[np.arange(len(above)), near]
        return near[kept], found[kept]


def nearest(parts: np.ndarray, entries: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row of ``parts``, in any order: its distinct rows are sorted and walked."""
    if parts.shape[1] == 0:
        return np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=parts.dtype)
    order = np.lexsort(parts.T[::-1]) if parts.dtype != object else np.array(sorted(range(len(parts)), key=lambda i: tuple(parts[i])), dtype=np.int64)
    walk = TrieWalk(entries)
    entry = np.empty(len(parts), dtype=np.int64)
    dist = np.empty(len(parts), dtype=parts.dtype)
    for i in range(0, len(parts), block):
        at = order[i:i + block]
        entry[at], dist[at] = walk.block(parts[at])
    return entry, dist


def _integers(column, width: int) -> np.ndarray:
    """(n, width) integers of an Arrow list column; unbounded ones if a sum of squares might not fit."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64, copy=False)
    if flat.size and max(int(flat.max()), -int(flat.min())) > EXACT_LONG:
        return flat.astype(object)
    return flat


def _fit(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Entries in the number type that the rows and they need."""
    if rows.dtype == object or (entries.size and max(int(entries.max()), -int(entries.min())) > EXACT_LONG):
        return entries.astype(object)
    return entries.astype(np.int64)


def kept_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v): the vectors that take part, as scaled integers (longs)."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return (vectors.where(v.isNotNull() & ~F.coalesce(bad, F.lit(False)))
            .select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                    F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v")))


def distinct_parts(kept: DataFrame, dims: int, parts: int = PARTS) -> DataFrame:
    """(position, part, n): the distinct parts of every position with their occurrences, in
    lexicographic order within each file."""
    cut = F.array(*[F.struct(F.lit(i).alias("position"), F.slice("v", lo + 1, hi - lo).alias("part"))
                    for i, (lo, hi) in enumerate(cuts(dims, parts))])
    return (kept.select(F.explode(cut).alias("c")).select("c.position", "c.part")
            .groupBy("position", "part").agg(F.count(F.lit(1)).alias("n"))
            .sortWithinPartitions("position", "part"))


def _assign_parts(batches, books: list[np.ndarray]):
    """Partial sums (position, entry, dim, sum, n) of the parts assigned to every entry."""
    sums: dict[tuple[int, int], list] = {}
    walk, at_position = None, None
    for b in batches:
        position = b.column(0).to_numpy()
        weight = b.column(2).to_numpy().astype(np.int64)
        edges = np.flatnonzero(np.diff(position)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(position)]):
            if lo == hi:
                continue
            p = int(position[lo])
            rows = _integers(b.column(1).slice(lo, hi - lo), books[p].shape[1])
            entries = _fit(rows, books[p])
            if walk is None or at_position != p or walk.entries.dtype != entries.dtype:
                walk, at_position = TrieWalk(entries), p
            for i in range(0, hi - lo, BLOCK):
                some = rows[i:i + BLOCK]
                w = weight[lo + i:lo + i + len(some)]
                entry, _ = walk.block(some)
                if int(w.sum()) > FLUSH or some.dtype == object:
                    some, w = some.astype(object), w.astype(object)
                weighted = some * w[:, None]
                for e in np.unique(entry).tolist():
                    mine = entry == e
                    have = sums.setdefault((p, e), [[0] * some.shape[1], 0])
                    have[0] = [a + int(s) for a, s in zip(have[0], weighted[mine].sum(axis=0))]
                    have[1] += int(w[mine].sum())
    rows = [(p, e, d, str(s), n) for (p, e), (total, n) in sums.items() for d, s in enumerate(total)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
            zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()))], names=["position", "entry", "dim", "total", "n"])


def one_round(parts: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one assignment of all parts; unused entries stay."""
    given = parts.sparkSession.sparkContext.broadcast(books)
    schema = "position int, entry int, dim int, total string, n bigint"
    partial = parts.mapInArrow(lambda batches: _assign_parts(batches, given.value), schema)
    # at most parts x entries x dimensions rows
    added = (partial.groupBy("position", "entry", "dim")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    given.unpersist()
    out = [b.copy() for b in books]
    for r in added:
        out[r["position"]][r["entry"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def first_books(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> tuple[list[np.ndarray], int]:
    """(codebooks, dims): every position's part of the first kept rows; none if there are no rows."""
    head = [r["v"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()]
    if not head:
        return [], 0
    dims = len(head[0])
    first = [r["v"] for r in kept.where(F.size("v") == dims).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    return [np.array([v[lo:hi] for v in first], dtype=np.int64).reshape(len(first), hi - lo) for lo, hi in cuts(dims, parts)], dims


def books_text(books: list[np.ndarray]) -> str:
    """All integers of the codebooks by position, entry and dimension, comma-joined."""
    return ",".join(str(int(x)) for b in books for row in b for x in row)


def encoded(kept: DataFrame, books: list[np.ndarray], dims: int) -> DataFrame:
    """(vec_id, label, code, error): two hex digits per part, and the squared distances' sum."""
    given = kept.sparkSession.sparkContext.broadcast(books)
    spans = cuts(dims, len(books))

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            rows = _integers(b.column(2), dims)
            total = np.zeros(len(rows), dtype=rows.dtype)
            codes = []
            for book, (lo, hi) in zip(given.value, spans):
                mine = rows[:, lo:hi]
                entries = _fit(mine, book)
                entry, dist = nearest(mine.astype(entries.dtype, copy=False), entries)
                codes.append(entry)
                total = total + dist
            hexes = np.array(codes, dtype=np.uint8).T.copy()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([h.tobytes().hex() for h in hexes], pa.string()),
                 pa.array([min(int(t), LONG_MAX) for t in total], pa.int64())], names=["vec_id", "label", "code", "error"])

    types = dict(kept.dtypes)
    return kept.mapInArrow(run, f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error, label_error), codebooks): one row per kept vector."""
    kept = written(kept_vectors(vectors, vec_id, vector, label), "vectors")
    books, dims = first_books(kept, parts, entries)
    kept = kept.where(F.size("v") == dims) if books else kept.limit(0)
    if books and dims:
        table = written(distinct_parts(kept, dims, parts), "distinct-parts")
        for _ in range(rounds):
            books = one_round(table, books)
    coded = written(encoded(kept, books, dims), "codes")
    by_label = (coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("e"))
                .select(F.col("label").alias("of_label"), F.least("e", F.lit(LONG_MAX)).cast("long").alias("label_error")))
    by_label = written(by_label, "label-errors")
    by_label = maybe_broadcast(by_label, by_label.count(), LABELS_BROADCAST)
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label"), books


def codes(vectors: DataFrame, **kw) -> DataFrame:
    """vec_id, code, error, label_error and the digest of the codebooks, one row per kept vector."""
    out, books = compress(vectors, **kw)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
