"""Mixing sources to target weights with hash-threshold histograms.

Every document has a hash that depends on its content only.  Word counts are
summed by (source, leading hash digits); a running sum over that bounded
histogram finds the one bucket in which a source's budget ends, only that
bucket is refined by the next digits, and so on until it holds a single hash.
A document is then taken by comparing its hash with its source's threshold:
no sort of documents, one map-side-combined aggregate per level.

Defined results: a null source is a source of its own (last in order); a null
or empty text has size 0 and is never taken; rows equal in id and text share a
hash, so they are taken together; an empty table gives no rows and no sources;
very long texts are counted whole; extra columns pass through untouched (helper columns avoid clashing names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD_RUN, free_name, maybe_broadcast, written

# --- fixed values: source weights in order, budget share, repeat limit ----------
WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2

HEX_DIGITS = 32          # of an md5 digest
LEVEL_DIGITS = 3         # digits refined per level: 4096 buckets a source
SOURCES_BROADCAST = 100_000   # source rows broadcast at most


def doc_size(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RUN)).cast("long"), F.lit(0).cast("long"))


def doc_hash(doc_id: Column, text: Column) -> Column:
    """32 hex digits of id and text: stable over reruns and partitionings."""
    none = F.lit("")
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), none), F.lit("|"), F.coalesce(text, none)))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = BUDGET_SHARE,
                   epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, size)`` rows -> one row per source: its size, weight, target
    (doubles), whole rounds ``base`` and the rest of its budget ``rest``.

    With every source stopped at ``epochs`` times its size, the common level
    ``x`` solves sum(min(x * weight, epochs * size)) = budget.  Any guess at
    the stopped set bounds it from below, and the right set (a prefix of the
    sources by epochs * size / weight) attains it: ``x`` is the largest of
    (budget - caps of the first k) / (weights of the others).
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (by_source
         .withColumn("weight", F.get(w, (F.row_number().over(order) - 1) % len(weights)))
         .withColumn("cap", F.col("source_size") * float(epochs)))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest_w = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(0))
    s = (s.withColumn("budget", F.sum("source_size").over(everything) * float(share))
         .withColumn("level", (F.col("budget") - before) / rest_w)
         .withColumn("level", F.max("level").over(everything))
         .withColumn("target", F.least(F.col("cap"), F.col("level") * F.col("weight"))))
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (s.withColumn("base", base.cast("long"))
            .withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
            .select("source", "source_size", "weight", "target", "base", "rest"))


def thresholds(sized: DataFrame, targets: DataFrame, digits: int = LEVEL_DIGITS) -> DataFrame:
    """Adds to each source the hash ``cut`` at which its ``rest`` ends and
    ``with_cut``: whether the documents of that very hash are taken too (they
    are if that comes nearer to the target).  Nested refinement: level k sums
    words by the first k * digits digits inside the boundary bucket of level
    k - 1 only."""
    n_sources = targets.count()
    state = targets.select("source", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("acc"),
                           F.lit(0).cast("long").alias("at"), F.lit(False).alias("single"))
    for length in range(digits, HEX_DIGITS + digits, digits):
        rows = sized.alias("d").join(
            maybe_broadcast(state.where(~F.col("single")), n_sources, SOURCES_BROADCAST).alias("s"),
            F.col("d.source").eqNullSafe(F.col("s.source")) & F.col("d.hash").startswith(F.col("s.prefix")))
        level = (rows.groupBy(F.col("s.source").alias("source"), "rest", "acc",
                              F.substring("d.hash", 1, min(length, HEX_DIGITS)).alias("bucket"))
                 .agg(F.sum("d.size").alias("words"), F.min("d.hash").alias("lo"), F.max("d.hash").alias("hi")))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        level = level.withColumn("upto", F.col("acc") + F.sum("words").over(run))
        ends = (level.where(F.col("upto") > F.col("rest"))
                .groupBy("source", "rest")
                .agg(F.min_by(F.struct("bucket", "upto", "words", "lo", "hi"), "bucket").alias("b"))
                .select("source", "rest", F.col("b.bucket").alias("prefix"),
                        (F.col("b.upto") - F.col("b.words")).alias("acc"), F.col("b.words").alias("at"),
                        (F.col("b.lo") == F.col("b.hi")).alias("single"),
                        F.when(F.col("b.lo") == F.col("b.hi"), F.col("b.lo")).alias("cut")))
        done = state.where("single") if length > digits else None
        state = written(ends if done is None else ends.unionByName(done), "mix-level")
        if state.where(~F.col("single")).isEmpty():
            break
    near = (F.col("acc") + F.col("at") - F.col("rest")) < (F.col("rest") - F.col("acc"))
    cuts = state.select(F.col("source").alias("cut_source"), "cut", near.alias("with_cut"))
    return (targets.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
            .drop("cut_source"))


def times_taken(size: Column, hash_: Column, base: Column, cut: Column, with_cut: Column) -> Column:
    """How often a document is taken: the whole rounds of its source, once more
    below the threshold; 0 for documents without words."""
    more = F.when(cut.isNull(), False).otherwise((hash_ < cut) | ((hash_ == cut) & with_cut))
    return F.when(size > 0, base + more.cast("long")).otherwise(F.lit(0).cast("long"))


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights=WEIGHTS, share: float = BUDGET_SHARE, epochs: int = MAX_EPOCHS) -> tuple[DataFrame, DataFrame]:
    """``(sized, cuts)``: the narrow table (doc_id, source, size, hash) of all
    documents, written once, and the per-source targets and thresholds."""
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                                doc_size(F.col(text)).alias("size"),
                                doc_hash(F.col(doc_id), F.col(text)).alias("hash")), "mix-sized")
    targets = written(source_targets(sized, weights, share, epochs), "mix-targets")
    return sized, written(thresholds(sized, targets), "mix-cuts")


def taken_words(docs: DataFrame, **kw) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized, cuts = plan_mix(docs, **kw)
    cuts_b = maybe_broadcast(cuts, cuts.count(), SOURCES_BROADCAST).alias("c")
    j = sized.alias("d").join(cuts_b, F.col("d.source").eqNullSafe(F.col("c.source")))
    times = times_taken(F.col("size"), F.col("hash"), F.col("base"), F.col("cut"), F.col("with_cut"))
    return j.select("doc_id", F.col("d.source").alias("source"), "size", "source_size", "target",
                    (F.col("size") * times).alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    **kw) -> DataFrame:
    """The documents of the mix with their own columns: a document taken twice
    is there twice, one not taken is absent."""
    _, cuts = plan_mix(docs, doc_id, text, source, **kw)
    own = [free_name(docs.columns, c) for c in ("cut_source", "cut_base", "cut_hash", "cut_with", "mix_times")]
    src, base, cut, with_cut, times = own
    cuts = cuts.select(F.col("source").alias(src), F.col("base").alias(base), F.col("cut").alias(cut),
                       F.col("with_cut").alias(with_cut))
    j = docs.join(maybe_broadcast(cuts, cuts.count(), SOURCES_BROADCAST),
                  F.col(source).cast("string").eqNullSafe(F.col(src)))
    n = times_taken(doc_size(F.col(text)), doc_hash(F.col(doc_id), F.col(text)),
                    F.col(base), F.col(cut), F.col(with_cut))
    return (j.withColumn(times, n.cast("int")).where(F.col(times) > 0)
            .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*docs.columns))
