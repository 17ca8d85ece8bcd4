"""Benchmark decontamination by a distributed positional inverted index.

Test items are cut into windows of 13 consecutive words (an item of fewer words is one
window).  Per window the (up to) three rarest terms, by their occurrences in
the training documents, are its anchors.  The index stores the postings of
all anchor terms: (row, term, position, the words around it).  Lookup shifts every
posting of an anchor by its offset in the item and intersects the shifted lists of each window,
rarest first:

* all shifted positions equal, and the stored neighbourhood of the rarest spells the window:
  an exact phrase match,
* all within ``SLACK`` words of the rarest: a proximity match.

A row can match an item only if it has enough of the item's anchors; that is tested first, by
one aggregate over the shifted postings, and removes nearly all chance meetings.

Everything is DataFrame expressions.  Documents are read twice (term counts, postings)
and their texts are never shuffled; the index holds rare terms only.
Term and window tables are broadcast up to a counted size; more anchor terms are indexed in
blocks of that size, more windows are joined by a shuffle.

Defined results: null and empty texts have no words, items without words no
windows; a null item id counts as the empty string; repeated rows each get a
row; very long texts are indexed whole; repeated items count once per id; an empty table gives no rows (no items: no hits); extra
columns are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_lower, free_name, maybe_broadcast, written

# --- fixed values: word class, window length, contamination share ----------------
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
HIT_SHARE = 20          # contaminated if at least one word in 20 is hit

ANCHORS = 3
SLACK = 5
TERMS_BROADCAST = 1_000_000
WINDOWS_BROADCAST = 100_000
KEYS_BROADCAST = 1_000_000


def word_array(text: Column) -> Column:
    """Words of the A-Z-lower-cased text; empty for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def item_classes(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(cls, words, ids): the distinct word sequences of all items with their sorted distinct ids."""
    return (items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), word_array(F.col(text)).alias("words"))
            .where(F.size("words") > 0).groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("ids"))
            .select(F.monotonically_increasing_id().alias("cls"), "words", "ids"))


def windows_of(classes: DataFrame, length: int = WINDOW) -> DataFrame:
    """(cls, at, len, words): the windows of every item class; ``at`` counts from 0."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - length, F.lit(0)))
    return (classes.select("cls", "words", F.explode(starts).alias("at"))
            .select("cls", "at", F.slice("words", F.col("at") + 1, length).alias("words")).withColumn("len", F.size("words")))


def term_counts(docs: DataFrame, terms: DataFrame, n_terms: int, text: str = "text") -> DataFrame:
    """(term, df): occurrences in ``docs`` of the given distinct terms; terms that do
    not occur are absent."""
    tokens = docs.select(F.explode_outer(word_array(F.col(text))).alias("token"))
    if n_terms <= TERMS_BROADCAST:
        tokens = tokens.join(F.broadcast(terms), F.col("token") == F.col("term"))
        return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return counted.join(terms, F.col("token") == F.col("term")).select("term", "df")


def anchored(windows: DataFrame, df: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """(cls, at, len, a): windows whose terms all occur in the documents, with their rarest terms as
    (df, off, term), rarest first, ties by offset; ``off`` counts from the item's start."""
    t = windows.select("cls", "at", "len", F.posexplode("words").alias("off", "term"))
    return (t.join(df, "term").groupBy("cls", "at", "len")
            .agg(F.sort_array(F.collect_list(F.struct("df", (F.col("off") + F.col("at")).alias("off"), "term"))).alias("a"))
            .where(F.size("a") == F.col("len")).select("cls", "at", "len", F.slice("a", 1, anchors).alias("a")))


def index_postings(docs: DataFrame, terms: DataFrame, n_terms: int, doc_id: str = "doc_id", text: str = "text",
                   around: int = WINDOW - 1) -> DataFrame:
    """The stored index: (row, doc_id, text_hash, n_words, term, pos, lead, near) for every
    occurrence of ``terms``; ``near`` has the words from ``lead`` before it to ``around`` behind
    it.  Every document also has one posting of the empty term, at position -1."""
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                    F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    blocks = -(-max(n_terms, 1) // TERMS_BROADCAST)
    if blocks > 1:
        d = written(d, "index-docs")
    d = d.select("row", "doc_id", "text_hash", F.concat(F.array(F.lit("")), word_array(F.col("text"))).alias("words"))
    tokens = d.select("row", "doc_id", "text_hash", "words", F.posexplode_outer("words").alias("at", "token"))
    out = None
    for b in range(blocks):
        # the empty term marks the document itself
        some = terms.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b) if blocks > 1 else terms
        some = some.unionAll(docs.sparkSession.createDataFrame([("",)], "term string")) if b == 0 else some
        p = tokens.join(F.broadcast(some), F.col("token") == F.col("term"))
        lead = F.least(F.col("at") - 1, F.lit(around))
        near = F.when(F.col("at") > 0, F.slice("words", F.col("at") + 1 - lead, lead + 1 + around))
        p = p.select("row", "doc_id", "text_hash", F.when(F.col("at") == 0, F.size("words") - 1).cast("long").alias("n_words"),
                     "term", (F.col("at") - 1).cast("long").alias("pos"), lead.alias("lead"), near.alias("near"))
        out = p if out is None else out.unionAll(p)
    return written(out, "postings")


def shifted(postings: DataFrame, windows: DataFrame, classes: DataFrame, n_windows: int) -> DataFrame:
    """(row, cls, off, pos, start, left, right): postings of the anchors, shifted to where the item would
    start, with the number of neighbouring words on both sides that agree with the item.  Rows with too few
    of an item's anchors for any of its windows are left out."""
    anchors = (windows.select("cls", F.size("a").alias("lists"), F.explode("a").alias("x"))
               .groupBy("cls", "x.off", "x.term").agg(F.min("lists").alias("need"))
               .join(classes.select("cls", "words"), "cls"))
    # the item's words around the anchor, as many as the index keeps around a posting
    anchors = anchors.select("cls", "off", F.col("term").alias("anchor"), "need", F.least(F.col("off"), F.lit(WINDOW - 1)).alias("head"),
                             F.slice("words", F.greatest(F.col("off") - WINDOW + 2, F.lit(1)),
                                     F.least(F.col("off"), F.lit(WINDOW - 1)) + WINDOW).alias("around"))
    j = postings.where("pos >= 0").join(maybe_broadcast(anchors, n_windows * ANCHORS, WINDOWS_BROADCAST), F.col("term") == F.col("anchor"))
    before = F.least("lead", "head")
    behind = F.least(F.size("near") - F.col("lead") - 1, F.size("around") - F.col("head") - 1)

    def agreeing(a, b, n):
        first = F.array_position(F.zip_with(a, b, lambda x, y: x == y), F.lit(False))
        return F.when(first > 0, first - 1).otherwise(n).cast("int")

    left = agreeing(F.reverse(F.slice("near", F.col("lead") + 1 - before, before)),
                    F.reverse(F.slice("around", F.col("head") + 1 - before, before)), before)
    right = agreeing(F.slice("near", F.col("lead") + 2, behind), F.slice("around", F.col("head") + 2, behind), behind)
    place = F.struct("off", "pos", left.alias("left"), right.alias("right"))
    rows = (j.select("row", "cls", "need", place.alias("x")).groupBy("row", "cls")
            .agg(F.collect_list("x").alias("xs"), F.min("need").alias("need"))
            .where(F.size(F.array_distinct(F.transform("xs", lambda x: x["off"]))) >= F.col("need")))
    return (rows.select("row", "cls", F.explode("xs").alias("x")).select("row", "cls", "x.*")
            .withColumn("start", F.col("pos") - F.col("off")))


def lookup(places: DataFrame, windows: DataFrame, n_windows: int, slack: int = SLACK) -> DataFrame:
    """(row, cls, start, end, exact): places of documents where all anchors of a window stand within
    ``slack`` of their places; ``exact`` if they stand right and the words there are the window."""
    w = maybe_broadcast(windows, n_windows, WINDOWS_BROADCAST)

    def of(k):
        """Places of the windows' k-th anchors."""
        x = F.get("a", F.lit(k))
        own = w.select(F.col("cls").alias("w_cls"), "at", "len", x["off"].alias("w_off"), F.size("a").alias("lists"))
        return places.join(own, (F.col("cls") == F.col("w_cls")) & (F.col("off") == F.col("w_off")))

    spelled = (F.col("off") - F.col("left") <= F.col("at")) & (F.col("off") + F.col("right") >= F.col("at") + F.col("len") - 1)
    width = slack + 1
    found = (of(0).select("row", "cls", "at", "len", "lists", "start", spelled.alias("spelled"))
             .withColumn("cell", F.floor(F.col("start") / width)).withColumn("gap", F.lit(0).cast("long")))
    for k in range(1, ANCHORS):
        other = (of(k).select(F.col("row").alias("row_k"), F.col("cls").alias("cls_k"), F.col("at").alias("at_k"), F.col("start").alias("start_k"))
                 .withColumn("cell_k", F.explode(F.array(*[F.floor(F.col("start_k") / width) + i for i in (-1, 0, 1)]))))
        on = ((F.col("row") == F.col("row_k")) & (F.col("cls") == F.col("cls_k")) & (F.col("at") == F.col("at_k"))
              & (F.col("cell") == F.col("cell_k")) & (F.abs(F.col("start") - F.col("start_k")) <= slack))
        gap = F.when(F.col("lists") <= k, F.lit(0)).otherwise(F.min(F.abs(F.col("start") - F.col("start_k"))))
        found = (found.join(other, on, "left")
                 .groupBy("row", "cls", "at", "len", "lists", "start", "spelled", "cell", "gap").agg(gap.cast("long").alias("gap_k"))
                 .where(F.col("gap_k").isNotNull())
                 .withColumn("gap", F.greatest("gap", "gap_k")).drop("gap_k"))
    begin = F.col("start") + F.col("at")
    return found.select("row", "cls", begin.alias("start"), (begin + F.col("len")).alias("end"),
                        ((F.col("gap") == 0) & F.col("spelled")).alias("exact"))


def covered(spans: Column) -> Column:
    """Positions inside any of the sorted (start, end) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(spans, zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["start"], acc["to"]))).alias("n"),
        F.greatest(acc["to"], s["end"]).alias("to")), lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, items (sorted ids of items with
    an exact window), near_items (ids with proximity matches only), contaminated."""
    classes = written(item_classes(items, item_id, item_text), "item-classes")
    windows = windows_of(classes)
    vocab = written(windows.select(F.explode("words").alias("term")).distinct(), "terms")
    df = written(term_counts(docs, vocab, vocab.count(), text), "term-counts")
    keyed = written(anchored(windows, df), "anchored")
    n_windows = keyed.count()
    terms = keyed.select(F.explode("a").alias("x")).select("x.term").distinct()
    postings = index_postings(docs, terms, terms.count(), doc_id, text)
    places = written(shifted(postings, keyed, classes, n_windows), "places")
    found = written(lookup(places, keyed, n_windows), "matches")
    spans = (found.where("exact").groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
             .select("row", covered(F.col("spans")).alias("n_hit")))
    item_ids = classes.select("cls", F.explode("ids").alias("item"))
    ids = (found.groupBy("row", "cls").agg(F.max("exact").alias("exact"))
           .join(maybe_broadcast(item_ids, item_ids.count(), WINDOWS_BROADCAST), "cls")
           .groupBy("row", "item").agg(F.max("exact").alias("exact"))
           .groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"),
                               F.sort_array(F.collect_list(F.when(~F.col("exact"), F.col("item")))).alias("near_items")))
    none = F.array().cast("array<string>")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (postings.where("pos = -1").select("row", "doc_id", "text_hash", "n_words")
            .join(spans, "row", "left").join(ids, "row", "left")
            .select("doc_id", "text_hash", "n_words", hit.alias("n_hit"), F.coalesce("items", none).alias("items"),
                    F.coalesce("near_items", none).alias("near_items"),
                    ((hit > 0) & (HIT_SHARE * hit >= F.col("n_words"))).alias("contaminated")))


def clean_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    bad = written(contamination(docs, items, doc_id, text, **kw).where("contaminated")
                  .select("doc_id", "text_hash").distinct(), "contaminated")
    key_id, key_hash = free_name(docs.columns, "bad_id"), free_name(docs.columns, "bad_hash")
    bad = bad.select(F.col("doc_id").alias(key_id), F.col("text_hash").alias(key_hash))
    bad = F.broadcast(bad) if bad.count() <= KEYS_BROADCAST else bad.hint("shuffle_hash")
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col(key_id)) & (F.xxhash64(F.col(text)) == F.col(key_hash)), "left_anti")
