"""Spelling variants by finite-state composition.

The vocabulary (words of the corpus with enough occurrences) is composed with itself through a one-edit
transducer: vocabulary acceptor, transducer that inserts, deletes or replaces one symbol, vocabulary acceptor.
A state of the composition is (state, edits made, state).  Before the edit both sides have read
the same prefix and are in the same state; after it only equal symbols are read.

The composition is enumerated per initial-state partition.  The vocabulary is cut into prefixes that are lengthened
where too many words begin alike, so that every partition has at most ``LEAF`` words however
uneven the language is:

* Paths still without an edit when they leave the prefix stay in one partition: a task builds the
  minimised acceptor of what follows the prefix and enumerates the accepted pairs.  What follows a minimal state is
  intersected once for all prefixes that lead to it.
* Paths whose edit lies within the prefix are in states that accept equal remainders only.  A
  state is then (place of the edit, remainder), the Spark shuffle key; it has at most one word per
  letter of the alphabet, plus one, so its members are compared as one short array.

Every pair of near words has one first place where it differs, hence exactly one path; none is lost and none counts twice.
Both kinds give per word the number of near words and the best of them; pairs are not
shuffled.  Roots follow forms by pointer doubling (n at least doubles along a form, so chains are short).

Defined results: null texts have no words, a null doc_id counts as the empty string; runs shorter than
the least length are no words; ties of n go to the smallest word in code-point order; repeated rows
count each; very long texts and runs are taken whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, maybe_broadcast, written

# --- fixed values: letters, deletion rule, least length and occurrences --------------------
LETTERS = "[A-Za-zÀ-ÿ]+"
EVERY = 97
MIN_LENGTH = 5
MIN_COUNT = 3
FORM_FACTOR = 2

LEAF = 8192                    # words of a partition
PREFIXES_BROADCAST = 200_000
MAX_ROUNDS = 64                # above log2 of any chain of forms; reaching it raises


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words; states are numbered so that a
    state comes after all it leads to."""

    def __init__(self, words: Iterable[str]):
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        open_: list[list] = [[{}, False]]         # states of the last word's path, not yet numbered
        last = ""

        def close(depth: int) -> None:
            while len(open_) > depth + 1:
                edges, final = open_.pop()
                key = (final, tuple(edges.items()))
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.edges)
                    self.edges.append(edges)
                    self.final.append(final)
                open_[-1][0][last[len(open_) - 1]] = state

        for w in words:
            same = 0
            for a, b in zip(last, w):
                if a != b:
                    break
                same += 1
            close(same)
            open_ += [[{}, False] for _ in range(len(w) - same)]
            open_[-1][1] = True
            last = w
        close(0)
        self.start = len(self.edges)
        self.edges.append(open_[0][0])
        self.final.append(open_[0][1])

    def common(self, a: int, b: int, without: str | None = None) -> list[str]:
        """Strings accepted from both states; none that begins with ``without``."""
        edges, final = self.edges, self.final
        out = [""] if final[a] and final[b] else []
        stack = [(edges[a][c], edges[b][c], (None, c)) for c in edges[a].keys() & edges[b].keys() if c != without]
        while stack:
            x, y, path = stack.pop()
            if final[x] and final[y]:
                out.append(_spell(path))
            for c in edges[x].keys() & edges[y].keys():
                stack.append((edges[x][c], edges[y][c], (path, c)))
        return out

    def edited(self, state: int) -> list[tuple[str, str]]:
        """Pairs accepted from (state, no edit, state) whose edit is the next step: two different next symbols, or
        one that the other side leaves out.  An omitted symbol does not stand next on the other
        side, else the first difference would be further on."""
        out = []
        follow = list(self.edges[state].items())
        for i, (c, x) in enumerate(follow):
            for d, y in follow[i + 1:]:
                out += [(c + s, d + s) for s in self.common(x, y)]
            out += [(c + s, s) for s in self.common(x, state, without=c)]
        return out

    def pairs(self):
        """All accepted pairs of words that differ by one edit, each once."""
        here = [self.edited(s) for s in range(len(self.edges))]
        alive = []
        for s, edges in enumerate(self.edges):
            alive.append(bool(here[s]) or any(alive[t] for t in edges.values()))
        stack: list[tuple] = [(self.start, None)]
        while stack:
            s, path = stack.pop()
            if here[s]:
                u = _spell(path)
                for x, y in here[s]:
                    yield u + x, u + y
            stack += [(t, (path, c)) for c, t in self.edges[s].items() if alive[t]]


def _spell(path) -> str:
    out = []
    while path is not None:
        path, c = path
        out.append(c)
    return "".join(reversed(out))


def word_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word): every run of letters as it counts, with the contract's deletions."""
    runs = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(LETTERS), F.lit(0))
    r = (docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
         .where(F.length("run") >= MIN_LENGTH))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (r.select("run", h.alias("h")).select(F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= MIN_LENGTH))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``least`` occurrences."""
    return word_runs(docs, doc_id, text).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def partitioned(words: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(word, n, depth, prefix): the partition of every word.  A prefix that more than ``leaf`` words share is
    lengthened by one symbol; a word that ends within it is a partition of its own."""
    if words.count() <= leaf:
        return words.select("word", "n", F.lit(0).alias("depth"), F.lit("").alias("prefix"))
    done, active, depth = None, words, 1
    while True:
        w = active.withColumn("prefix", F.substring("word", 1, depth))
        big = written(w.groupBy("prefix").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > leaf)
                      .select(F.col("prefix").alias("big")), "big-prefixes")
        n_big = big.count()
        if n_big:
            w = written(w.join(maybe_broadcast(big, n_big, PREFIXES_BROADCAST), F.col("prefix") == F.col("big"), "left"), "prefixes")
            active = w.where("big is not null").select("word", "n")
            w = w.where("big is null").drop("big")
        w = w.select("word", "n", F.lit(depth).alias("depth"), "prefix")
        done = w if done is None else done.unionAll(w)
        if not n_big:
            return done
        depth += 1


def near_in_partition(table: pa.Table) -> pa.Table:
    """(word, n_near, best): near words within one partition, whose edit lies behind its prefix."""
    depth = table.column("depth")[0].as_py()
    count = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))
    words = sorted(count)
    head = words[0][:depth]
    near = dict.fromkeys(words, 0)
    best: dict[str, tuple[int, str]] = {}
    if len(words) > 1:
        for x, y in Acceptor([w[depth:] for w in words]).pairs():
            x, y = head + x, head + y
            for a, b in ((x, y), (y, x)):
                near[a] += 1
                found = (-count[b], b)
                if a not in best or found < best[a]:
                    best[a] = found
    rows = list(best)
    return pa.table({"word": pa.array(rows, pa.string()), "n_near": pa.array([near[w] for w in rows], pa.int64()),
                     "best": pa.array([{"minus_n": best[w][0], "word": best[w][1]} for w in rows],
                                      pa.struct([("minus_n", pa.int64()), ("word", pa.string())]))})


def _without(at: Column) -> Column:
    return F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))


def near_across(parts: DataFrame) -> DataFrame:
    """(word, n_near, best): near words whose edit lies within the prefixes of their partitions."""
    deep = parts.where("depth > 0")
    at = F.explode(F.sequence(F.lit(0), F.col("depth") - 1)).alias("at")
    w = deep.select("word", "n", at).withColumn("symbol", F.substring("word", F.col("at") + 1, F.lit(1)))
    member = F.struct((-F.col("n")).alias("minus_n"), "word", "symbol", "whole")
    # a word without its symbol at the place, and the word itself as the one that leaves a symbol out
    states = (w.where(F.col("symbol") != "").select("at", _without(F.col("at")).alias("rest"), "n", "word", "symbol", F.lit(False).alias("whole"))
              .unionAll(w.select("at", F.col("word").alias("rest"), "n", "word", "symbol", F.lit(True).alias("whole"))))
    groups = (states.groupBy("at", "rest").agg(F.sort_array(F.collect_list(member)).alias("members")).where(F.size("members") > 1))
    me = groups.select("members", F.explode("members").alias("me"))
    # different symbols at the place: replaced, or left out by the word that has all
    others = F.filter("members", lambda m: m["symbol"] != F.col("me.symbol"))
    best = F.get("others", F.lit(0))
    return (me.select("me", others.alias("others")).where(F.size("others") > 0)
            .select("me.word", F.size("others").cast("long").alias("n_near"), F.struct(best["minus_n"].alias("minus_n"), best["word"].alias("word")).alias("best")))


def near_words(words: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(word, n_near, best (minus_n, word)) of the words that have near words."""
    parts = written(partitioned(words, leaf), "spelling-partitions")
    schema = "word string, n_near bigint, best struct<minus_n:bigint,word:string>"
    both = parts.groupBy("depth", "prefix").applyInArrow(near_in_partition, schema).unionAll(near_across(parts))
    return both.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): the last word that forms lead to."""
    cur = forms.select("word", F.col("form").alias("root"))
    for _ in range(MAX_ROUNDS):
        cur = written(cur, "spelling-roots")
        up = cur.select(F.col("word").alias("via"), F.col("root").alias("next"))
        if cur.join(up, F.col("root") == F.col("via"), "left_semi").isEmpty():
            return cur
        cur = cur.join(up, F.col("root") == F.col("via"), "left").select("word", F.coalesce("next", "root").alias("root"))
    raise RuntimeError("chains of forms did not settle")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs, doc_id, text), "spelling-words")
    near = near_words(words, leaf).withColumnRenamed("word", "of")
    n_best = -F.col("best.minus_n")
    is_form = n_best >= FORM_FACTOR * F.col("n")
    found = written(words.join(near, F.col("word") == F.col("of"), "left")
                    .select("word", F.when(is_form, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                            F.when(is_form, n_best).alias("form_n")), "spelling-forms")
    up = roots(found.where("form is not null")).withColumnRenamed("word", "of")
    return (found.join(up, F.col("word") == F.col("of"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
