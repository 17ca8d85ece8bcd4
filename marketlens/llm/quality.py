"""Quality rules: base counts of repetition and symbols, and the divergence of a
document from its language.

References are learned from all documents of at least ``MIN_WORDS`` words: per
language a histogram of character classes and one of its ``COMMON_WORDS``
most frequent words (everything else is one more cell).  A document is
compared with its language by the Jensen-Shannon distance (base 2) of both
histograms.  Short texts scatter, so the allowed distance has a minimum-length
guard: the common-word rule asks for ``MIN_WORDS_COMMON`` words, and both
limits widen by a slack over sqrt(n), as the scatter of a sample of n does.

Defined results: null and empty texts have no words and fail the base rule; a
null language is a language of its own, and every language has its own
reference, however many there are; a language without any long enough document
uses the pooled one; ties among common words go by the word; repeated rows
each get a row; very long texts are taken whole, counted in flat arrays; an empty table gives no rows; extra
columns are not returned.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import free_name, written

# --- fixed values: base rule, symbols, character classes ------------------------
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
STOPS = ".,;:!?'\"()-"
CLASSES = ("lower", "upper", "digit", "stop", "symbol", "wide", "blank")

COMMON_WORDS = 100
LANGUAGES = 256            # languages whose references are broadcast; those of the others are joined
SALTS = 16                 # parts that the documents of a joined language are dealt to
MIN_WORDS_COMMON = 100
MAX_CLASS_DISTANCE = 0.13
MAX_COMMON_DISTANCE = 0.30
CLASS_SLACK = 1.6
COMMON_SLACK = 2.0
PARTIAL_KEYS = 200_000     # distinct words a task holds before it hands them on
SLICE_ROWS = 500           # rows whose verdicts a worker holds
LONG_TEXT = 4096           # words from which on windows are counted in arrays

_CLASS_OF = np.full(256, CLASSES.index("symbol"), dtype=np.int64)
for _c in range(256):
    _CLASS_OF[_c] = (5 if _c >= 0x80 else 0 if 97 <= _c <= 122 else 1 if 65 <= _c <= 90 else 2 if 48 <= _c <= 57
                     else 3 if chr(_c) in STOPS else 6 if chr(_c) in BLANKS else 4)


def class_counts(raw: bytes) -> np.ndarray:
    """Bytes per character class (all bytes of non-ASCII characters are "wide")."""
    per_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    return np.bincount(_CLASS_OF, weights=per_byte, minlength=len(CLASSES))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) > LONG_TEXT:
        return _repeated_in_long(words)
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        if seen[w] > 1:
            hit[i:i + 3] = b"\1\1\1"
    return sum(hit)


def _repeated_in_long(words: list[bytes]) -> int:
    """The same for long texts in flat arrays: windows as triples of word numbers, sorted."""
    number: dict[bytes, int] = {}
    at = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    # pairs, then triples, are numbered densely, so no product leaves 64 bits
    _, pair = np.unique(at[:-1] * len(number) + at[1:], return_inverse=True)
    _, triple, n = np.unique(pair[:-1] * len(number) + at[2:], return_inverse=True, return_counts=True)
    first = np.flatnonzero(n[triple] > 1)
    hit = np.zeros(len(words), dtype=bool)
    for k in range(3):
        hit[first + k] = True
    return int(hit.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > REPEAT_PERCENT * n_words


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two histograms: 0 equal, 1 disjoint."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return math.sqrt(max(0.0, d / 2))


def language_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, kind, key, n) over all documents of at least MIN_WORDS words: kind 0
    counts character classes, kind 1 words.  Tasks add up what they can hold
    before anything is shuffled."""
    schema = "lang string, kind int, key binary, n bigint"

    def part(batches):
        held: Counter = Counter()

        def flush():
            rows = list(held.items())
            held.clear()
            for i in range(0, len(rows), 20_000):
                ks = rows[i:i + 20_000]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([k[0] for k, _ in ks], pa.string()), "kind": pa.array([k[1] for k, _ in ks], pa.int32()),
                    "key": pa.array([k[2] for k, _ in ks], pa.binary()), "n": pa.array([n for _, n in ks], pa.int64())})

        for b in batches:
            for t, g in zip(b.column(0), b.column(1).to_pylist()):
                t = t.as_py()
                raw = t.encode() if t else b""
                words = raw.lower().split()
                if len(words) < MIN_WORDS:
                    continue
                for c, n in zip(CLASSES, class_counts(raw)):
                    held[g, 0, c.encode()] += int(n)
                for w, n in Counter(words).items():
                    held[g, 1, w] += n
                if len(held) > PARTIAL_KEYS:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(part, schema)
    return rows.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS,
               languages: int = LANGUAGES) -> dict:
    """The largest references of the documents."""
    return largest_references(written(language_counts(docs, text, lang), "language-counts"), common, languages)


def largest_references(counts: DataFrame, common: int, languages: int) -> dict:
    """{lang: (class histogram, {word: cell}, common-word histogram)} of the ``languages``
    languages with most words, with key ``...`` (Ellipsis) for the pooled reference.  At most
    ``languages`` + 1 references of ``common`` words each reach the driver."""
    sizes = (counts.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), F.asc_nulls_last("lang")).limit(languages).collect())
    largest = [r["lang"] for r in sizes]
    pooled = counts.groupBy("kind", "key").agg(F.sum("n").alias("n")).select(
        F.lit(True).alias("pooled"), F.lit(None).cast("string").alias("lang"), "kind", "key", "n")
    keep = F.col("lang").isin([x for x in largest if x is not None])
    if None in largest:
        keep = F.coalesce(keep, F.lit(False)) | F.col("lang").isNull()
    rows = counts.where(keep).select(F.lit(False).alias("pooled"), "lang", "kind", "key", "n").unionByName(pooled)
    rank = Window.partitionBy("pooled", "lang", "kind").orderBy(F.desc("n"), "key")
    top = rows.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= common).collect()
    total = {(r["pooled"], r["lang"]): r["n"] for r in
             rows.where("kind = 1").groupBy("pooled", "lang").agg(F.sum("n").alias("n")).collect()}
    out: dict = {}
    for r in top:
        k = ... if r["pooled"] else r["lang"]
        classes, cells, n = out.setdefault(k, (np.zeros(len(CLASSES)), {}, []))
        if r["kind"] == 0:
            classes[CLASSES.index(bytes(r["key"]).decode())] = r["n"]
        else:
            cells[bytes(r["key"])] = len(n)
            n.append(r["n"])
    return {k: (c, cells, np.array([*n, total.get((k is ..., None if k is ... else k), 0) - sum(n)], dtype=float))
            for k, (c, cells, n) in out.items()}


def other_references(counts: DataFrame, named: Column, common: int = COMMON_WORDS) -> DataFrame:
    """(lang, total, entries): one row per language that is not ``named``; entries are its
    character classes and ``common`` most frequent words, total counts all its words."""
    rows = counts.where(~named)
    rank = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    top = (rows.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= common)
           .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("kind", "rank", "key", "n"))).alias("entries")))
    total = rows.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("total"))
    return written(top.join(total, top["lang"].eqNullSafe(total["lang"])).select(top["lang"], "total", "entries"), "language-references")


def reference(entries: list, total: int) -> tuple[np.ndarray, dict, np.ndarray]:
    """(class histogram, {word: cell}, common-word histogram) of a row of the table."""
    classes, cells, n = np.zeros(len(CLASSES)), {}, []
    for e in entries:
        if e["kind"] == 0:
            classes[CLASSES.index(bytes(e["key"]).decode())] = e["n"]
        else:
            cells[bytes(e["key"])] = len(n)
            n.append(e["n"])
    return classes, cells, np.array([*n, total - sum(n)], dtype=float)


def divergence(raw: bytes, words: list[bytes], ref) -> tuple[float, float]:
    """Distances of a text to a reference: character classes, common words."""
    classes, cells, common = ref
    mine = np.zeros(len(common))
    for w, n in Counter(words).items():
        mine[cells.get(w, -1)] += n
    return js_distance(class_counts(raw), classes), js_distance(mine, common)


def verdict(n_words: int, d_class: float, d_common: float, max_class: float, max_common: float) -> bool:
    """True if the text is like its language, given its length."""
    scatter = 1 / math.sqrt(max(1, n_words))
    if d_class > max_class + CLASS_SLACK * scatter:
        return False
    return n_words < MIN_WORDS_COMMON or d_common <= max_common + COMMON_SLACK * scatter


COLUMNS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, kept boolean, class_distance double, common_distance double")


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", max_class: float = MAX_CLASS_DISTANCE,
           max_common: float = MAX_COMMON_DISTANCE, keep_columns: list[str] | None = None) -> DataFrame:
    """One row per document: ``keep_columns`` (default: all) and COLUMNS, which
    replace input columns of the same name."""
    counts = written(language_counts(docs, text, lang), "language-counts")
    refs = largest_references(counts, COMMON_WORDS, LANGUAGES)
    own = [c.split()[0] for c in COLUMNS.split(", ")]
    kept = [c for c in (docs.columns if keep_columns is None else keep_columns) if c.lower() not in own]
    # a text goes to the workers once, as a kept column or beside them
    beside = text not in kept
    t = free_name(kept, "whole_text") if beside else text
    g = free_name(kept, "whole_lang")
    src = docs.select(*[F.col(f"`{c}`") for c in kept], *([F.col(text).alias(t)] if beside else []), F.col(lang).cast("string").alias(g))
    at_text, at_lang = (len(kept), len(kept) + 1) if beside else (kept.index(text), len(kept))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name in kept), COLUMNS])

    def judge(batches):
        empty = (np.zeros(len(CLASSES)), {}, np.zeros(1))
        pooled = refs.get(..., empty)
        joined: dict = {}
        for b in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            rows = []
            for i, (x, l) in enumerate(zip(b.column(at_text), b.column(at_lang).to_pylist())):
                ref = refs.get(l) or joined.get(l)
                if ref is None and b.num_columns > at_lang + 1:       # the language's own, joined to the row
                    own_row = b.column(at_lang + 1)[i].as_py()
                    ref = reference(own_row["entries"], own_row["total"]) if own_row else pooled
                    if len(joined) >= LANGUAGES:
                        joined.clear()
                    joined[l] = ref
                x = x.as_py() or ""
                raw = x.encode()
                words = raw.split()
                counts = base_counts(x, words)
                failed = base_failed(len(words), counts[3])
                d = divergence(raw, raw.lower().split(), ref or pooled)
                ok = not failed and verdict(len(words), *d, max_class, max_common)
                rows.append((len(words), *counts, failed, ok, *d))
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), *cols], names=[*kept, *own])

    named = [x for x in refs if x is not ...]
    if len(named) < LANGUAGES:
        return src.mapInArrow(judge, schema)
    # the references of the other languages meet their documents in a shuffle
    def is_large(c):
        return F.coalesce(c.isin([x for x in named if x is not None]), F.lit(None in named))

    large = is_large(F.col(g))
    salt, ref = free_name(src.columns, "whole_salt"), free_name(src.columns, "whole_ref")
    rest = (other_references(counts, is_large(F.col("lang")))
            .select(F.col("lang").alias("ref_lang"), F.struct("entries", "total").alias("ref"))
            .withColumn("ref_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    others = src.where(~large).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).alias("d")
    met = (others.join(rest.alias("r"), F.col(f"d.{g}").eqNullSafe(F.col("r.ref_lang")) & (F.col(f"d.{salt}") == F.col("r.ref_salt")), "left")
           .select(*(F.col(f"d.`{c}`") for c in src.columns), F.col("r.ref").alias(ref)))
    return src.where(large).mapInArrow(judge, schema).unionByName(met.mapInArrow(judge, schema))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", **kw) -> DataFrame:
    """The documents that pass, with their own columns (under numbers meanwhile, so none clashes with COLUMNS)."""
    number = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    out = judged(docs.toDF(*number.values()), text=number[text], lang=number[lang], **kw)
    return out.where("kept").select(*[F.col(n).alias(c) for c, n in number.items()])
