"""Secret scans: fixed patterns, and a battery of randomness tests.

Base kinds are leftmost non-overlapping matches of fixed patterns over the whole text
(``assign``, ``access``, ``hex``).  The battery looks at every maximal run of at least
``MIN_CHARS`` characters of the base-64 alphabets.  Its encoding is inferred (hex,
base 32, base 36, base 62, base 64), and under the hypothesis "uniformly random in
that encoding" three p-values are taken:

* chi-squared of the symbols and of the character classes,
* runs above and below the middle of the alphabet (Wald-Wolfowitz),
* serial correlation of neighbouring symbols,

combined by Bonferroni.  False discoveries are controlled on both sides, within strata of encoding and
length, over the candidates of all documents, so short strings, whose tests are weak, do not lend their
thresholds to long ones:

* Of the strings thrown out as not random at most ``FDR`` are random in expectation (Benjamini-Hochberg).
* Of the strings *reported* at most ``FDR`` are natural text, as estimated from decoys: strings of the same lengths
  glued from the ordinary words of the documents that have candidates, put through the same battery.  With q the
  share of a stratum's decoys that pass a threshold, its failing candidates / (1 - q) bound the natural ones
  among all, and q times that is what passes of them.  The loosest threshold whose estimate is within
  ``FDR`` is taken; a stratum whose decoys pass as easily as its candidates reports nothing.  Strata without
  decoys (ordinary words are hardly ever hex) have only the first control.

What remains is reported as kind ``random``.

Everything is column expressions: positions come from the lengths of the matches and of the text
between them.  The p-values go to a bounded grid (strata x cells) before they are ranked, so
no candidate list is sorted or gathered.  Work grows with the length of a text: symbols are counted once per symbol of the
alphabet, and arrays are built in blocks (``folded``), so neither one run of millions of characters nor a
hundred thousand matches in one text is quadratic.

Defined results: a null text counts as empty; positions are code points, end
exclusive; random spans that overlap a base span are left out; repeated rows each
give a row; very long texts and runs are taken whole; an empty table gives no rows; extra columns are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

# --- fixed values: kinds in order, patterns and lengths --------------------------
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)" + "[\"']?" + r"\x20*[:=]\x20*" + "[\"']?"
          + r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_VALUE_CHARS = 6
ACCESS, ACCESS_CHARS = r"AKIA[A-Z0-9]+", 20
HEX, HEX_CHARS = r"[0-9a-f]+", 24

MIN_CHARS = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ANY_RUN = r"[A-Za-z0-9+/_=-]+"
LONG_MAX = (1 << 63) - 1
FDR = 0.05
CELLS_PER_DECADE = 20
MAX_CELL = 20 * CELLS_PER_DECADE      # p below 1e-20 is one cell
BANDS = (32, 48, 64, 128)             # upper ends of the length strata
FOLD = 256                            # elements whose results are appended one by one
LONGEST_DECOY = 128
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# encoding, pattern, alphabet in the order of its values, symbols per class (digit, lower, upper, other)
ENCODINGS = (
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef", (10, 6, 0, 0)),
    ("base32", r"^[A-Z2-7]+$", _UPPER + "234567", (6, 0, 26, 0)),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOWER, (10, 26, 0, 0)),
    ("base62", r"^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER, (10, 26, 26, 0)),
    ("base64", r"", _UPPER + _LOWER + _DIGITS + "+/", (10, 26, 26, 2)),
)


def folded(items: Column, zero: Column, step, out: str) -> Column:
    """Array of all that ``step(state, item) -> (state, array)`` gives over ``items`` (a column, not an
    expression).  Results are appended within blocks of ``FOLD`` items and the blocks are flattened."""
    none = F.array().cast(f"array<{out}>")

    def one(acc, x):
        state, more = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["out"], more).alias("out"))

    def block(acc, b):
        inner = F.aggregate(F.slice(items, b * FOLD + 1, FOLD), F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return F.get(F.transform(F.array(inner), lambda i: F.struct(
            i["state"].alias("state"), F.concat(acc["blocks"], F.array(i["out"])).alias("blocks"))), F.lit(0))

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / FOLD).cast("int"))
    start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{out}>>").alias("blocks"))
    return F.when(F.size(items) > 0, F.aggregate(blocks, start, block, lambda acc: F.flatten(acc["blocks"]))).otherwise(none)


def match_parts(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (gap, whole, value): the text before each leftmost non-overlapping match, the match and its
    ``group``.  split() and regexp_extract_all() find the same matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))


def match_spans(parts: Column, least: int = 1) -> Column:
    """Array of (start, end, value) of the matches whose value has at least ``least`` characters."""
    span = "struct<start:bigint,end:bigint,value:string>"

    def step(at, x):
        start = at + F.length(x["gap"])
        end = start + F.length(x["whole"])
        row = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return end, F.when(F.length(x["value"]) >= least, F.array(row)).otherwise(F.array().cast(f"array<{span}>"))

    return folded(parts, F.lit(0).cast("long"), step, span)


def clear_of(ordered: Column) -> Column:
    """The candidates that no base span overlaps, of the array (start, candidate, end, value) of both in order,
    closed by a base span behind everything.  A candidate waits for the next span, which may overlap its end."""
    span = "struct<start:bigint,end:bigint,value:string>"
    none = F.array().cast(f"array<{span}>")
    zero = F.struct(F.lit(0).cast("long").alias("reach"), F.lit(False).alias("waits"), F.lit(0).cast("long").alias("start"),
                    F.lit(0).cast("long").alias("end"), F.lit("").alias("value"))

    def step(s, x):
        fits = s["waits"] & (x["candidate"] | (x["start"] >= s["end"]))
        held = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
        state = F.struct(F.when(x["candidate"], s["reach"]).otherwise(F.greatest(s["reach"], x["end"])).alias("reach"),
                         (x["candidate"] & (s["reach"] <= x["start"])).alias("waits"), x["start"].alias("start"), x["end"].alias("end"),
                         x["value"].alias("value"))
        return state, F.when(fits, F.array(held)).otherwise(none)

    return folded(ordered, zero, step, span)


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal distribution, by the logistic approximation
    1 / (1 + exp(1.5976 z + 0.070566 z^3))."""
    z = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(1.5976 * z + 0.070566 * z * z * z))


def _chi_tail(chi: Column, df: Column) -> Column:
    """Upper tail of chi-squared (Wilson-Hilferty)."""
    v = F.lit(2.0) / (9.0 * df)
    return _tail((F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - v)) / F.sqrt(v))


def randomness(candidates: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``encoding``, ``n`` (symbols without padding) and ``p``."""
    c = candidates.withColumn("body", F.translate(F.rtrim(F.col(value), F.lit("=")), "-_=", "+//"))
    which = F.lit(ENCODINGS[-1][0])
    for name, pattern, _, _ in reversed(ENCODINGS[:-1]):
        which = F.when(F.col("body").rlike(pattern), F.lit(name)).otherwise(which)
    c = c.withColumn("encoding", which)
    folded = F.when(F.col("encoding").isin("hex", "base36"), F.lower("body")).otherwise(F.col("body"))
    c = c.withColumn("body", folded).withColumn("n", F.length("body").cast("double"))

    def by_encoding(pick):
        out = F.lit(pick(ENCODINGS[-1]))
        for e in ENCODINGS[:-1]:
            out = F.when(F.col("encoding") == e[0], F.lit(pick(e))).otherwise(out)
        return out

    alphabet = by_encoding(lambda e: e[2])
    c = c.withColumn("symbols", by_encoding(lambda e: float(len(e[2])))).withColumn("alphabet", alphabet)
    c = c.withColumn("chars", F.split("body", ""))
    c = c.withColumn("x", F.transform("chars", lambda ch: F.instr(F.col("alphabet"), ch).cast("double")))
    n, a, x = F.col("n"), F.col("symbols"), F.col("x")

    def total(arr, f):
        return F.aggregate(arr, F.lit(0.0), lambda s, v: s + f(v))

    # chi-squared: one count per symbol of the largest alphabet; symbols outside the candidate's own do not occur
    symbols = F.array(*[F.lit(ch) for ch in SYMBOLS])
    squares = total(symbols, lambda ch: F.pow(n - F.length(F.replace(F.col("body"), ch, F.lit(""))), F.lit(2.0)))
    c = c.withColumn("chi_p", _chi_tail(squares * a / n - n, a - 1))
    classes = [F.length(F.regexp_replace("body", p, "")).cast("double") for p in ("[^0-9]", "[^a-z]", "[^A-Z]", "[0-9A-Za-z]")]
    chi = F.lit(0.0)
    kinds = F.lit(-1.0)
    for i, seen in enumerate(classes):
        share = by_encoding(lambda e, i=i: float(e[3][i]))
        expected = n * share / a
        chi = chi + F.when(share > 0, (seen - expected) * (seen - expected) / expected).otherwise(0.0)
        kinds = kinds + F.when(share > 0, 1.0).otherwise(0.0)
    c = c.withColumn("class_p", _chi_tail(chi, kinds))
    # runs above and below the middle of the alphabet
    c = c.withColumn("high", F.transform("x", lambda v: v * 2 > F.col("symbols") + 1))
    pairs = F.sequence(F.lit(1), F.greatest(F.size("x") - 1, F.lit(1)))
    n1 = total(F.col("high"), lambda v: v.cast("double"))
    changes = total(pairs, lambda i: F.when(F.get("high", i - 1) != F.get("high", i), 1.0).otherwise(0.0))
    both = 2 * n1 * (n - n1)
    sigma = F.sqrt(both * (both - n) / (n * n * (n - 1)))
    c = c.withColumn("runs_p", F.when((both > n) & (sigma > 0), 2 * _tail(F.abs((changes - both / n) / sigma)))
                     .otherwise(F.lit(0.0)))
    # serial correlation
    c = c.withColumn("mean", total(x, lambda v: v) / n)
    m = F.col("mean")
    cov = total(pairs, lambda i: F.coalesce((F.get("x", i - 1) - m) * (F.get("x", i) - m), F.lit(0.0)))
    var = total(x, lambda v: (v - m) * (v - m))
    c = c.withColumn("serial_p", F.when(var > 0, 2 * _tail(F.abs((cov / var + 1 / n) * F.sqrt(n)))).otherwise(F.lit(0.0)))
    uniform = 2 * F.least("chi_p", "class_p")
    return (c.withColumn("p", F.least(F.lit(1.0), 3 * F.least(uniform, F.col("runs_p"), F.col("serial_p"))))
            .drop("body", "symbols", "alphabet", "chars", "x", "chi_p", "class_p", "high", "runs_p", "mean", "serial_p"))


def _cell(p: Column) -> Column:
    """Grid cell of a p-value, rounded towards the larger p: cell k holds p <= 10^(-k/20)."""
    return F.least(F.lit(MAX_CELL), F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * CELLS_PER_DECADE)).cast("int")


def _band(n: Column) -> Column:
    b = F.lit(len(BANDS))
    for i in reversed(range(len(BANDS))):
        b = F.when(n < BANDS[i], F.lit(i)).otherwise(b)
    return b


def reported_cells(tested: DataFrame, fdr: float = FDR) -> dict[tuple[str, int], int]:
    """{(encoding, band): last reported cell} of the strata that report anything.  ``tested``: (encoding, band, cell,
    decoy).  Both controls are read from the grid of each stratum; at most 5 x 5 rows reach the driver."""
    cells = tested.groupBy("encoding", "band", "cell").agg(F.count_if(~F.col("decoy")).alias("n"), F.count_if("decoy").alias("d"))
    stratum = Window.partitionBy("encoding", "band")
    up = stratum.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    down = stratum.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    bound = F.pow(F.lit(10.0), -F.col("cell") / F.lit(float(CELLS_PER_DECADE)))
    g = (cells.withColumn("all", F.sum("n").over(stratum)).withColumn("decoys", F.sum("d").over(stratum))
         .withColumn("pass", F.sum("n").over(up)).withColumn("q", F.sum("d").over(up) / F.greatest("decoys", F.lit(1)))
         .withColumn("rejected", (F.col("n") > 0) & (bound <= fdr * F.sum("n").over(down) / F.col("all")))
         .withColumn("first_rejected", F.min(F.when(F.col("rejected"), F.col("cell"))).over(stratum)))
    natural = F.when(F.col("q") < 1, F.least(F.col("all").cast("double"), (F.col("all") - F.col("pass")) / (1 - F.col("q")))).otherwise(F.col("all").cast("double"))
    fine = (F.col("decoys") == 0) | (F.col("q") * natural <= fdr * F.col("pass"))
    ok = g.where(fine & (F.col("pass") > 0) & (F.col("first_rejected").isNull() | (F.col("cell") < F.col("first_rejected"))))
    return {(r["encoding"], r["band"]): r["cell"] for r in ok.groupBy("encoding", "band").agg(F.max("cell").alias("cell")).collect()}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, candidates, decoys) per document: base spans as (start, kind_no, end) in order,
    candidates of the battery as (start, end, value) clear of base spans, and at most as many decoys."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(doc_id).alias("doc_id"), t.alias("t"))
    parts = d.select("doc_id", "t", match_parts(F.col("t"), ASSIGN, 2).alias("assign"),
                     F.when(F.contains("t", F.lit("AKIA")), match_parts(F.col("t"), ACCESS)).alias("access"),
                     match_parts(F.col("t"), f"{HEX[:-1]}{{{HEX_CHARS},}}").alias("hex"), match_parts(F.col("t"), CANDIDATE).alias("long"))
    found = parts.select("doc_id", "t", match_spans(F.col("assign"), ASSIGN_VALUE_CHARS).alias("assign"), match_spans(F.col("access"), ACCESS_CHARS).alias("access"),
                         match_spans(F.col("hex"), HEX_CHARS).alias("hex"), match_spans(F.col("long"), MIN_CHARS).alias("long"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    base = none
    for i, k in enumerate(KINDS[:3]):
        kind_no = F.lit(i)
        base = F.concat(base, F.coalesce(F.transform(k, lambda s: F.struct(
            s["start"].alias("start"), kind_no.alias("kind_no"), s["end"].alias("end"))), none))

    def span(s, candidate, value):
        return F.struct(s["start"].alias("start"), F.lit(candidate).alias("candidate"), s["end"].alias("end"), value.alias("value"))

    end = F.lit(LONG_MAX).cast("long")
    close = F.array(F.struct(end.alias("start"), F.lit(False).alias("candidate"), end.alias("end"), F.lit("").alias("value")))
    both = F.sort_array(F.concat(F.transform("base", lambda s: span(s, False, F.lit(""))), F.transform("long", lambda s: span(s, True, s["value"])), close))
    found = (found.select("doc_id", "t", F.sort_array(base).alias("base"), "long")
             .select("doc_id", "t", "base", F.when(F.size("long") > 0, both).otherwise(F.slice(close, 1, 0)).alias("ordered"))
             .select("doc_id", "t", "base", clear_of(F.col("ordered")).alias("candidates")))
    # decoys: the text's shorter strings in a row, cut at the length of the first candidate
    plain = F.filter(F.regexp_extract_all("t", F.lit(ANY_RUN), F.lit(0)), lambda w: F.length(w) < MIN_CHARS)
    size = F.least(F.length(F.get("candidates", F.lit(0))["value"]), F.lit(LONGEST_DECOY))
    cut = F.regexp_extract_all(F.array_join(plain, ""), F.concat(F.lit(".{"), size.cast("string"), F.lit("}")), F.lit(0))
    decoys = F.when(F.size("candidates") > 0, F.slice(cut, 1, F.size("candidates"))).otherwise(F.array().cast("array<string>"))
    return found.select("doc_id", "base", "candidates", decoys.alias("decoys"))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, kind_no, end) in
    order (kind_no indexes KINDS)."""
    scanned = written(scan(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "secret-scan")
    long_ = F.lit(None).cast("long")
    strings = (scanned.select("row", F.explode("candidates").alias("c")).select("row", "c.start", "c.end", "c.value", F.lit(False).alias("decoy"))
               .unionAll(scanned.select("row", long_, long_, F.explode("decoys"), F.lit(True))))
    tested = written(randomness(strings).select("row", "start", "end", "decoy", "encoding", _band(F.col("n")).alias("band"), _cell(F.col("p")).alias("cell")),
                     "secret-tests")
    keep = F.lit(False)
    for (encoding, band), cell in sorted(reported_cells(tested, fdr).items()):
        keep = keep | ((F.col("encoding") == encoding) & (F.col("band") == band) & (F.col("cell") <= cell))
    added = (tested.where(~F.col("decoy") & keep).groupBy("row")
             .agg(F.collect_list(F.struct("start", F.lit(len(KINDS) - 1).alias("kind_no"), "end")).alias("added")))
    spans = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>"))))
    return scanned.join(added, "row", "left").select("doc_id", spans.alias("spans"))


def spans_text(spans: Column, kinds: int = len(KINDS)) -> Column:
    """``kind:start:end`` of the spans whose kind_no is below ``kinds``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(spans, lambda s: s["kind_no"] < kinds)
    return F.concat_ws(",", F.transform(kept, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))))
