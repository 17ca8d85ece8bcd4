"""Registered queries of the text operators: each applies its operator, with
production parameters, to its whole table and derives the digest columns of
its contract from the operator's real output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir, ship_package
from . import chat, decontam, licenses, lm, mixing, quality, secrets, simhash, spelling, substring, token_counts, token_files, vector_codes
from .common import read_table

# --- fixed values: files, limits and the extra conversation of the contracts ------
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096
END_ID = 0
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are (an installed package of data files)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def prepare(spark: SparkSession) -> SparkSession:
    """Makes the package importable in tasks and the shared folder known; leaves the
    session's settings as they are."""
    ship_package(spark)
    shared_dir(spark)
    return spark


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = (run, sql)
        return run
    return deco


@query("op1_secret_scan")
def op1(spark, sf_dir):
    """Secrets in every whole text of documents: base spans and random strings."""
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind_no"] == kind)).cast("long")
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
                        F.sha2(secrets.spans_text(F.col("spans"), 3), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("spans")).alias("spans"), of(3).alias("n_random"))


@query("op2_substring_dedup")
def op2(spark, sf_dir):
    """Repeated passages of every document, their removals and the documents that share them."""
    found = substring.substring_dedup(read_table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["at"].cast("string"), s["end"].cast("string")))
    return found.withColumn("removed", F.concat_ws(",", spans)).withColumn("passage", F.col("n_repeated") > 0)


@query("op3_lm_score")
def op3(spark, sf_dir):
    """Attention-model and unigram log probabilities of every whole text of documents."""
    return lm.score(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


_OP4_SQL = f"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
f AS (SELECT *, '<|im_start|>' || replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;') || chr(10)
    || replace(replace(text, '&', '&amp;'), '<|', '&lt;|') || '<|im_end|>' || chr(10) AS formatted FROM c),
s AS (SELECT *, sum(length(formatted)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
    ROWS UNBOUNDED PRECEDING) AS upto FROM f)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM s GROUP BY conv_id"""


@query("op4_chat_format", _OP4_SQL)
def op4(spark, sf_dir):
    """Conversations formatted as prefix-target examples, read back from the output."""
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.formatted_conversations(conv.unionByName(extra))


@query("op5_token_counts")
def op5(spark, sf_dir):
    """Bytes and tokens of every whole text of documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, tokenizer_path(PIECE_MODEL))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op6_quality_rules")
def op6(spark, sf_dir):
    """Base counts and divergence verdict of every document."""
    return quality.judged(read_table(spark, sf_dir, "documents"), keep_columns=["doc_id"])


_OP7_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
_OP7_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_OP7_WORDS} AS words FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {_OP7_WORDS} AS words FROM benchmark),
iw AS (SELECT DISTINCT item, words[k:k + 12] AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS k FROM i WHERE len(words) > 0)),
n AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (SELECT r, k, words[k:k + n - 1] AS win
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS k FROM d JOIN n ON len(words) >= n)),
hits AS (SELECT dw.r, dw.k, len(dw.win) AS n, iw.item FROM dw JOIN iw ON dw.win = iw.win),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""


@query("op7_decontamination", _OP7_SQL)
def op7(spark, sf_dir):
    """Benchmark windows inside every document, by the positional index."""
    found = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query("decontamination_proximity")
def op7_near(spark, sf_dir):
    """Documents with benchmark items that stand in them only approximately: all anchors of a window near their places."""
    found = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    near = F.concat_ws(",", "near_items")
    return found.where(F.size("near_items") > 0).select("doc_id", F.size("near_items").cast("long").alias("n_near_items"), near.alias("near_items"))


@query("op8_token_files")
def op8(spark, sf_dir):
    """All documents written as token files in doc_id order and read back."""
    return token_files.token_file_digest(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), end_id=END_ID)


_OP9_SQL = r"""WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS hash FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
    source_size * 2::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1),
s3 AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM s2),
s AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base FROM s3),
h AS (SELECT source, hash, sum(size) AS words FROM d GROUP BY source, hash),
r AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY hash ROWS UNBOUNDED PRECEDING) AS upto FROM h),
b AS (SELECT r.source, s.target - s.base * s.source_size AS rest, min_by(hash, hash) AS cut,
    min_by(upto, hash) AS upto, min_by(words, hash) AS words
  FROM r JOIN s ON r.source IS NOT DISTINCT FROM s.source
  WHERE r.upto > s.target - s.base * s.source_size GROUP BY ALL)
SELECT d.doc_id, d.source, d.size, s.source_size, s.target,
  (d.size * (s.base + CASE WHEN d.hash < b.cut OR (d.hash = b.cut AND b.upto - b.rest < b.rest - (b.upto - b.words))
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source"""


@query("op9_source_mix", _OP9_SQL)
def op9(spark, sf_dir):
    """Words that the mix of sources takes of every document."""
    return mixing.taken_words(read_table(spark, sf_dir, "documents"))


@query("op10_simhash")
def op10(spark, sf_dir):
    """SimHash fingerprint and near-duplicate component of every document."""
    groups = simhash.near_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _op11_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    near = """SELECT p.r, p.pos, any_value(p.part) AS part, min({{'d': list_sum(list_transform(range(1, len(p.part) + 1),
    lambda i: (p.part[i] - b.entry[i]) * (p.part[i] - b.entry[i])))::BIGINT, 'e': b.e}}) AS m
  FROM p JOIN b{0} b ON p.pos = b.pos GROUP BY p.r, p.pos"""
    steps = "".join(f""",
a{i} AS MATERIALIZED ({near.format(i)}),
b{i + 1} AS MATERIALIZED (SELECT o.pos, o.e, coalesce(n.entry, o.entry) AS entry FROM b{i} o LEFT JOIN (
  SELECT pos, e, list((s - (((s % n) + n) % n)) // n ORDER BY dim) AS entry FROM (
    SELECT pos, e, dim, sum(x)::HUGEINT AS s, count(*) AS n
    FROM (SELECT pos, m.e AS e, unnest(range(1, len(part) + 1)) AS dim, unnest(part) AS x FROM a{i}) GROUP BY pos, e, dim)
  GROUP BY pos, e) n ON o.pos = n.pos AND o.e = n.e)""" for i in range(rounds))
    return f"""WITH k AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
p AS MATERIALIZED (SELECT r, pos, v[pos * len(v) // {parts} + 1 : (pos + 1) * len(v) // {parts}] AS part
  FROM (SELECT r, v, unnest(range({parts})) AS pos FROM k)),
b0 AS (SELECT pos, (r - 1)::INT AS e, part::HUGEINT[] AS entry FROM p WHERE r <= {entries}){steps},
f AS MATERIALIZED ({near.format(rounds)}),
c AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY pos) AS code, sum(m.d)::BIGINT AS error FROM f GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY pos, e)) AS codebooks_sha256 FROM b{rounds})
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, h.codebooks_sha256
FROM k JOIN c USING (r) LEFT JOIN h ON true"""


@query("op11_vector_codes", _op11_sql())
def op11(spark, sf_dir):
    """Product code of every whole vector of embeddings."""
    return vector_codes.codes(read_table(spark, sf_dir, "embeddings"))


@query("op12_spelling_variants")
def op12(spark, sf_dir):
    """Near words, form and root of every word of documents."""
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    quoted = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
    words = _OP7_WORDS.replace("coalesce(text, '')", "text")
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_OP7_WORDS} AS words FROM documents),
t AS MATERIALIZED (SELECT template, label, {words} AS words FROM (VALUES {quoted}) v(template, label, text)),
g AS (SELECT r, k, words[k] AS a, words[k + 1] AS b, words[k + 2] AS c FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS k FROM d)),
tg AS MATERIALIZED (SELECT template, o, words[o + 1] AS a, words[o + 2] AS b, words[o + 3] AS c
  FROM (SELECT template, words, unnest(range(0, len(words) - 2)) AS o FROM t)),
base AS (SELECT r, k - 1 AS pos, CASE WHEN a = 'mit' THEN 'mit' WHEN a = 'apache' THEN 'apache' ELSE 'gpl' END AS label FROM g
  WHERE (a IN ('mit', 'apache') AND b = 'license') OR (a = 'general' AND b = 'public' AND c = 'license')),
v AS (SELECT r, template, k - 1 - o AS diagonal, o, k - 1 AS pos FROM g JOIN tg USING (a, b, c)),
n AS (SELECT r, template, diagonal, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) AS gap
  FROM (SELECT DISTINCT r, template, diagonal FROM v)),
s AS (SELECT r, template, diagonal, count(*) FILTER (gap IS NULL OR gap > {licenses.DRIFT})
  OVER (PARTITION BY r, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM n),
h AS (SELECT r, template, span, count(DISTINCT w) AS held, max(pos) + {licenses.K} - min(pos) AS width
  FROM (SELECT v.r, v.template, span, pos, unnest([o, o + 1, o + 2]) AS w FROM v JOIN s ON v.r = s.r AND v.template = s.template AND v.diagonal = s.diagonal)
  GROUP BY r, template, span),
f AS (SELECT r, label, held / len(words) AS share FROM h JOIN t USING (template)
  WHERE held / len(words) >= {licenses.MIN_SHARE}::DOUBLE AND held >= {licenses.MIN_DENSITY}::DOUBLE * width),
b AS (SELECT r, count(*) AS n_base, min(pos)::BIGINT AS first_word, max(pos)::BIGINT AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM
  (SELECT r, label FROM base UNION ALL SELECT r, label FROM f) GROUP BY r),
m AS (SELECT r, max(share) AS share FROM f GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
  greatest(coalesce(share, 0), CASE WHEN n_base > 0 THEN {licenses.BASE_SCORE} ELSE 0 END)::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r) LEFT JOIN m USING (r)"""


@query("op13_license_scan", _op13_sql())
def op13(spark, sf_dir):
    """License phrases and verified license notices of every whole text of documents."""
    found = licenses.find_licenses(read_table(spark, sf_dir, "documents"))
    return (found.withColumn("base_labels", F.concat_ws(",", "base_labels")).withColumn("labels", F.concat_ws(",", "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
