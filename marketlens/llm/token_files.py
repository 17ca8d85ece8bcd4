"""Token-id output: flat unsigned integer files plus 64-bit document offsets.

Documents are range-partitioned by id; each partition encodes its texts and
streams three files to the output folder:

* ``shard-N.bin``  token ids, little-endian, 16 bits if the vocabulary fits, else 32
* ``shard-N.idx``  unsigned 64-bit offsets in tokens from the shard's start, one
  per document and one behind the last
* ``shard-N.ids``  signed 64-bit document ids (null ids come first; the manifest has their number)

A small manifest table has each shard's documents and tokens; prefix sums over
it give every shard's base, so a document's global offset is base + local
offset and shards are written in parallel without knowing each other.  Files
are written under a task-private name and then renamed, so a repeated task
replaces its own result and a lost one leaves nothing half-written.

Texts are encoded by the tokenizers library.  Its byte-level pre-tokenizer
cuts the text by a pattern in which a run of non-blanks with at most one
space in front never depends on its neighbours; such runs are encoded once per
worker and kept (bounded), which gives the ids of the whole text.  A text
that has one of the tokenizer's special strings is encoded as a whole.

Defined results: null and empty texts have the end id only; equal ids are ordered
by text; repeated rows stay; very long texts are one document as any other; an empty table gives an empty manifest; extra
columns are not part of the files.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import Memo, grouped

KEEP, KEEP_CHARS = 450_000, 48      # runs a worker keeps in each of two generations
GROUP_CHARS = 400_000                # texts encoded together
DOCS_OUT = 4096
SLICE_ROWS = 512             # texts that a worker holds
SHARD_BYTES = 16 << 20       # bytes of text of a shard: a worker keeps most runs of so much text
PART_TOKENS = 1 << 22        # ids that are read back together

# --- fixed values: Unicode white space, as the tokenizer's \s has it ------------
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# letters up to an ASCII character that is none (one pre-token), else a run of non-blanks, else blanks
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
RUN = re.compile(f" ?[{_LETTERS}]++(?=[\x00-\x40\x5b-\x60\x7b-\x7f]|$)| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")

# the byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE = _BYTE_CHARS[32]

MANIFEST = "shard int, docs bigint, null_ids bigint, tokens bigint"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class Encoder:
    """Token ids of whole texts as little-endian bytes."""

    def __init__(self, path: str):
        self.tok = _tokenizer(path)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.memo = Memo(KEEP, KEEP_CHARS)
        self.feed = self._ids("\n")
        if len(self.feed) != 1:
            raise ValueError("a line feed is not one token of this vocabulary")

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)

    def _runs(self, runs: list[str]) -> list[bytes]:
        """A run of letters, with or without a space in front, is one pre-token and goes to
        the library's model directly, in the byte-level alphabet.  Other runs of non-blanks
        are encoded as the lines of one text: a line feed is a token of its own there, and
        no other token contains one.  Blank runs go alone."""
        out, words = {}, []
        for r in runs:
            body = r[1:] if r[0] == " " else r
            if body.isalpha():
                head = _SPACE if len(body) < len(r) else ""
                mapped = head + (body if body.isascii() else body.encode().decode("latin-1").translate(_BYTE_CHARS))
                out[r] = array(self.code, [t.id for t in self.tok.model.tokenize(mapped)]).tobytes()
            elif r.isspace():
                out[r] = self._ids(r).tobytes()
            else:
                words.append(r)
        if words:
            ids = self._ids("\n".join(words))
            ends = np.flatnonzero(ids == self.feed[0]).tolist() + [len(ids)]
            if len(ends) != len(words):
                raise AssertionError("runs and encoded lines differ")
            data, w, lo = ids.tobytes(), self.dtype.itemsize, 0
            for r, hi in zip(words, ends):
                out[r] = data[lo * w:hi * w]
                lo = hi + 1
        return [out[r] for r in runs]

    def encode_all(self, texts: list[str | None]):
        """The ids of every text, in order."""
        for lo, hi in grouped([len(t) if t else 0 for t in texts], GROUP_CHARS):
            some = [t or "" for t in texts[lo:hi]]
            whole = [any(s in t for s in self.special) for t in some]
            runs = [[] if alone else RUN.findall(t) for t, alone in zip(some, whole)]
            coded = self.memo.get([r for rs in runs for r in rs], self._runs)
            at = 0
            for t, alone, rs in zip(some, whole, runs):
                if alone:
                    yield np.asarray(self.tok.encode(t, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
                else:
                    yield b"".join(coded[at:at + len(rs)])
                    at += len(rs)


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def shard_count(docs: DataFrame, text: str = "text") -> int:
    """Shards of about ``SHARD_BYTES`` of text, and no fewer than the cluster has cores."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // SHARD_BYTES))


def write_shards(docs: DataFrame, tokenizer: str, folder: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Writes the files of ``docs`` to ``folder`` (a shared location) and returns
    the manifest with each shard's ``base``."""
    spark = docs.sparkSession
    n = shards or shard_count(docs, text)
    # equal rows, which may be a third of all, are told apart by their place and so dealt to several shards
    keys = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    ranged = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                          F.xxhash64(F.col(text)).alias("tie"), F.monotonically_increasing_id().alias("nth"))
              .repartitionByRange(n, *keys, F.col("nth").asc()).sortWithinPartitions(*keys, F.col("text").asc_nulls_first())
              .select("doc_id", "text"))

    def write(batches):
        from pyspark import TaskContext
        store, root = _filesystem(folder)
        store.create_dir(root, recursive=True)
        shard = TaskContext.get().partitionId()
        enc, end = Encoder(tokenizer), None
        names = {x: f"{root}/shard-{shard:06d}.{x}" for x in ("bin", "idx", "ids")}
        mine = f".{uuid.uuid4().hex}"
        files: dict = {}
        docs_n = nulls = tokens = 0
        for b in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            if not files:
                files = {x: store.open_output_stream(p + mine) for x, p in names.items()}
                end = np.asarray([end_id], dtype=enc.dtype).tobytes()
            ids = b.column(0)
            starts = np.empty(b.num_rows, dtype="<u8")
            for i, data in enumerate(enc.encode_all(b.column(1).to_pylist())):
                data += end
                starts[i] = tokens
                tokens += len(data) // enc.dtype.itemsize
                files["bin"].write(data)
            files["idx"].write(starts.tobytes())
            files["ids"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            docs_n += b.num_rows
            nulls += ids.null_count
        if files:
            files["idx"].write(np.asarray([tokens], dtype="<u8").tobytes())
            for x, f in files.items():
                f.close()
                store.move(names[x] + mine, names[x])
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "docs": [docs_n],
                                              "null_ids": [nulls], "tokens": [tokens]})

    manifest = f"{folder.rstrip('/')}/manifest"
    ranged.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with ``base``: tokens of all shards before (one row a shard)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
            .withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))))


def open_array(folder: str, name: str, dtype) -> np.ndarray:
    """One file as an array: memory-mapped where the folder is a mounted one."""
    store, root = _filesystem(folder)
    path = f"{root}/{name}"
    if store.type_name == "local":
        return np.memmap(path, dtype=dtype, mode="r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


class Ranges:
    """Parts of one file as arrays: memory-mapped where the folder is a mounted one, else read where they lie."""

    def __init__(self, folder: str, name: str, dtype):
        store, root = _filesystem(folder)
        self.dtype = np.dtype(dtype)
        self.mapped = np.memmap(f"{root}/{name}", dtype=dtype, mode="r") if store.type_name == "local" else None
        self.file = None if self.mapped is not None else store.open_input_file(f"{root}/{name}")

    def __call__(self, lo: int, hi: int) -> np.ndarray:
        if self.mapped is not None:
            return self.mapped[lo:hi]
        self.file.seek(lo * self.dtype.itemsize)
        return np.frombuffer(self.file.read((hi - lo) * self.dtype.itemsize), dtype=self.dtype)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def read_documents(manifest: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Documents read back from the files, one task per shard: doc_id, start
    (tokens of all documents before), n_tokens, ids_crc32 (of the ids as 32-bit integers)."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def read(batches):
        dtype = Encoder(tokenizer).dtype
        for b in batches:
            for r in b.to_pylist():
                stem = f"shard-{r['shard']:06d}"
                flat, idx, ids = Ranges(folder, f"{stem}.bin", dtype), Ranges(folder, f"{stem}.idx", "<u8"), Ranges(folder, f"{stem}.ids", "<i8")
                lo = 0
                while lo < r["docs"]:
                    hi = min(lo + DOCS_OUT, r["docs"])
                    at = idx(lo, hi + 1).astype("i8")
                    # as many documents as about PART_TOKENS ids
                    few = max(1, int(np.searchsorted(at, at[0] + PART_TOKENS, side="right")) - 1)
                    hi, at = lo + min(few, hi - lo), at[:min(few, hi - lo) + 1]
                    tokens = flat(int(at[0]), int(at[-1]))
                    crc = [zlib.crc32(tokens[a:b].astype("<u4")) for a, b in zip(at - at[0], at[1:] - at[0])]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(ids(lo, hi), pa.int64(), mask=np.arange(lo, hi) < r["null_ids"]),
                        "start": pa.array(at[:-1] + r["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(at), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())})
                    lo = hi
                for f in (flat, idx, ids):
                    f.close()

    n = max(1, manifest.count())
    return manifest.repartition(n, "shard").mapInArrow(read, schema)


def token_file_digest(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                      end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` as token files and returns what reading them back gives."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    manifest = write_shards(docs, tokenizer, folder, doc_id, text, end_id)
    return read_documents(manifest, folder, tokenizer)
