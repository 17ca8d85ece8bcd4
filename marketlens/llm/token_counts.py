"""Token counts with the whole-token shortcut.

The tokenizer is a byte-fallback BPE model of sentencepiece whose normaliser
is the identity: blanks become the marker U+2581, one marker is put in front.
A merge can only make a vocabulary string, so where no vocabulary string
crosses a boundary the text can be cut there and its parts counted alone.
``prove`` checks that on the vocabulary itself (no piece has a marker behind
another character, none of two or more characters has a line feed) and finds
the pieces that encode alone as one token; those pre-tokens count 1 without
any merge, the others are merged by the library once per worker and kept in a
bounded table.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated
rows each give a row; very long texts are counted whole; extra columns pass through.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, free_name, grouped

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}\n]+|\n|{MARK}+")
KEEP, KEEP_CHARS = 150_000, 48      # pre-tokens a worker keeps in each of two generations
GROUP_CHARS = 400_000                # texts counted together


def pre_tokens(text: str) -> list[str]:
    """Parts of the text that no vocabulary string crosses."""
    return SEGMENT.findall((MARK + text).replace(" ", MARK)) if text else []


def merged(sp, segments: list[str]) -> list[int]:
    """Token counts of pre-tokens by the library.  It puts one marker in front
    of every input: a segment that starts with one gives it up, the others
    stand behind a line feed whose two tokens are taken off again."""
    ids = sp.encode([s[1:] if s[0] == MARK else "\n" + s for s in segments], num_threads=1)
    # a lone marker is the prefix of an empty text, which the library drops
    return [len(i) - (0 if s[0] == MARK else 2) if s != MARK else 1 for s, i in zip(segments, ids, strict=True)]


def prove(sp) -> dict[str, int]:
    """The vocabulary strings that encode alone as one token; raises if the
    vocabulary does not have the cut property."""
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    for p in pieces:
        if MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1):
            raise ValueError(f"vocabulary string {p!r} crosses a pre-token boundary")
    return {p: 1 for p, n in zip(pieces, merged(sp, pieces), strict=True) if n == 1}


@lru_cache(maxsize=2)
def _loaded(model_path: str):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return sp, prove(sp)


class Counter:
    """Counts tokens; holds the proven table and a bounded table of merged pre-tokens."""

    def __init__(self, model_path: str):
        self.sp, self.proven = _loaded(model_path)
        self.memo = Memo(KEEP, KEEP_CHARS)

    def _others(self, segments: list[str]) -> list[int]:
        """The whole-token shortcut first, the library's merges for the rest."""
        out = list(map(self.proven.get, segments))
        rest = [i for i, n in enumerate(out) if n is None]
        for i, n in zip(rest, merged(self.sp, [segments[i] for i in rest]), strict=True):
            out[i] = n
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        out: list[int] = []
        for lo, hi in grouped([len(t) if t else 0 for t in texts], GROUP_CHARS):
            parts = [pre_tokens(t or "") for t in texts[lo:hi]]
            n = self.memo.get([s for p in parts for s in p], self._others)
            at = 0
            for p in parts:
                out.append(sum(n[at:at + len(p)]))
                at += len(p)
        return out


def with_token_counts(docs: DataFrame, model_path: str, text: str = "text",
                      bytes_col: str = "n_bytes", tokens_col: str = "n_tokens") -> DataFrame:
    """``docs`` without its text, with the UTF-8 bytes and the tokens of the
    whole text.  Output columns replace input columns of the same name."""
    out_names = {bytes_col.lower(), tokens_col.lower(), text.lower()}
    kept = [c for c in docs.columns if c.lower() not in out_names]
    slot = free_name(kept, "whole_text")
    src = docs.select(*kept, docs[text].alias(slot))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != slot),
                        f"`{bytes_col}` bigint", f"`{tokens_col}` bigint"])

    def count(batches):
        counter = Counter(model_path)
        for b in batches:
            texts = b.column(b.schema.get_field_index(slot)).to_pylist()
            cols = [b.column(i) for i, n in enumerate(b.schema.names) if n != slot]
            names = [n for n in b.schema.names if n != slot]
            n_bytes = pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*cols, n_bytes, pa.array(counter.count(texts), pa.int64())],
                                             names=[*names, bytes_col, tokens_col])

    return src.mapInArrow(count, schema)
