"""Chat formatting with prefix-target expansion.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``; control strings inside
roles and texts are escaped reversibly (``&`` -> ``&amp;``, ``<|`` -> ``&lt;|``, in
roles a line feed too), so the output can be parsed back.

Every assistant turn is an example of its own: all turns before it are
context, only its reply is trainable.  ``expand`` gives two tables in the shared folder: ``turns`` (each
formatted turn once, with its character range in the conversation) and ``examples`` (one row per assistant
turn: its context is the conversation up to ``context_chars``, its loss mask the range ``loss_start`` to ``loss_end``).
``render`` writes the examples out, each with its whole context, by streaming the ordered turns past a running text.
Written contexts grow with the square of a conversation's turns; so its examples are cut into blocks of
512 turns, and every block is a task's work of its own, from the turns up to its end.
Character offsets are running sums over blocks of turns, so one conversation is spread over many tasks.

Defined results: turns are ordered by (turn, role, text), nulls first; a null text
or role counts as empty; null conversation ids are one conversation; repeated rows are
turns of their own; conversations without an assistant turn have no example;
very long texts and conversations are taken whole (an example is one row, so it must fit a task); an empty table
gives empty tables; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

# --- fixed values: the template -------------------------------------------------
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)

BLOCK_BITS = 10      # a block has 1,024 consecutive turn numbers
BLOCK_TURNS_BITS = 9  # examples of 512 consecutive turns are rendered together
OUT_CHARS = 4_000_000  # characters of examples that a worker holds
SLICE_ROWS = 256


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def unescape(s: str) -> str:
    return s.replace("&#10;", "\n").replace("&lt;|", "<|").replace("&amp;", "&")


def formatted_turns(conv: DataFrame) -> DataFrame:
    """(conv_id, turn, block, tie, role, formatted, head_chars, body_chars): every turn
    in the template; ``head_chars`` stand before the text and ``body_chars`` are the
    escaped text itself."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    body = escape(text)
    return conv.select(
        "conv_id", "turn", role.alias("role"), F.struct(role.alias("role"), text.alias("text")).alias("tie"),
        F.shiftright(F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))), BLOCK_BITS).alias("block"),
        F.concat(head, body, F.lit(END + "\n")).alias("formatted"),
        F.length(head).cast("long").alias("head_chars"), F.length(body).cast("long").alias("body_chars"))


def expand(conv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, examples)`` as written tables; see the module docstring."""
    t = formatted_turns(conv).withColumn("chars", F.length("formatted").cast("long"))
    # running sums in two steps: within blocks of turns, then over the blocks' totals
    in_block = (Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), F.col("tie"))
                .rowsBetween(Window.unboundedPreceding, 0))
    sums = written(t.withColumn("upto", F.sum("chars").over(in_block))
                   .withColumn("nth", F.count(F.lit(1)).over(in_block)).drop("tie"), "chat-blocks")
    totals = sums.groupBy("conv_id", "block").agg(F.sum("chars").alias("block_chars"), F.count(F.lit(1)).alias("block_turns"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
                          F.coalesce(F.sum("block_chars").over(before), F.lit(0).cast("long")).alias("base"),
                          F.coalesce(F.sum("block_turns").over(before), F.lit(0).cast("long")).alias("turns_before"))
    turns = written(
        sums.join(bases, F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("block") == F.col("b_block")))
        .select("conv_id", (F.col("turns_before") + F.col("nth")).alias("seq"), "role",
                (F.col("base") + F.col("upto") - F.col("chars")).alias("start"), "formatted", "head_chars", "body_chars"),
        "chat-turns")
    examples = written(
        turns.where(F.col("role") == ASSISTANT)
        .select("conv_id", F.col("seq").alias("target_seq"), F.col("start").alias("context_chars"),
                (F.col("start") + F.col("head_chars")).alias("loss_start"),
                (F.col("start") + F.col("head_chars") + F.col("body_chars")).alias("loss_end")), "chat-examples")
    return turns, examples


def render(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """(conv_id, target_seq, loss_start, loss_end, formatted): the given ``examples`` with their whole texts (context and target turn)."""
    block = F.shiftright("target_seq", BLOCK_TURNS_BITS)
    blocks = examples.select(F.col("conv_id").alias("e_conv"), block.alias("block")).distinct()
    ends = blocks.groupBy("e_conv").agg(F.collect_set("block").alias("blocks"))        # one number per 512 turns
    rows = (turns.join(ends, F.col("conv_id").eqNullSafe(F.col("e_conv")))
            .withColumn("block", F.explode(F.filter("blocks", lambda b: b >= F.shiftright(F.col("seq"), BLOCK_TURNS_BITS))))
            .select("conv_id", "block", "seq", "formatted"))
    ex = examples.select(F.col("conv_id").alias("e_conv"), "target_seq", block.alias("e_block"), "loss_start", "loss_end")
    rows = (rows.join(ex, F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("seq") == F.col("target_seq")) & (F.col("block") == F.col("e_block")), "left")
            .select("conv_id", "block", "seq", "formatted", "loss_start", "loss_end")
            .repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "seq"))
    schema = "conv_id bigint, target_seq bigint, loss_start bigint, loss_end bigint, formatted string"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        key, text, out, chars = None, [], [], 0

        def made():
            cols = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "formatted" else pa.int64()) for c, n in zip(cols, names)], names=names)

        for b in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            for conv, blk, seq, formatted, lo, hi in zip(*(c.to_pylist() for c in b.columns)):
                if key != (conv, blk):
                    key, text = (conv, blk), []
                text.append(formatted)
                if lo is not None:
                    whole_text = "".join(text)
                    text = [whole_text]
                    out.append((conv, seq, lo, hi, whole_text))
                    chars += len(whole_text)
                    if chars > OUT_CHARS:
                        yield made()
                        out, chars = [], 0
        if out:
            yield made()

    return rows.mapInArrow(run, schema)


def trained_parts(rendered: DataFrame) -> DataFrame:
    """(conv_id, target_seq, trained, chars): what each example trains on, unescaped, and its length; both read from the
    example's text.  An example whose text does not parse as the turns up to its target fails the job."""
    def run(batches):
        for b in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            trained, chars = [], []
            for seq, lo, hi, text in zip(*(b.column(i).to_pylist() for i in range(1, 4)), (x.as_py() for x in b.column(4))):
                if text.count(START) != seq or text.count(END) != seq or text[hi:] != END + "\n":
                    raise ValueError(f"example at turn {seq} is not its conversation up to there")
                trained.append(unescape(text[lo:hi]))
                chars.append(len(text))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(trained, pa.string()), pa.array(chars, pa.int64())],
                                             names=["conv_id", "target_seq", "trained", "chars"])

    return rendered.mapInArrow(run, "conv_id bigint, target_seq bigint, trained string, chars bigint")


def read_back(turns: DataFrame, rendered: DataFrame) -> DataFrame:
    """One row per conversation, parsed from the written turns and examples: turns are recovered by the template,
    the trainable text by the loss ranges of the examples' texts; ``formatted_chars`` is the length of all of them.

    Parsing is spread over all rows.  The digests run over a conversation's turns in order; its rows are
    sorted by Spark and streamed through, never held together."""
    ex = trained_parts(rendered).select(F.col("conv_id").alias("e_conv"), "target_seq", "trained", "chars")
    rows = (turns.join(ex, F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("seq") == F.col("target_seq")), "left")
            .select("conv_id", "seq", "formatted", "trained", "chars")
            .repartition("conv_id").sortWithinPartitions("conv_id", "seq"))
    schema = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
              "formatted_chars bigint, n_examples bigint")

    fields = [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in schema.split(", ")]

    def rows_of(done):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*done), fields)],
                                          names=[n for n, _ in fields])

    def digest(batches):
        key = state = None
        done: list = []

        def closed():
            n, sha, chars, loss, total, n_ex = state
            done.append((key[0], n, sha.hexdigest(), chars, loss.hexdigest(), total, n_ex))

        for b in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            for conv, formatted, trained, chars in zip(*(b.column(n).to_pylist() for n in ("conv_id", "formatted", "trained", "chars"))):
                if key is None or key[0] != conv:
                    if key is not None:
                        closed()
                    key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text = map(unescape, TURN.fullmatch(formatted).groups())
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if chars is not None:
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                    state[4] += chars
                    state[5] += 1
            if len(done) >= 2000:
                yield rows_of(done)
                done.clear()
        if key is not None:
            closed()
        if done:
            yield rows_of(done)

    return rows.mapInArrow(digest, schema)


def formatted_conversations(conv: DataFrame) -> DataFrame:
    """Formats conversations, writes every example and reads all back: see :func:`read_back`."""
    turns, examples = expand(conv)
    return read_back(turns, written(render(turns, examples), "chat-rendered"))
