"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, cut into blocks
of adjacent turns of one role, and concatenated:

    <|start|>role<|text|>first text<|text|>second text<|end|>  ...

Control strings inside roles and texts are escaped with a backslash after
their first character (and backslashes are doubled), so no text can forge a
mark and ``read_back`` restores every turn exactly.

Defined results: a null text or role is the empty string; a null conversation
id is one conversation of its own; turns sort by (turn, role, text), a null
turn first, and repeated rows are repeated turns; an empty table gives no
rows; a very long text is formatted whole, and the work is in proportion to the
turns of a conversation up to some 100,000 of them.  Other columns of the input
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
#: Strings that are marks here or in widely used chat templates.
CONTROL = [START, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
#: Pieces whose places are summed up at once (see ``_running_sum``).
BLOCK = 256


def escape(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _running_sum(sizes: Column, first: int = 2) -> Column:
    """The sums of the first 1, 2, ... numbers of an array (``first=1``: of those in
    front of each).  Each step copies the array before it: for short arrays."""
    return F.slice(F.aggregate(sizes, F.array(F.lit(0)), lambda acc, x: F.concat(
        acc, F.array(F.element_at(acc, -1) + x))), F.lit(first), F.size(sizes))


def running_sum_blocks(sizes: str) -> Column:
    """The running sums of an array in blocks of ``BLOCK`` numbers, each block from 0."""
    blocks = F.when(F.size(sizes) > 0, F.sequence(F.lit(1), F.size(sizes), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return F.transform(blocks, lambda at: _running_sum(F.slice(sizes, at, F.lit(BLOCK))))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``,
    the (start, length) in code points of every text of ``trained_role`` in
    ``formatted`` (start from 0)."""
    rows = turns.select(
        column(turns, "conv_id").alias("conv_id"),
        F.struct(column(turns, "turn").alias("turn"),
                 escape(F.coalesce(column(turns, "role"), F.lit(""))).alias("role"),
                 escape(F.coalesce(column(turns, "text"), F.lit(""))).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    # 1-based places where a block of one role starts.
    n = F.size("t")
    starts = F.filter(F.sequence(F.lit(1), n),
                      lambda i: (i == 1) | (F.element_at("t", i)["role"]
                                            != F.element_at("t", F.greatest(i - 1, F.lit(1)))["role"]))
    cut = grouped.select("conv_id", "t", starts.alias("s"), n.alias("n"))
    blocks = cut.select("conv_id", F.transform("s", lambda s, k: F.struct(
        F.element_at("t", s)["role"].alias("role"),
        F.slice("t", s, F.coalesce(F.get("s", k + 1), F.col("n") + 1) - s)["text"].alias("texts"))).alias("b"))
    # Pieces in order: a head of marks, then an (escaped) text.
    pieces = blocks.select("conv_id", F.flatten(F.transform("b", lambda b, k: F.transform(
        b["texts"], lambda x, j: F.struct(
            F.when(j > 0, F.lit(TEXT)).otherwise(F.concat(
                F.when(k > 0, F.lit(END)).otherwise(F.lit("")), F.lit(START), b["role"], F.lit(TEXT))).alias("head"),
            x.alias("text"), (b["role"] == trained_role).alias("loss"))))).alias("p"))
    placed = pieces.select(
        "conv_id", "p", F.transform("p", lambda x: F.char_length(x["head"]) + F.char_length(x["text"])).alias("sizes"),
        F.concat(F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["text"])), ""),
                 F.lit(END)).alias("formatted"))
    placed = placed.select("conv_id", "p", "formatted", running_sum_blocks("sizes").alias("sums"))
    # Arrays that belong together are zipped: one that a lambda function only names
    # can be computed anew for every element.
    before = _running_sum(F.transform("sums", lambda x: F.element_at(x, -1)), 1)
    ends = F.flatten(F.zip_with("sums", before, lambda x, b: F.transform(x, lambda e: e + b)))
    spans = F.filter(F.zip_with("p", ends, lambda x, e: F.struct(
        (e - F.char_length(x["text"])).alias("start"), F.char_length(x["text"]).alias("length"),
        x["loss"].alias("loss"))), lambda x: x["loss"])
    return placed.select("conv_id", "formatted", F.transform(
        spans, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text)."""
    cut = F.split(formatted, r"\Q" + END + r"\E", -1)
    blocks = F.slice(cut, 1, F.size(cut) - 1)
    return F.flatten(F.transform(blocks, lambda b: _block_turns(
        F.split(F.substr(b, F.lit(len(START) + 1)), r"\Q" + TEXT + r"\E", -1))))


def _block_turns(parts: Column) -> Column:
    return F.transform(F.slice(parts, 2, F.size(parts) - 1),
                       lambda x: F.struct(unescape(F.element_at(parts, 1)).alias("role"), unescape(x).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["length"]))), "")
