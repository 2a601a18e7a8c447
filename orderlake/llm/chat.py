"""Chat formatting in relational steps, Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one
role merge into a block by array aggregation, and blocks are concatenated:
``<|role|>text<|+|>text<|end|>``, where ``<|+|>`` parts merged turns. In texts and roles
the characters that start control strings of this and of common other templates (``<``
and ``[``), and ``&`` itself, are written as ``&...;``, in roles ``|`` too, so no text can
forge a mark and everything can be read back.

Turns sort by turn (nulls first), then role, then text; repeated rows stay. Null texts and
roles count as empty, a null conv_id is a conversation of its own. A conversation is one
row of the result, so its turns must fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MORE, END = "<|+|>", "<|end|>"
LEARNED = "assistant"
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("|", "&#124;"))
BLOCKS = "array<struct<role:string,texts:array<string>>>"


def _replaced(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column) -> Column:
    return _replaced(text, _ESCAPES[:3])


def unescaped(text: Column) -> Column:
    return _replaced(text, [(new, old) for old, new in reversed(_ESCAPES)])


def merged(turns: Column) -> Column:
    """Sorted (turn, role, text) structs as blocks (role, texts) of adjacent turns of one role."""

    def step(acc: Column, t: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        longer = F.struct(last["role"].alias("role"), F.array_append(last["texts"], t["text"]).alias("texts"))
        fresh = F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))
        return F.when(last["role"] == t["role"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(longer))).otherwise(
            F.array_append(acc, fresh)
        )

    return F.aggregate(turns, F.array().cast(BLOCKS), step)


def _header(role: Column) -> Column:
    return F.concat(F.lit("<|"), _replaced(role, _ESCAPES), F.lit("|>"))


def formatted(blocks: Column) -> Column:
    def block(b: Column) -> Column:
        return F.concat(_header(b["role"]), F.array_join(F.transform(b["texts"], escaped), MORE), F.lit(END))

    return F.array_join(F.transform(blocks, block), "")


def loss_spans(blocks: Column) -> Column:
    """(start, end) code points in the formatted text of each text to learn."""

    def pieces(b: Column, i: Column) -> Column:
        opening = F.length(_header(b["role"])) + F.when(i > 0, len(END)).otherwise(0)
        return F.transform(
            b["texts"],
            lambda t, j: F.struct(
                F.when(j == 0, opening).otherwise(len(MORE)).alias("gap"), F.length(escaped(t)).alias("n"), (b["role"] == LEARNED).alias("learned")
            ),
        )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["n"]).alias("end"))
        return F.struct(
            (start + x["n"]).alias("at"), F.when(x["learned"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")
        )

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(F.flatten(F.transform(blocks, pieces)), none, step)["spans"]


def render(turns: DataFrame) -> DataFrame:
    """Columns conv_id, formatted, loss_spans, one row per conversation."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = collected.select("conv_id", merged(F.col("turns")).alias("blocks"))
    return blocks.select("conv_id", formatted(F.col("blocks")).alias("formatted"), loss_spans(F.col("blocks")).alias("loss_spans"))


def parsed(text: Column) -> Column:
    """Blocks (role, texts) read back from formatted text."""

    def block(b: Column) -> Column:
        parts = F.split(b, r"\|>", 2)  # the header's end is the first: roles hold no bar
        return F.struct(
            unescaped(F.substring(parts[0], F.lit(3), F.length(parts[0]))).alias("role"),
            F.transform(F.split(parts[1], r"<\|\+\|>", -1), unescaped).alias("texts"),
        )

    ends = F.split(text, r"<\|end\|>", -1)
    return F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), block)


def learned_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, in order, as it was before escaping."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")
