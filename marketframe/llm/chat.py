"""Chat formatting after collapsing cumulative snapshots.

Applications log a conversation again after every turn, so most logged
conversations are prefixes of longer ones. A rolling hash over the turns names
every prefix; conversations whose last hash is another one's inner prefix are
dropped by an anti-join, and of equal conversations the smallest id stays. The
rest is rendered with a template.

A conversation is one record: its turns meet in one row, as its rendered text
must. Nothing else is gathered; equal conversations, however many, are one row
before they are compared.

Defined results: a null role renders as ``unknown`` and a null text as empty;
turns are ordered by turn, role and text (nulls last), and rows that repeat all
three count once; rows with a null conversation id form one conversation; an
empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import pick


@dataclasses.dataclass(frozen=True)
class Template:
    """What stands before a turn's role, between role and text, after the text, and between turns."""
    open: str = "<|im_start|>"
    middle: str = "\n"
    close: str = "<|im_end|>"
    between: str = "\n"


# Hashes are gathered in pages of so many, so that a turn does not copy all before it.
PAGE = 128


def rolling(turns: Column) -> Column:
    """Hashes of the prefixes of one, two, … turns; each covers the one before it and the turn."""
    def longer(done: Column, t: Column) -> Column:
        now = F.md5(F.concat_ws("\x1f", done["last"], F.md5(t["role"]), F.md5(t["text"])))
        full = F.size(done["page"]) >= PAGE
        return F.struct(
            now.alias("last"), F.when(full, F.array(now)).otherwise(F.array_append(done["page"], now)).alias("page"),
            F.when(full, F.array_append(done["pages"], done["page"])).otherwise(done["pages"]).alias("pages"))

    none = lambda kind, name: F.array().cast(kind).alias(name)
    start = F.struct(F.lit("").alias("last"), none("array<string>", "page"), none("array<array<string>>", "pages"))
    return F.aggregate(turns, start, longer, lambda done: F.flatten(F.array_append(done["pages"], done["page"])))


def render(turns: Column, template: Template = Template()) -> Column:
    one = lambda t: F.concat(F.lit(template.open), t["role"], F.lit(template.middle), t["text"], F.lit(template.close))
    return F.array_join(F.transform(turns, one), template.between)


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: (id, turns in order)."""
    flat = pick(rows, id=id_col, turn=turn_col, role=role_col, text=text_col)
    flat = flat.select("id", F.struct(
        F.col("turn").isNull().alias("no_turn"), "turn", F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("t"))
    return flat.groupBy("id").agg(F.array_sort(F.collect_set("t")).alias("turns"))


def maximal(rows: DataFrame, **columns: str) -> DataFrame:
    """Conversations that are no proper prefix of another, one of each: (id, turns, hash, n_copies)."""
    named = conversations(rows, **columns).withColumn("prefixes", rolling(F.col("turns")))
    whole = named.withColumn("hash", F.element_at("prefixes", -1))
    first = whole.groupBy("hash").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    inner = named.select(F.explode(F.slice("prefixes", F.lit(1), F.size("prefixes") - 1)).alias("hash")).distinct()
    kept = first.join(inner, "hash", "left_anti").withColumnRenamed("hash", "h")
    return whole.join(kept, (F.col("hash") == F.col("h")) & F.col("id").eqNullSafe(F.col("first"))).select("id", "turns", "hash", "n_copies")


def chat_texts(rows: DataFrame, template: Template = Template(), **columns: str) -> DataFrame:
    """Rendered maximal conversations: (id, n_turns, n_copies, text)."""
    kept = maximal(rows, **columns)
    return kept.select("id", F.size("turns").cast("long").alias("n_turns"), "n_copies", render(F.col("turns"), template).alias("text"))
