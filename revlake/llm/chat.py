"""Chat formatting: conversations logged as growing snapshots, collapsed to the longest and rendered.

A conversation's turns are ordered by turn, role and text. Each turn is hashed with its place, and the running XOR of
two such 64-bit hashes identifies the conversation's prefix up to there. A conversation whose whole hash is that of a
proper prefix of another is dropped by an anti-join; of equal ones the least id stays. What is left is rendered
in the ``<|im_start|>role`` template; marks of that template inside a text are broken up.

Turns that repeat exactly count once; turns that share a number but differ all stay, in the order above. Turns of a
null conversation belong to none and are left out. A null number comes first; null roles and texts are
told apart from empty ones as prefixes but rendered alike. Conversations of empty texts are conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def _hash(*seed: Column) -> Column:
    return F.xxhash64(*seed, F.col("k"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit("")))


def turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    names = {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col}
    return conversations.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()]).where("conv is not null")


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, role, text, k, n, h1, h2) of distinct turns: the k-th of n, and the hash of the first k. One shuffle, by conversation."""
    ordered, turn = Window.partitionBy("conv").orderBy("turn", "role", "text"), F.struct("turn", "role", "text")
    rows = rows.withColumn("again", F.lag(turn).over(ordered).eqNullSafe(turn)).where("not again")
    rows = rows.withColumn("k", F.row_number().over(ordered)).withColumns({"x1": _hash(), "x2": _hash(F.lit(1))})
    return rows.select("conv", "role", "text", "k", F.count("*").over(Window.partitionBy("conv")).alias("n"), F.bit_xor("x1").over(ordered).alias("h1"), F.bit_xor("x2").over(ordered).alias("h2"))


def maximal(prefixed: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that are no proper prefix, once each."""
    whole = prefixed.where("k = n").groupBy("k", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    longer = prefixed.where("k < n").select("k", "h1", "h2").distinct()
    return whole.join(longer, ["k", "h1", "h2"], "left_anti").select("conv", F.col("k").cast("long").alias("n_turns"), "n_copies")


def _plain(c: str) -> Column:
    return F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def render(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies, text) of each maximal conversation."""
    rows = written(prefixes(turns(conversations, conv_col, turn_col, role_col, text_col)), "prefixes")
    line = F.concat(F.lit("<|im_start|>"), _plain("role"), F.lit("\n"), _plain("text"), F.lit("<|im_end|>\n"))
    lines = rows.join(maximal(rows), "conv").groupBy("conv", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(F.struct("k", line.alias("line")))).alias("lines"))
    return lines.select(F.col("conv").alias("conv_id"), "n_turns", "n_copies", F.array_join(F.col("lines.line"), "").alias("text"))
