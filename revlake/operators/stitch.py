"""Continuous series: an instrument's history with that of its predecessor codes behind it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.operators.bitemporal import first_by_key


def code_names(registry: DataFrame) -> DataFrame:
    """(code, symbol, scale, priority) of current (priority 0) and predecessor codes."""
    now = registry.select(F.col("code"), "symbol", F.lit(1.0).alias("scale"), F.lit(0).alias("priority"))
    old = registry.select("symbol", F.posexplode("predecessors").alias("i", "p")).select("p.code", "symbol", "p.scale", (F.col("i") + 1).alias("priority"))
    return now.unionByName(old)


def resolve(names: DataFrame, registry: DataFrame, column: str = "name") -> DataFrame:
    """Each asked name with its registry row: by symbol, else by current code, else with nulls."""
    by_symbol = registry.withColumn("_by", F.lit(1))
    by_code = registry.withColumn("_by", F.lit(2))
    a = names.join(by_symbol, F.col(column) == F.col("symbol"), "left")
    b = a.where("_by is null").select(*names.columns).join(by_code, F.col(column) == F.col("code"), "left")
    return a.where("_by is not null").unionByName(b).drop("_by")


def stitch(rows: DataFrame, codes: DataFrame, code: str, date: str, scaled: list[str], keep: list[str] = ()) -> DataFrame:
    """(symbol, date, scaled columns, keep, priority): each date once per symbol, from its current code or else the first predecessor that has it.

    ``codes`` is that of ``code_names``; how to join it is left to the optimizer. Positions are multiplied by the
    predecessor's contract scale, other columns stay; all rows carry the symbol's current code where ``keep`` asks for it.
    """
    codes = codes.withColumnRenamed("code", "_code")
    both = rows.join(codes, F.col(code) == F.col("_code"))
    values = [(F.col(c) * F.col("scale")).alias(c) for c in scaled]
    both = both.select("symbol", date, *values, *keep, "priority")
    return first_by_key(both, ["symbol", date], [F.col("priority").asc(), *[F.col(c).asc_nulls_last() for c in scaled]])
