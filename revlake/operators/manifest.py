"""Operations analytics over manifests: entries (half, domain, name, last_date, n_rows, source, updated_at) of what a store holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENTRY = "domain string, name string, last_date date, n_rows long, source string, updated_at timestamp"


def summarise(entries: DataFrame, today: Column | None = None) -> DataFrame:
    """Per domain: entries, rows, newest and oldest date, last write, and days behind ``today``."""
    out = entries.groupBy("domain").agg(F.count("*").alias("entries"), F.sum("n_rows").alias("n_rows"), F.max("last_date").alias("newest"), F.min("last_date").alias("oldest"), F.max("updated_at").alias("last_write"))
    return out.withColumn("days_behind", F.datediff(today if today is not None else F.current_date(), "newest"))


def lagging(entries: DataFrame, by: Sequence[str], time: str, behind: Column, but: Column | None = None) -> DataFrame:
    """Entries that are more than an interval behind the newest of their group."""
    newest = F.max(time).over(Window.partitionBy(*by))
    out = entries.withColumn("_newest", newest).where(F.col("_newest") > F.col(time) + behind)
    return (out.where(~but) if but is not None else out).drop("_newest")


def lag_days(entries: DataFrame, retired: Sequence[str] = (), ignore: Sequence[str] = (), threshold: int = 3) -> DataFrame:
    """(domain, name, days): entries whole days behind their domain's last write; a time that can't be read counts as 9999."""
    newest = F.max("updated_at").over(Window.partitionBy("domain"))
    days = F.coalesce(F.floor((F.unix_timestamp(newest) - F.unix_timestamp("updated_at")) / 86400).cast("int"), F.lit(9999))
    out = entries.withColumn("days", days).where(F.col("days") > threshold)
    if retired:
        out = out.where(~F.col("domain").isin(*retired))
    if ignore:
        out = out.where(~F.col("name").isin(*ignore))
    return out.select("domain", "name", "days").orderBy(F.col("days").desc(), "domain", "name")


def ghosts(entries: DataFrame, files: DataFrame, on: Sequence[str]) -> DataFrame:
    """Entries without what they describe."""
    return entries.join(files, list(on), "left_anti")


def overlay(preferred: DataFrame, fallback: DataFrame, on: Sequence[str]) -> DataFrame:
    """All preferred rows, and those fallback rows whose key no preferred row has."""
    return preferred.unionByName(fallback.join(preferred.select(*on).distinct(), list(on), "left_anti"))


def touch(entries: DataFrame, new: DataFrame) -> DataFrame:
    """Entries with those of ``new`` put in their place."""
    return overlay(new, entries, ["domain", "name"])


def describe(rows: DataFrame, domain: str, name: str, date: str, source: str) -> DataFrame:
    """An entry for each (domain, name) of a table."""
    return rows.groupBy(F.col(domain).alias("domain"), F.col(name).alias("name")).agg(F.max(date).cast("date").alias("last_date"), F.count("*").alias("n_rows")).withColumns({"source": F.lit(source), "updated_at": F.current_timestamp()})


def replica_diff(a: DataFrame, b: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Keys that both have, with different non-null values: on, sf (of a), df (of b)."""
    both = a.select(*on, F.col(value).alias("sf")).join(b.select(*on, F.col(value).alias("df")), list(on))
    return both.where("sf <> df")


def only_in(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key ``b`` lacks."""
    return a.join(b, list(on), "left_anti")


def common_keys(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.select(*on).intersect(b.select(*on))
