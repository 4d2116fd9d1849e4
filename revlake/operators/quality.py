"""Data-quality operators: identities, rates, keys, vocabularies and coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.functions import scalar as S
from revlake.schema import NATURAL_KEY, SIDE_FIELDS, VOCABULARY


#: Warnings that a validation spells out.
WARNINGS = 100


class ValidationError(ValueError):
    """Rows that must not be stored."""


def zero_sum(df: DataFrame, keys: Sequence[str] = ("report_date", "market_code", "report_type", "combined"), long: str = "long_contracts", short: str = "short_contracts", spread: str | None = "spread_contracts", total: str | None = "open_interest") -> DataFrame:
    """Per group: both side totals (spread counts on both), imbalance, whether it is zero, within rounding, and what open interest exceeds the long side by."""
    missing = {c for c in (*keys, long, short) if c not in df.columns}
    if missing:
        raise ValidationError(f"zero-sum needs columns {sorted(missing)}")
    add = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long") if c and c in df.columns else F.lit(0).cast("long")
    g = df.groupBy(*keys).agg(add(long).alias("l"), add(short).alias("s"), add(spread).alias("spread_total"), F.count("*").alias("n_rows"), (F.max(total) if total and total in df.columns else F.lit(None).cast("long")).alias("oi"))
    imbalance = F.col("l") - F.col("s")
    return g.select(
        *keys, (F.col("l") + F.col("spread_total")).alias("long_total"), (F.col("s") + F.col("spread_total")).alias("short_total"), "spread_total", "n_rows", imbalance.alias("imbalance"), (imbalance == 0).alias("balanced"),
        (F.abs(imbalance) <= S.rounding_tolerance(F.col("n_rows"))).alias("within_tolerance"), (F.col("oi") - F.col("l") - F.col("spread_total")).alias("oi_gap"),
    )


def zero_sum_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count("*").alias("n"), F.count_if("balanced").alias("balanced"), F.count_if(~F.col("within_tolerance")).alias("outside_tolerance"))


def null_rate(df: DataFrame, by: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Share of nulls of each named expression per group."""
    return df.groupBy(*by).agg(*[F.avg(c.isNull().cast("double")).alias(n) for n, c in columns.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def outside_vocabulary(df: DataFrame, vocabulary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose value is not listed."""
    return df.join(vocabulary, list(on), "left_anti")


def side_breach(parts: DataFrame, totals: DataFrame, key: str, part: str, total: str) -> DataFrame:
    """Totals that the sum of their parts exceeds by more than rounding: key, total, side_total, n."""
    summed = parts.groupBy(key).agg(F.sum(part).alias("side_total"), F.count("*").alias("n"))
    return totals.select(key, total).join(summed, key).where(F.col("side_total") > F.col(total) + S.rounding_tolerance(F.col("n")))


def coverage(df: DataFrame, code: str = "market_code", date: str = "report_date", name: str | None = "market_name") -> DataFrame:
    """Per year and code: first and last date, number of distinct dates, and the name at the latest date that has one."""
    extra = [latest_name(name, date).alias("market_name")] if name else []
    return df.groupBy(F.year(date).alias("report_year"), F.col(code).alias("market_code")).agg(F.min(date).alias("first_report_date"), F.max(date).alias("last_report_date"), F.countDistinct(date).alias("n_weeks"), *extra)


def latest_name(name: str, order: str) -> Column:
    """The name at the greatest order value, nulls and blanks skipped, ties by name: not the greatest name."""
    clean = S.clean_name(F.col(name))
    return F.max_by(clean, F.when(clean.isNotNull(), F.struct(F.col(order), clean)))


def coverage_changes(cov: DataFrame, year: str = "report_year", code: str = "market_code") -> DataFrame:
    """(report_year, change, market_code): codes that enter and exit between consecutive years; one ``gap`` row where years are missing.

    Per code the years are scanned once: a code enters in a year that follows one of the table in which it was absent.
    """
    pairs = cov.select(F.col(year).cast("int").alias("y"), F.col(code).alias("k")).distinct()
    years = pairs.select("y").distinct().withColumn("p", F.lag("y").over(Window.orderBy("y"))).withColumn("x", F.lead("y").over(Window.orderBy("y")))
    w = Window.partitionBy("k").orderBy("y")
    seen = pairs.withColumns({"before": F.lag("y").over(w), "after": F.lead("y").over(w)}).join(F.broadcast(years), "y")
    enter = seen.where("p = y - 1 and (before is null or before < p)").select(F.col("y").alias("report_year"), F.lit("enter").alias("change"), F.col("k").alias("market_code"))
    leave = seen.where("x = y + 1 and (after is null or after > x)").select(F.col("x"), F.lit("exit"), F.col("k"))
    gap = years.where("p is not null and p <> y - 1").select("y", F.lit("gap"), F.lit(None).cast(pairs.schema["k"].dataType))
    return enter.union(leave).union(gap)


def interval_gaps(df: DataFrame, key: str, date: str, usual: int = 7) -> DataFrame:
    """(key, d, gap): days since the key's date before, where they aren't the usual number."""
    days = df.select(key, F.col(date).cast("date").alias("d")).distinct()
    return days.withColumn("gap", F.datediff("d", F.lag("d").over(Window.partitionBy(key).orderBy("d")))).where(F.col("gap") != usual)


def validate(df: DataFrame, null_band: float = 0.20) -> list[str]:
    """Raise for rows that must not be stored; return warnings about those that may: at most ``WARNINGS``, and how many more there are."""
    missing = [c for c in NATURAL_KEY if c not in df.columns]
    if missing:
        raise ValidationError(f"missing key columns {missing}")
    spark = df.sparkSession
    words = spark.createDataFrame([(t, c) for t, cs in VOCABULARY.items() for c in cs], "report_type string, category string")
    keyed = df.groupBy(*NATURAL_KEY).agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in SIDE_FIELDS])
    known = F.broadcast(words.withColumn("known", F.lit(True)))
    per = keyed.join(known, ["report_type", "category"], "left").groupBy("report_type", "category").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated"), F.max("known").alias("known"),
        F.count_if(F.greatest(*[F.col(c).isNull() for c in NATURAL_KEY])).alias("null_keys"), *[F.sum(f"null_{c}").alias(f"null_{c}") for c in SIDE_FIELDS],
    ).collect()
    if not per:
        raise ValidationError("no rows")
    if sum(r["null_keys"] for r in per):
        raise ValidationError("null in a key column")
    types = {r["report_type"] for r in per} - set(VOCABULARY)
    if types:
        raise ValidationError(f"unknown report types {sorted(types)}")
    odd = sorted({(r["report_type"], r["category"]) for r in per if not r["known"]})
    if odd:
        raise ValidationError(f"categories outside their report's vocabulary: {odd}")
    if sum(r["repeated"] for r in per):
        sample = duplicate_keys(df, NATURAL_KEY).limit(3).collect()
        raise ValidationError(f"repeated keys, such as {[tuple(map(str, r)) for r in sample]}")
    for r in per:
        for c in SIDE_FIELDS:
            if r[f"null_{c}"] > null_band * r["n"]:
                raise ValidationError(f"{r['report_type']}/{r['category']}: {c} is null in {r[f'null_{c}']} of {r['n']} rows")
    checked = zero_sum(df).where(F.col("oi_gap") < -S.rounding_tolerance(F.col("n_rows")))
    first = checked.orderBy("report_date", "market_code", "report_type").limit(WARNINGS + 1).collect()
    out = [f"{r['report_type']} {r['market_code']} {r['report_date']}: positions exceed open interest by {-r['oi_gap']}" for r in first[:WARNINGS]]
    return out + ([f"and {checked.count() - WARNINGS} more such weeks"] if len(first) > WARNINGS else [])


def year_counts(df: DataFrame, year: Column, code: str, date: str) -> DataFrame:
    """(y, markets, first_date, last_date) per year."""
    return df.groupBy(year.alias("y")).agg(F.countDistinct(code).alias("markets"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def category_migration(revisions: DataFrame, week: Sequence[str] = ("report_date", "market_code", "report_type", "combined", "new_snapshot_id"), category: str = "category", tolerance: float = 0) -> DataFrame:
    """(week, field, n, moved): weeks in which a snapshot changed a field of several categories and left its total as it was.

    That is what a reclassification of traders looks like; ``moved`` is what went from some categories to others.
    """
    g = revisions.where("delta is not null").groupBy(*week, "field").agg(F.countDistinct(category).alias("n"), F.sum("delta").alias("total"), (F.sum(F.abs("delta")) / 2).alias("moved"))
    return g.where((F.col("n") > 1) & (F.abs("total") <= tolerance)).drop("total")


def row_count_band(counts: DataFrame, by: Sequence[str], order: str, n: str, band: float = 0.2) -> DataFrame:
    """Rows whose count differs from that of the row before by more than ``band`` of it: by, order, n, before, share."""
    before = F.lag(n).over(Window.partitionBy(*by).orderBy(order))
    rows = counts.withColumn("before", before).withColumn("share", F.abs(F.try_divide(F.col(n) - F.col("before"), F.col("before"))))
    return rows.where(F.col("share") > band)


def release_gaps(observations: DataFrame, days: int = 3) -> DataFrame:
    """Releases that aren't ``days`` days after their report date, or unknown: report_date, release_date, release_date_source, gap, n."""
    rows = observations.withColumn("gap", F.datediff(F.col("release_date").cast("date"), F.col("report_date").cast("date")))
    return rows.where(~F.col("gap").eqNullSafe(F.lit(days))).groupBy("report_date", "release_date", "release_date_source", "gap").agg(F.count("*").alias("n"))
