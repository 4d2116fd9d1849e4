"""Release dates: which day a report's figures became public, and how that is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.functions import scalar as S
from revlake.operators.bitemporal import first_by_key

#: Rank of the sources that a stored schedule may have.
RANK = {"published": 3, "announced": 2, "scheduled": 1}


def rank_of(source: Column) -> Column:
    out = F.lit(0)
    for name, rank in RANK.items():
        out = F.when(source == name, rank).otherwise(out)
    return out


def best_schedule(schedule: DataFrame) -> DataFrame:
    """The schedule's best-ranked row of each report date; of equal ranks the earliest ingested."""
    return first_by_key(schedule, ["report_date"], [rank_of(F.col("source")).desc(), F.col("ingested_at").asc(), F.col("release_date").asc()])


def merge_schedule(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables with the last ingested row of each (report date, source); a new row wins over a stored one of the same time."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return first_by_key(both, ["report_date", "source"], [F.col("_new").desc(), F.col("ingested_at").desc(), F.col("release_date").desc()]).drop("_new")


def newest_plan(plans: DataFrame, by: list[str], announced: str) -> DataFrame:
    """All rows of the newest plan: a plan replaces the one before as a whole, never row by row. Undated rows count only if all are."""
    newest = F.max(announced).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    return plans.withColumn("_m", newest).where(F.col("_m").isNull() | (F.col(announced) == F.col("_m"))).drop("_m")


def first_sightings(observations: DataFrame) -> DataFrame:
    """When a report date was first seen, in any market and report."""
    return observations.groupBy("report_date").agg(F.min("observed_at").alias("first_seen"))


def backfill(observations: DataFrame, schedule: DataFrame, window_days: int = 4) -> DataFrame:
    """Observations with release_date and release_date_source resolved by precedence.

    The schedule and the first sightings have one row per report date, some thousands in all: both join by broadcast
    where the optimizer's size estimate allows it, and by shuffle where not.
    """
    best = best_schedule(schedule).select("report_date", F.col("release_date").alias("_release"), F.col("source").alias("_source"))
    rows = observations.drop("release_date", "release_date_source").join(first_sightings(observations), "report_date", "left").join(best, "report_date", "left")
    of = lambda name: F.when(F.col("_source") == name, F.col("_release"))
    date, source = S.resolve_release(F.col("report_date"), of("published"), S.observed_within(F.col("first_seen"), F.col("report_date"), window_days), of("announced"), of("scheduled"))
    return rows.withColumns({"release_date": date, "release_date_source": source}).select(*observations.columns)


def source_counts(observations: DataFrame) -> DataFrame:
    """(release_date_source, n) for every source in the order of precedence, zeros included."""
    spark = observations.sparkSession
    names = spark.createDataFrame([(s, i) for i, s in enumerate((*S.RELEASE_SOURCES, "unknown"))], "release_date_source string, place int")
    counts = observations.groupBy("release_date_source").agg(F.count("*").alias("n"))
    return F.broadcast(names).join(counts, "release_date_source", "left").select("release_date_source", F.coalesce("n", F.lit(0)).alias("n"), "place").orderBy("place").drop("place")


def point_in_time_only(observations: DataFrame) -> DataFrame:
    """Only rows whose release date was known, not derived by rule."""
    return observations.where("release_date_source <> 'derived'")
