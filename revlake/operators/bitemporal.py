"""Operators over tables whose published rows are later revised."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.functions import scalar as S


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; null keys form one group, nulls in the order come first."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def asof(df: DataFrame, t: Column | None, keys: Sequence[str], order: Sequence[str], where: Column | None = None) -> DataFrame:
    """What was known at ``t``: the latest row per key among those whose first order column is at most ``t``."""
    if t is not None:
        df = df.where(F.col(order[0]) <= t)
    if where is not None:
        df = df.where(where)
    return latest_by_key(df, keys, order)


def asof_join(points: DataFrame, log: DataFrame, keys: Sequence[str], time: str, log_time: str, values: Sequence[str]) -> DataFrame:
    """Each point with the values of the last log row of its key at or before its time; points without one stay, with nulls.

    One sort per key instead of a range join: points and log are stacked, and the last log row is carried forward.
    Of log rows with one time the one with the greatest values wins.
    """
    held = [c for c in points.columns if c not in keys]
    right = log.select(*keys, F.col(log_time).alias("_t"), F.lit(0).alias("_side"), F.struct(F.col(log_time), *values).alias("_log"), *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in held])
    left = points.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema["_log"].dataType).alias("_log"), *held)
    w = Window.partitionBy(*keys).orderBy("_t", "_side", "_log").rowsBetween(Window.unboundedPreceding, 0)
    both = left.unionByName(right).withColumn("_last", F.last("_log", ignorenulls=True).over(w)).where("_side = 1")
    return both.select(*points.columns, *[F.col(f"_last.{v}").alias(v) for v in values])


def change_only(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column) -> DataFrame:
    """The rows whose value differs from that of the row before: a bulk rebuild of in-order vintages."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_v", value).withColumn("_before", F.lag("_v").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    return marked.where("_first or not (_before <=> _v)").drop("_v", "_before", "_first")


def field_revisions(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Mapping[str, str], digits: int | None = None) -> DataFrame:
    """One row per field that differs from the vintage before: keys, order[0], field, old_value, new_value, delta, pct_delta."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(F.struct(*[F.col(c).alias(n) for n, c in fields.items()])).over(w)
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"_before.{n}").cast("double").alias("old_value"), F.col(c).cast("double").alias("new_value")) for n, c in fields.items()]))
    rows = df.withColumn("_before", before).where("_before is not null").select(*keys, order[0], pairs.alias("_p")).select(*keys, order[0], "_p.*")
    change, share = S.delta(F.col("old_value"), F.col("new_value"))
    if digits is not None:
        change, share = F.round(change, digits), F.round(share, digits)
    return rows.where("not (old_value <=> new_value)").withColumns({"delta": change, "pct_delta": share})


def recent(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The n greatest rows by ``order``: a top-k report."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def melt(df: DataFrame, keep: Sequence[str], values: Mapping[str, Mapping[str, Column]], name: str = "category") -> DataFrame:
    """One row per entry of ``values`` with its columns; rows whose values are null stay."""
    rows = [F.struct(F.lit(n).alias(name), *[c.alias(k) for k, c in columns.items()]) for n, columns in values.items()]
    return df.select(*keep, F.explode(F.array(*rows)).alias("_m")).select(*keep, "_m.*")


def diff(incoming: DataFrame, stored: DataFrame, keys: Sequence[str], order: Sequence[str], value_fields: Sequence[str], at=None) -> tuple[DataFrame, DataFrame]:
    """(new observations, revisions) of ``incoming``, whose rows have one (observed_at, snapshot_id), against what was known then.

    A row is written when its key is new or its hash differs from the latest stored at or before its own
    observed_at, and when it isn't stored already: a replay writes nothing, a late snapshot only what it changed. ``_unexplained`` marks
    observations whose hash differs from the one before though no field does. ``at``: the observed_at, if the caller knows it.
    """
    at = incoming.agg(F.max(order[0])).first()[0] if at is None else at
    known = stored.where(F.col(order[0]) <= F.lit(at))
    values = F.struct(*[c for c in stored.columns if c not in keys])
    prior = known.groupBy(*keys).agg(F.max_by(values, F.struct(*order)).alias("_old"), F.collect_set(F.when(F.col(order[0]) == F.lit(at), F.col(order[1]))).alias("_same"))
    joined = incoming.alias("n").join(prior.alias("p"), [F.col(f"n.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys], "left")
    fresh = joined.where(F.col("_old").isNull() | (F.col("_old.row_sha256") != F.col("n.row_sha256"))).where(~F.coalesce(F.array_contains("_same", F.col(f"n.{order[1]}")), F.lit(False))).select("n.*", "_old")
    kinds = dict(incoming.dtypes)
    text = lambda c, f: S.canonical_value(c, kinds[f])
    pairs = [
        F.struct(
            F.lit(f).alias("field"), text(F.col(f"_old.{f}"), f).alias("old_value"), text(F.col(f), f).alias("new_value"),
            F.col(f"_old.{f}").cast("double").alias("o"), F.col(f).cast("double").alias("w"),
        )
        for f in value_fields
    ]
    change, share = S.delta(F.col("_p.o"), F.col("_p.w"))
    fresh = fresh.withColumn("_changed", F.filter(F.array(*pairs), lambda p: p.old_value != p.new_value))
    revisions = (
        fresh.where("_old is not null")
        .withColumn("_p", F.explode("_changed"))
        .select(
            *keys, "_p.field", "_p.old_value", "_p.new_value", change.alias("delta"), share.alias("pct_delta"),
            F.col("_old.snapshot_id").alias("old_snapshot_id"), F.col("snapshot_id").alias("new_snapshot_id"), F.col("observed_at").alias("detected_at"), S.age_days(F.col("observed_at"), F.col("report_date")).alias("age_days"),
            S.short_id(*[F.col(k) for k in keys], F.col("_p.field"), F.col("_old.snapshot_id"), F.col("snapshot_id")).alias("revision_id"),
        )
    )
    return fresh.withColumn("_unexplained", F.col("_old").isNotNull() & (F.size("_changed") == 0)).drop("_old", "_changed"), revisions


def rebuild(vintages: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All observations that differ from the vintage before, in one pass; as ``diff`` applied to the vintages in order."""
    return change_only(vintages, keys, order, F.col("row_sha256"))


def tombstones(prior: DataFrame, incoming: DataFrame, keys: Sequence[str], scope: Sequence[str]) -> DataFrame:
    """Rows of ``prior`` whose key ``incoming`` lacks though it covers their scope, such as a report and date."""
    covered = incoming.select(*scope).distinct()
    return prior.join(covered, list(scope), "left_semi").join(incoming.select(*keys), list(keys), "left_anti")


def revision_stats(revisions: DataFrame, by: Sequence[str] = ("report_type", "field")) -> DataFrame:
    """Per group: revisions, keys revised, mean and greatest share of change, mean and greatest age."""
    share = F.abs("pct_delta")
    return revisions.groupBy(*by).agg(
        F.count("*").alias("n"), F.countDistinct("report_date", "market_code", "category").alias("keys"), F.avg(share).alias("mean_share"), F.max(share).alias("max_share"), F.avg("age_days").alias("mean_age"), F.max("age_days").alias("max_age"),
    )
