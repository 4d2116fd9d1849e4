"""Provenance of captured files: what a fetch brought, and what should alarm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.functions import scalar as S

BLIND_AFTER_DAYS = 9


def latest_matching(log: DataFrame, key: str, value: str, order: Sequence[str], kinds: dict[str, Column]) -> DataFrame:
    """Per key the value of the last row of each kind, null if it has none; in one pass."""
    place = F.struct(*order)
    return log.groupBy(key).agg(*[F.max_by(value, F.when(cond, place)).alias(n) for n, cond in kinds.items()])


def blind_alerts(log: DataFrame, key: str, time: str, delivered: Column, silent: Column, after: Column) -> DataFrame:
    """The first silent row of each quiet period that is later than its delivery plus ``after``: one alarm a period.

    A period runs from a delivery to the next; before the first delivery there is none.
    """
    w = Window.partitionBy(key).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    since = F.max(F.when(delivered, F.col(time))).over(w)
    rows = log.withColumns({"_n": F.count(F.when(delivered, 1)).over(w), "_since": since})
    late = rows.where(silent & (F.col("_n") > 0) & (F.col(time) > F.col("_since") + after))
    return late.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_n").orderBy(time))).where("_rn = 1").drop("_rn", "_n", "_since")


def classify(log: DataFrame, blind_after: int = BLIND_AFTER_DAYS) -> DataFrame:
    """Provenance rows (source_url, report_year, retrieved_at, http_status, content_sha256, error) with expectation, outcome, restatement_suspect and alert.

    ``outcome`` is failed, not_modified (304), first, deduped or changed, against the last row that had content.
    A frozen year that changes always alarms; one within the window that isn't re-served for ``blind_after``
    days alarms once per quiet period. Failed fetches never do.
    """
    url = Window.partitionBy("source_url").orderBy("retrieved_at", "content_sha256")
    before = url.rowsBetween(Window.unboundedPreceding, -1)
    content = F.col("error").isNull() & F.col("content_sha256").isNotNull() & ~F.coalesce(F.col("http_status") == 304, F.lit(False))
    year = F.year("retrieved_at")
    rows = log.withColumns({
        "_last": F.last(F.when(content, F.col("content_sha256")), ignorenulls=True).over(before),
        "_since": F.max(F.when(content, F.col("retrieved_at"))).over(before),
        "_n": F.count(F.when(content, 1)).over(url.rowsBetween(Window.unboundedPreceding, 0)),
        "expectation": S.expectation(F.col("report_year"), year),
    })
    outcome = F.when(F.col("error").isNotNull(), "failed").when(~content, "not_modified").when(F.col("_last").isNull(), "first").when(F.col("_last") == F.col("content_sha256"), "deduped").otherwise("changed")
    rows = rows.withColumn("outcome", outcome)
    quiet = S.quiet_days(F.col("_since"), F.col("retrieved_at"))
    silent = (F.col("expectation") == "frozen_in_window") & (F.col("outcome") == "not_modified") & (quiet > blind_after)
    rows = rows.withColumns({"_silent": F.coalesce(silent, F.lit(False)), "_quiet": quiet})
    first = F.row_number().over(Window.partitionBy("source_url", "_n", "_silent").orderBy("retrieved_at", "content_sha256")) == 1
    changed = F.col("outcome") == "changed"
    january = F.when(F.month("retrieved_at") == 1, "; it is January, when the year just ended is finalised").otherwise("")
    alert = (
        F.when(changed & (F.col("expectation") == "frozen_in_window"), F.concat(F.lit("content of the frozen prior year changed: a restatement"), january))
        .when(changed & (F.col("expectation") == "frozen_out_of_window"), F.concat(F.lit("content of a closed year changed that is never re-served"), january))
        .when(F.col("_silent") & first, F.format_string("blind: the frozen prior year was not re-served for %d days", F.floor("_quiet")))
    )
    rows = rows.withColumns({"restatement_suspect": changed & F.coalesce(F.col("report_year") < year, F.lit(False)), "alert": alert})
    return rows.drop("_last", "_since", "_n", "_silent", "_quiet")


def latest_status(events: DataFrame) -> DataFrame:
    """The last parse state of each snapshot, from append-only events (snapshot_id, parse_status, parse_error, at)."""
    w = Window.partitionBy("snapshot_id").orderBy(F.col("at").desc(), F.col("parse_status").desc())
    return events.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def flow_state(df: DataFrame, keys: Sequence[str], date: str, long: str, short: str) -> DataFrame:
    """What moved positions since the row before: keys, date, days_elapsed, state. An extension, not a published figure."""
    w = Window.partitionBy(*keys).orderBy(date)
    up, down = F.col(long) - F.lag(long).over(w), F.col(short) - F.lag(short).over(w)
    rows = df.select(*keys, date, up.alias("dl"), down.alias("ds"), F.datediff(date, F.lag(date).over(w)).alias("days_elapsed")).where("dl is not null")
    longs = F.when(F.col("dl") > 0, "new_longs").otherwise("long_liquidation")
    shorts = F.when(F.col("ds") > 0, "new_shorts").otherwise("short_covering")
    state = F.when((F.col("dl") == 0) & (F.col("ds") == 0), "quiet").when(F.abs("dl") >= F.abs("ds"), longs).otherwise(shorts)
    return rows.select(*keys, date, "days_elapsed", state.alias("state"))
