"""Release pages as column expressions over (url, html); a page whose layout has changed raises, a corpus of prose never does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.functions import scalar as S
from revlake.operators.bitemporal import first_by_key
from revlake.operators.release import newest_plan

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_HEADING = r"([A-Z][a-z]+ [0-9]{1,2},\s*[0-9]{4})\s*:"


class PageError(ValueError):
    """A page that isn't laid out as it used to be."""


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def table_rows(table: Column) -> Column:
    """Rows of a table as arrays of cell texts."""
    cells = lambda r: F.transform(_all(r, r"(?is)<t[dh][^>]*>(.*?)</t[dh]>", 1), S.plain_text)
    return F.transform(_all(table, r"(?is)<tr[^>]*>(.*?)</tr>", 1), cells)


def calendar(pages: DataFrame) -> DataFrame:
    """Schedule rows of release calendars: a heading with the year, then months with days, a star marking delays."""
    year = F.nullif(F.regexp_extract(S.strip_tags(F.col("html")), r"(?i)(20[0-9]{2})\s+Release Schedule", 1), F.lit("")).cast("int")
    table = F.regexp_extract("html", r"(?is)<table.*?</table>", 0)
    cells = pages.select("url", year.alias("year"), F.posexplode_outer(F.flatten(table_rows(table))).alias("place", "cell"))
    month = F.nullif(F.array_position(F.lit(MONTHS), F.col("cell")), F.lit(0))
    w = Window.partitionBy("url").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    days = cells.withColumns({"month": F.last(month, ignorenulls=True).over(w), "day": F.regexp_extract("cell", r"^([0-9]{1,2})\s*\*?$", 1)}).where("day <> '' and month is not null and year is not null")
    release = F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int"))
    note = F.when(F.col("cell").contains("*"), "delayed by a holiday").otherwise("published calendar")
    out = days.select("url", release.alias("release_date"), note.alias("note")).select(
        "url", S.report_date_for_release(F.col("release_date")).alias("report_date"), "release_date", F.lit("scheduled").alias("source"), "note", F.current_timestamp().alias("ingested_at"),
    )
    return _complete(pages, out, "no year heading, table or dates")


def announced(pages: DataFrame) -> DataFrame:
    """Schedule rows of the newest republication table of each page.

    Tables count by their header; a row counts if it has exactly three dates: report, old and new publication. A table
    belongs to the last dated heading before it, and the newest replaces all others as a whole.
    """
    pieces = F.split("html", r"(?is)(?=<table)")
    parts = pages.select("url", F.posexplode(pieces).alias("place", "piece"))
    last = F.element_at(F.concat(F.array(F.lit(None).cast("string")), _all(S.strip_tags(F.col("piece")), _HEADING, 1)), -1)
    table = F.regexp_extract("piece", r"(?is)^<table.*?</table>", 0)
    after = F.regexp_replace("piece", r"(?is)^<table.*?</table>", "")
    w = Window.partitionBy("url").orderBy("place")
    tail = F.element_at(F.concat(F.array(F.lit(None).cast("string")), _all(S.strip_tags(after), _HEADING, 1)), -1)
    dated = parts.withColumn("heading", F.last(F.when(F.col("place") == 0, last).otherwise(tail), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = dated.where("place > 0").select("url", "place", S.mixed_date(F.regexp_replace("heading", r"\s+", " ")).alias("announced_on"), table_rows(table).alias("rows"))
    header = F.lower(F.array_join(F.get("rows", F.lit(0)), " | "))
    rows = rows.where((F.size("rows") > 0) & header.contains("cot report date") & header.contains("new publish date"))
    dates = _all(F.array_join(F.col("cells"), " "), r"\b([0-9]{1,2}/[0-9]{1,2}/20[0-9]{2})\b", 1)
    plan = rows.select("url", "place", "announced_on", F.posexplode(F.slice("rows", F.lit(2), F.size("rows"))).alias("row", "cells")).withColumn("dates", dates).where("size(dates) = 3")
    plan = plan.withColumns({"report_date": S.mixed_date(F.get("dates", F.lit(0))), "release_date": S.mixed_date(F.get("dates", F.lit(2)))}).where("release_date >= report_date")
    plan = first_by_key(newest_plan(plan, ["url"], "announced_on"), ["url", "report_date"], [F.col("place").desc(), F.col("row").desc()])
    note = F.concat_ws(" ", F.lit("special announcement"), F.col("announced_on").cast("string"))
    out = plan.select("url", "report_date", "release_date", F.lit("announced").alias("source"), note.alias("note"), F.current_timestamp().alias("ingested_at"))
    return _complete(pages, out, "no republication table or no rows in it")


def announcements(pages: DataFrame, start: str = 'id="main-content"', end: str = "<footer", limit: int = 2000) -> DataFrame:
    """(url, announcement_date, raw_text): a row for each dated heading of a page's content, with the prose up to the next."""
    text = S.plain_text(S.between_markers(F.col("html"), start, end))
    marked = F.regexp_replace(text, _HEADING, "\x01$0\x02")
    items = pages.select("url", F.split(marked, "\x01").alias("parts")).select("url", F.explode(F.slice("parts", F.lit(2), F.size("parts"))).alias("item"))
    date = S.mixed_date(F.regexp_replace(F.regexp_extract("item", "^([^\x02:]*)", 1), r"\s+", " "))
    return items.select("url", date.alias("announcement_date"), F.substring(F.trim(F.translate("item", "\x02", "")), 1, limit).alias("raw_text")).dropDuplicates(["announcement_date", "raw_text"])


def _complete(pages: DataFrame, out: DataFrame, fault: str) -> DataFrame:
    bad = pages.select("url").join(out.select("url").distinct(), "url", "left_anti").limit(3).collect()
    if bad:
        raise PageError(f"{[r['url'] for r in bad]}: {fault}")
    return out
