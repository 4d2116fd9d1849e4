"""Scalar rules as Spark column expressions; nothing here leaves whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Precedence of release-date sources, best first.
RELEASE_SOURCES = ("published", "observed", "announced", "scheduled", "derived")
SUPPRESSED = "."


def standard_code(c: Column) -> Column:
    """A trimmed contract code; digits alone are padded to six places, longer ones never cut."""
    c = F.trim(c.cast("string"))
    return F.when(c.rlike("^[0-9]+$") & (F.length(c) < 6), F.lpad(c, 6, "0")).otherwise(c)


def clean_name(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def to_number(c: Column, kind: str = "double") -> Column:
    """Number of a published figure; the suppression mark and other text become null."""
    return F.trim(c.cast("string")).try_cast("double").cast(kind) if kind != "long" else F.trim(c.cast("string")).try_cast("double").try_cast("long")


def mixed_date(c: Column, formats: Sequence[str] = ("yyyy-MM-dd", "M/d/yyyy", "yyyyMMdd", "yyMMdd", "MMM d, yyyy", "MMMM d, yyyy")) -> Column:
    """The date by the first format that fits; null if none does."""
    c = F.trim(c.cast("string"))
    tries = [F.try_to_timestamp(c, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(F.try_to_timestamp(F.regexp_replace(c, "[ T].*$", ""), F.lit("yyyy-MM-dd")).cast("date"), *tries)


def tolerant_timestamp(c: Column) -> Column:
    """UTC timestamp of an ISO string, with or without a zone; null if it is none."""
    return F.try_to_timestamp(F.trim(c))


def canonical_value(c: Column, kind: str) -> Column:
    """The text a value is hashed as, whatever type it is stored in: nulls empty, whole numbers without a point."""
    if kind == "boolean":
        return F.when(c.isNull(), "").when(c, "1").otherwise("0")
    if kind in ("double", "float") or kind.startswith("decimal"):
        d = c.cast("double")
        whole = (d == F.floor(d)) & (F.abs(d) < 1e15)
        fraction = F.regexp_replace(d.try_cast("decimal(28,10)").cast("string"), r"\.?0+$", "")
        return F.when(d.isNull() | F.isnan(d), "").when(whole, d.try_cast("long").cast("string")).otherwise(F.coalesce(fraction, d.cast("string")))
    return F.coalesce(c.cast("string"), F.lit(""))


def row_hash(fields: Mapping[str, Column]) -> Column:
    """SHA-256 of ``name=value`` pairs in the given order; values are canonical texts."""
    return F.sha2(F.concat_ws("|", *[F.concat(F.lit(f"{name}="), c) for name, c in fields.items()]), 256)


def content_sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def short_id(*parts: Column, size: int = 16) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, size)


def snapshot_id(retrieved_at: Column, tag: Column, url: Column) -> Column:
    return F.concat_ws("_", F.date_format(retrieved_at, "yyyyMMdd'T'HHmmss'Z'"), tag, F.substring(F.sha2(url, 256), 1, 8))


def delta(old: Column, new: Column) -> tuple[Column, Column]:
    """(difference, share of the old value): null where a side is, the share also where the old value is 0."""
    change = new - old
    return change, F.try_divide(change, F.nullif(old, F.lit(0.0)))


def age_days(detected_at: Column, report_date: Column) -> Column:
    return F.datediff(detected_at.cast("date"), report_date.cast("date"))


def _weekday(d: Column) -> Column:
    return F.weekday(d)


def derive_release(report_date: Column) -> Column:
    """Three days later; a Saturday or Sunday moves to Monday."""
    d = F.date_add(report_date.cast("date"), 3)
    return F.date_add(d, F.when(_weekday(d) == 5, 2).when(_weekday(d) == 6, 1).otherwise(0))


def report_date_for_release(release: Column) -> Column:
    """The last Tuesday at least three days before a release."""
    d = F.date_sub(release.cast("date"), 3)
    return F.date_sub(d, F.pmod(_weekday(d) - 1, F.lit(7)))


def observed_within(first_seen: Column, report_date: Column, days: int = 4) -> Column:
    """First sighting as a release date if it is 0 to ``days`` days after the report date, never before."""
    return F.when(F.datediff(first_seen.cast("date"), report_date.cast("date")).between(0, days), first_seen.cast("date"))


def resolve_release(report_date: Column, published: Column, observed: Column, announced: Column, scheduled: Column) -> tuple[Column, Column]:
    """(release date, its source) by precedence; the derived date is the last resort."""
    dates = dict(zip(RELEASE_SOURCES, (published, observed, announced, scheduled, derive_release(report_date)), strict=True))
    source = F.lit(None).cast("string")
    for name in reversed(RELEASE_SOURCES):
        source = F.when(dates[name].isNotNull(), name).otherwise(source)
    return F.coalesce(*dates.values()), source


def http_release_date(header: Column, zone: str = "America/New_York") -> Column:
    """Date in ``zone`` of an HTTP date such as ``Fri, 24 Jul 2026 19:30:05 GMT``."""
    utc = F.try_to_timestamp(F.regexp_replace(F.substring(header, 6, 30), " GMT$", " +0000"), F.lit("dd MMM yyyy HH:mm:ss Z"))
    return F.from_utc_timestamp(utc, zone).cast("date")


def strip_tags(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), "[ \t\n\r]+", " "))


def plain_text(html: Column) -> Column:
    """Tags and the commonest entities gone, blanks collapsed."""
    for entity, char in (("&nbsp;", " "), (" ", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        html = F.replace(html, F.lit(entity), F.lit(char))
    return strip_tags(html)


def between_markers(text: Column, start: str, end: str) -> Column:
    """What stands between two marks; the whole text where the first is missing, the rest where the second is."""
    a = F.instr(text, start)
    rest = F.substr(text, a + len(start))
    b = F.instr(rest, end)
    return F.when(a == 0, text).when(b == 0, rest).otherwise(F.substr(rest, F.lit(1), b - 1))


def rounding_tolerance(n: Column) -> Column:
    """What n rounded parts may miss their total by."""
    return F.greatest(F.lit(1), n)


def expectation(report_year: Column, current_year: Column) -> Column:
    """How a source is expected to behave: by the week, still changing, frozen but re-served, or frozen for good."""
    return F.when(report_year.isNull(), "weekly").when(report_year >= current_year, "churn").when(report_year == current_year - 1, "frozen_in_window").otherwise("frozen_out_of_window")


def quiet_days(since: Column, now: Column) -> Column:
    return (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(since.cast("timestamp"))) / 86400


def asset_defaults(asset_class: Column, report_type: Column, is_equity: Column) -> tuple[Column, Column]:
    """(is_equity, report_type) with the defaults of the asset class."""
    financial = asset_class.isin("Equities", "FX", "Rates", "Currencies", "Fixed Income", "Crypto")
    return F.coalesce(is_equity, asset_class == "Equities"), F.coalesce(report_type, F.when(financial, "tff").otherwise("disagg"))
