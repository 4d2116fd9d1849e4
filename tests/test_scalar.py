from datetime import date

import pytest
from pyspark.sql import functions as F

from revlake.functions import scalar as S


def values(spark, given, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", f(F.col("v"))).orderBy("i").collect()]


def test_codes_and_names(spark):
    assert values(spark, ["1602", " 088691 ", "13874A", "13874+", "1234567", None], S.standard_code) == ["001602", "088691", "13874A", "13874+", "1234567", None]
    assert values(spark, [" GOLD ", "", "  ", None], S.clean_name) == ["GOLD", None, None, None]


def test_numbers_and_dates(spark):
    assert values(spark, ["12", ".", "200,000", "", " 7.5 ", None, "1e3"], S.to_number) == [12.0, None, None, None, 7.5, None, 1000.0]
    assert values(spark, ["12", ".", "12.0"], lambda c: S.to_number(c, "long")) == [12, None, 12]
    want = date(2026, 7, 21)
    assert values(spark, ["2026-07-21", "7/21/2026", "07/21/2026", "260721", "July 21, 2026", "2026-07-21 00:00:00", "x", None], S.mixed_date) == [want] * 6 + [None, None]


def test_canonical_values_do_not_depend_on_type(spark):
    assert values(spark, [20.0, 20.5, 0.1, -3.0, float("nan"), None, 1e18], lambda c: S.canonical_value(c, "double"), "double")[:6] == ["20", "20.5", "0.1", "-3", "", ""]
    assert values(spark, [20, None], lambda c: S.canonical_value(c, "long"), "long") == ["20", ""]
    assert values(spark, [True, False, None], lambda c: S.canonical_value(c, "boolean"), "boolean") == ["1", "0", ""]


def test_release_rules(spark):
    days = [date(2026, 7, 21), date(2026, 7, 22), date(2026, 7, 23), date(2026, 7, 24)]
    assert values(spark, days, S.derive_release, "date") == [date(2026, 7, 24), date(2026, 7, 27), date(2026, 7, 27), date(2026, 7, 27)]
    assert values(spark, [date(2026, 7, 24), date(2026, 7, 27), date(2026, 1, 5)], S.report_date_for_release, "date") == [date(2026, 7, 21), date(2026, 7, 21), date(2025, 12, 30)]
    headers = ["Fri, 24 Jul 2026 19:30:05 GMT", "Sat, 25 Jul 2026 02:00:00 GMT", "nonsense", None]
    assert values(spark, headers, S.http_release_date) == [date(2026, 7, 24), date(2026, 7, 24), None, None]


@pytest.mark.parametrize("seen,want", [("2026-07-20", None), ("2026-07-21", "observed"), ("2026-07-25", "observed"), ("2026-07-26", None)])
def test_precedence(spark, seen, want):
    d = lambda s: F.lit(s).cast("date")
    none = F.lit(None).cast("date")
    observed = S.observed_within(d(seen), d("2026-07-21"))
    pick = lambda *c: tuple(spark.range(1).select(*S.resolve_release(d("2026-07-21"), *c)).first())
    assert pick(none, observed, none, none)[1] == (want or "derived")
    assert pick(d("2026-07-24"), observed, d("2026-07-28"), d("2026-07-27")) == (date(2026, 7, 24), "published")
    assert pick(none, none, d("2026-07-28"), d("2026-07-27")) == (date(2026, 7, 28), "announced")
    assert pick(none, none, none, d("2026-07-27")) == (date(2026, 7, 27), "scheduled")


def test_text(spark):
    assert values(spark, ["<p>a&nbsp;b</p>\n<b>c &amp; d</b>"], S.plain_text) == ["a b c & d"]
    assert values(spark, ["x[START]y[END]z", "no marks", "x[START]rest"], lambda c: S.between_markers(c, "[START]", "[END]")) == ["y", "no marks", "rest"]
