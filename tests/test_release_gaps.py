"""Releases outside the usual three days after their report date."""

import datetime

from revlake.operators import quality as Q


def test_release_gaps(spark):
    day = lambda d: d and datetime.date(2026, 7, d)
    rows = [(day(7), day(10), "published"), (day(14), day(20), "observed"), (day(14), day(20), "observed"), (day(21), day(23), "announced"), (day(28), None, None)]
    got = Q.release_gaps(spark.createDataFrame(rows, "report_date date, release_date date, release_date_source string")).collect()
    assert sorted((r.report_date.day, r.gap, r.n) for r in got if r.gap) == [(14, 6, 2), (21, 2, 1)]
    assert [(r.report_date.day, r.n) for r in got if r.gap is None] == [(28, 1)] and len(got) == 3
    assert Q.release_gaps(spark.createDataFrame([], "report_date date, release_date date, release_date_source string")).count() == 0
