from datetime import UTC, date, datetime, timedelta

import pytest
from helpers import wide_row, write_zip
from pyspark.sql import functions as F

from revlake import current, registry
from revlake.operators import bitemporal as B
from revlake.operators import quality as Q
from revlake.operators.canonical import canonicalise, resolve_header, stamped
from revlake.schema import CANONICAL, NATURAL_KEY, VALUE_FIELDS, VINTAGE_ORDER, VOCABULARY
from revlake.sources import archives
from revlake.sources.http import Response
from revlake.store import Store, StoreError
from revlake.streaming.ingest import blind_alarms, ingest_archives, ingest_canonical, tumbling
from revlake.vintage import Vintage

T0 = datetime(2026, 7, 24, 20, tzinfo=UTC)


def canonical(spark, tmp_path, report_type="legacy", rows=None, **kw):
    write_zip(tmp_path / "in" / f"{report_type}.zip", rows or [wide_row(report_type, **kw)])
    return canonicalise(archives.read_report(spark, str(tmp_path / "in" / f"{report_type}.zip"), report_type), report_type)


@pytest.mark.parametrize("report_type", list(VOCABULARY))
def test_melt_of_every_report(spark, tmp_path, report_type):
    got = canonical(spark, tmp_path, report_type, flag=None if report_type == "supplemental" else "FutOnly").collect()
    assert sorted(r.category for r in got) == sorted(VOCABULARY[report_type])
    assert {r.combined for r in got} == {report_type == "supplemental"} and {r.market_code for r in got} == {"088691"} and {r.report_date for r in got} == {date(2026, 7, 21)}
    first = next(r for r in got if r.category == VOCABULARY[report_type][0] or report_type == "supplemental")
    assert first.cr4_net_long == (None if report_type == "legacy" else 20.5) and first.open_interest > 0


def test_suppression_spelling_flags_and_layout(spark, tmp_path):
    row = wide_row("disaggregated", Traders_M_Money_Long_All=".")
    row["Swap_Positions_Short_All"] = row.pop("Swap__Positions_Short_All")
    got = {r.category: r for r in canonical(spark, tmp_path, "disaggregated", [row]).collect()}
    assert got["managed_money"].trader_count_long is None and got["swap"].short_contracts == 200
    with pytest.raises(archives.LayoutError):
        resolve_header(["a"], "Swap__Positions_Short_All")
    with pytest.raises(archives.LayoutError):
        canonical(spark, tmp_path, "tff", [wide_row("tff"), wide_row("tff", code="2", flag="Combined")])
    with pytest.raises(archives.LayoutError):
        canonical(spark, tmp_path, "tff", date="2126-01-01")


def test_union_by_name_and_year_range(spark, tmp_path):
    write_zip(tmp_path / "a.zip", [wide_row("tff", date="2006-01-03")])
    write_zip(tmp_path / "b.zip", [wide_row("tff", date="2017-01-03", Extra="x")])
    df = archives.read_report(spark, [str(tmp_path / "a.zip"), str(tmp_path / "b.zip")], "tff")
    assert sorted((r.report_date.year, r.Extra) for r in df.collect()) == [(2006, None), (2017, "x")]
    assert archives.read_report(spark, [str(tmp_path / "a.zip"), str(tmp_path / "b.zip")], "tff", (2010, 2020)).count() == 1


def test_ingest_is_change_only_and_point_in_time(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path / "s")))
    one = canonical(spark, tmp_path)
    assert v.asof().count() == 0
    assert v.ingest(one, "s1", T0) == {"observations": 3, "revisions": 0, "warnings": []}
    assert v.ingest(one, "s2", T0 + timedelta(days=1))["observations"] == 0
    changed = one.withColumn("long_contracts", F.when(F.col("category") == "commercial", 150).otherwise(F.col("long_contracts")))
    got = v.ingest(changed, "s3", T0 + timedelta(days=40))
    assert (got["observations"], got["revisions"]) == (1, 1)
    r = v.revisions().first()
    assert (r.field, r.old_value, r.new_value, r.delta, r.pct_delta, r.age_days, r.old_snapshot_id, r.new_snapshot_id) == ("long_contracts", "100", "150", 50.0, 0.5, 43, "s1", "s3")
    then, now = v.asof(T0 + timedelta(days=2)), v.asof()
    longs = lambda df: {r.category: r.long_contracts for r in df.collect()}
    assert longs(then)["commercial"] == 100 and longs(now)["commercial"] == 150 and now.count() == 3
    # replays, and a late snapshot that was overtaken, change nothing that was known
    for rows, name, at in ((one, "s1", T0), (changed, "s3", T0 + timedelta(days=40)), (one, "s2", T0 + timedelta(days=1))):
        again = v.ingest(rows, name, at)
        assert (again["observations"], again["revisions"]) == (0, 0)
    assert v.asof(report_date=date(2026, 7, 21), market_code="088691", report_type="legacy").count() == 3 and v.asof(market_code="x").count() == 0
    assert v.diff(T0 + timedelta(days=30)).count() == 1 == v.deep_revisions().count() and v.diff(T0 + timedelta(days=41)).count() == 0
    balanced = {r.report_date: r.balanced for r in v.zero_sum().collect()}
    assert balanced == {date(2026, 7, 21): False}


def test_same_time_snapshots_and_bulk_rebuild(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path / "s")))
    base = canonical(spark, tmp_path)
    vintages = None
    for k, value in enumerate([100, 120, 120, 100, 130]):
        rows = base.withColumn("long_contracts", F.when(F.col("category") == "commercial", value).otherwise(F.col("long_contracts")))
        v.ingest(rows, f"s{k}", T0 + timedelta(days=k), validate=False)
        part = stamped(rows, f"s{k}", T0 + timedelta(days=k))
        vintages = part if vintages is None else vintages.unionByName(part)
    key = [*NATURAL_KEY, *VINTAGE_ORDER, "row_sha256"]
    assert sorted(map(tuple, B.rebuild(vintages, NATURAL_KEY, VINTAGE_ORDER).select(*key).collect())) == sorted(map(tuple, v.observations().select(*key).collect()))
    tie = base.withColumn("long_contracts", F.lit(7).cast("long"))
    assert v.ingest(tie, "s0a", T0 + timedelta(days=4), validate=False)["observations"] == 3
    assert v.ingest(tie, "s0a", T0 + timedelta(days=4), validate=False)["observations"] == 0
    assert {r.long_contracts for r in v.asof().where("category = 'commercial'").collect()} == {130}


def test_validation(spark, tmp_path):
    good = canonical(spark, tmp_path)
    assert Q.validate(good) == []
    for bad in (
        good.drop("combined"), good.limit(0), good.withColumn("market_code", F.lit(None).cast("string")), good.withColumn("report_type", F.lit("other")), good.withColumn("category", F.lit("swap")),
        good.union(good), good.withColumn("long_contracts", F.lit(None).cast("long")),
    ):
        with pytest.raises(Q.ValidationError):
            Q.validate(bad)
    assert len(Q.validate(good.withColumn("open_interest", F.lit(10).cast("long")))) == 1


def test_hash_ignores_names_and_provenance(spark, tmp_path):
    one = canonical(spark, tmp_path)
    h = lambda df: {r.row_sha256 for r in stamped(df, "x", T0).collect()}
    assert h(one) == h(one.withColumn("market_name", F.lit("other"))) != h(one.withColumn("trader_count_long", F.lit(1).cast("long")))
    assert len(VALUE_FIELDS) == 10


def capture(v, plan, start=T0, url="http://x/a.zip", report_year=2025, step=1):
    for k, (status, body) in enumerate(plan):
        at = start + timedelta(days=k * step)

        def get(u, etag=None, last_modified=None, _s=status, _b=body):
            if _s == 500:
                raise OSError("down")
            return Response(_s, _b, {"ETag": "e", "Last-Modified": "Fri, 24 Jul 2026 19:30:05 GMT"})

        v.fetch([{"url": url, "kind": "annual", "report_type": "legacy", "report_year": report_year}], get, lambda at=at: at, 0)


def test_capture_outcomes(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path)))
    a, b = b"a" * 2000, b"b" * 2000
    capture(v, [(500, b""), (200, a), (304, b""), (200, a), (200, b), (200, b"short")])
    got = v.classified().orderBy("retrieved_at").collect()
    assert [r.outcome for r in got] == ["failed", "first", "not_modified", "deduped", "changed", "failed"]
    assert [r.restatement_suspect for r in got] == [False] * 4 + [True, False] and [bool(r.alert) for r in got] == [False] * 4 + [True, False]
    assert len(list((tmp_path / "raw").rglob("*.zip"))) == 2 and [s["parse_status"] for s in v.snapshots()].count("pending") == 2


@pytest.mark.parametrize("plan,alerts", [([200, *[304] * 6] * 3, 0), ([200, *[304] * 15], 1), ([200, *[304] * 12, 200, *[304] * 12], 2), ([200, *[304] * 5, 500, *[304] * 8], 1), ([304] * 12, 0)])
def test_quiet_periods_alarm_once(spark, tmp_path, plan, alerts):
    v = Vintage(Store(spark, str(tmp_path)))
    capture(v, [(s, b"x" * 2000) for s in plan])
    got = v.classified().where("alert is not null").collect()
    assert len(got) == alerts and all("blind" in r.alert for r in got)


def test_closed_and_current_years(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path)))
    a, b = b"a" * 2000, b"b" * 2000
    for year in (2010, 2026, None):
        capture(v, [(200, a), (200, b)], url=f"http://x/{year}", report_year=year)
    got = {r.report_year: (r.expectation, bool(r.alert)) for r in v.classified().where("outcome = 'changed'").collect()}
    assert got == {2010: ("frozen_out_of_window", True), 2026: ("churn", False), None: ("weekly", False)}


def test_parse_states(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path / "s")))
    good = write_zip(tmp_path / "g.zip", [wide_row("legacy", Junk="x" * 3000)])
    capture(v, [(200, good)], url="http://x/good.zip")
    capture(v, [(200, b"not a zip" * 500)], url="http://x/bad.zip", start=T0 + timedelta(hours=1))
    got = v.ingest_pending()
    assert (got["ok"], got["failed"], got["observations"]) == (1, 1, 3)
    assert v.ingest_pending()["ok"] == 0 and v.ingest_pending(retry=True)["failed"] == 1 and v.ingest_pending(everything=True)["ok"] == 1
    assert v.mark("nothing", parse_status="ok") is False
    assert v.ingest_pending(snapshot_id=v.snapshots()[0]["snapshot_id"])["observations"] == 0


def test_backfill_and_coverage(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path / "s")))
    rows = [wide_row("legacy", date=d) for d in ("2026-07-14", "2026-07-21", "2025-07-15", "2023-01-03")] + [wide_row("legacy", date="2025-07-15", code="2", name="OLD")]
    v.ingest(canonical(spark, tmp_path, rows=rows), "s1", datetime(2026, 7, 24, tzinfo=UTC))
    at = datetime(2026, 1, 1)
    v.sync_schedule(spark.createDataFrame([(date(2026, 7, 14), date(2026, 7, 20), "scheduled", "n", at), (date(2026, 7, 14), date(2026, 7, 22), "announced", "n", at), (date(2025, 7, 15), date(2025, 7, 18), "scheduled", "n", at)], "report_date date, release_date date, source string, note string, ingested_at timestamp"))
    v.sync_schedule(v.schedule().where("source = 'announced'").withColumn("release_date", F.lit("2026-07-23").cast("date")))
    n = v.observations().count()
    assert v.backfill() == {"published": 0, "observed": 3, "announced": 3, "scheduled": 6, "derived": 3, "unknown": 0}
    assert v.observations().count() == n and v.ingest(canonical(spark, tmp_path, rows=rows), "s2", datetime(2026, 8, 1, tzinfo=UTC))["observations"] == 0
    assert {r.release_date for r in v.asof(report_date=date(2026, 7, 14)).collect()} == {date(2026, 7, 23)}
    cov = v.write_coverage("legacy")
    changes = sorted((r.report_year, r.change, r.market_code) for r in Q.coverage_changes(cov).collect())
    assert changes == [(2025, "gap", None), (2026, "exit", "000002")]
    assert {(r.report_year, r.market_code): r.weeks for r in cov.collect()}[2026, "088691"] == 2


def test_lock(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    with s.lock(), pytest.raises(StoreError, match="pid"), s.lock():
        pass
    with s.lock():
        pass


def test_current_store_stitches(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"))
    reg = spark.createDataFrame([("LB", "Softs", "058644", "disagg", False, [("058643", 4.0)]), ("GC", "Metals", "088691", "disagg", False, [])], registry.SCHEMA)
    rows = [wide_row("legacy", date=d, code=c, factor=f) for d, c, f in (("2020-01-07", "58644", 10), ("2020-01-14", "58644", 20), ("2020-01-07", "58643", 3), ("2019-12-31", "58643", 2), ("2020-01-07", "999999", 1))]
    write_zip(tmp_path / "w.zip", rows)
    wide = archives.read_report(spark, str(tmp_path / "w.zip"), "legacy")
    assert current.read(s, "LB", registry=reg) is None
    assert current.update(s, "legacy", wide, reg) == current.Result("legacy", True, 2)
    got = current.read(s, "LB", registry=reg).collect()
    assert [(str(r.report_date), float(r.Comm_Positions_Long_All), r.CFTC_Contract_Market_Code) for r in got] == [("2019-12-31", 800.0, "058644"), ("2020-01-07", 1000.0, "058644"), ("2020-01-14", 2000.0, "058644")]
    assert float(got[0].Traders_Comm_Long_All) == 6.0
    assert current.from_current_store(s, "058644", registry=reg).count() == 3 and current.read(s, "LB_058643", registry=reg).count() == 2
    assert not current.update(s, "legacy", None, reg).ok
    with pytest.raises(ValueError):
        current.read(s, "LB", "other", reg)
    same = current.reconcile(wide, wide, ("legacy", "disagg"), {"x": (["Comm_Positions_Long_All"], ["Comm_Positions_Short_All"])})
    assert {r.x for r in same.collect()} == {0.0}
    with pytest.raises(StoreError):
        current.reconcile(wide, wide, ("legacy", "supplemental"), {})


def test_streams_equal_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    write_zip(landing / "a.zip", [wide_row("legacy")])
    v = Vintage(Store(spark, str(tmp_path / "s")))
    for _ in range(2):
        ingest_archives(v, str(landing), "legacy", str(tmp_path / "c")).awaitTermination()
        assert v.observations().count() == 3
    base = canonical(spark, tmp_path)
    for k in range(3):
        base.withColumn("long_contracts", (F.col("long_contracts") + k // 2).cast("long")).withColumns({"snapshot_id": F.lit(f"s{k}"), "observed_at": F.lit(T0 + timedelta(days=k))}).coalesce(1).write.mode("append").parquet(str(tmp_path / "canon"))
    w = Vintage(Store(spark, str(tmp_path / "w")))
    ingest_canonical(w, str(tmp_path / "canon"), str(tmp_path / "d")).awaitTermination()
    assert w.observations().count() == 6 and w.revisions().count() == 3
    assert CANONICAL.startswith("report_date date")


def test_tumbling(spark, tmp_path):
    events = spark.createDataFrame([(datetime(2026, 1, 1, h), "a", 1.0) for h in (1, 5, 23)] + [(datetime(2026, 1, 2, 1), "a", 2.0)], "ts timestamp, kind string, value double")
    assert sorted((r.n, r.total) for r in tumbling(events, "ts", ["kind"]).collect()) == [(1, 2.0), (3, 3.0)]
    events.write.parquet(str(tmp_path / "e"))
    stream = tumbling(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")), "ts", ["kind"])
    stream.writeStream.format("memory").queryName("windows").outputMode("complete").start().processAllAvailable()
    assert spark.table("windows").count() == 2
    for q in spark.streams.active:
        q.stop()


def test_stateful_alarms_across_batches(spark, tmp_path):
    plan = {"a": [1, *[0] * 14, 1, *[0] * 12], "b": [0] * 20, "c": [1, 0, 0, 0, 0, 0, 0] * 3}
    rows = [(url, T0 + timedelta(days=k), bool(d)) for url, days in plan.items() for k, d in enumerate(days)]
    for first, last in ((0, 8), (8, 17), (17, 40)):
        part = [r for r in rows if first <= (r[1] - T0).days < last]
        spark.createDataFrame(part, "source_url string, retrieved_at timestamp, delivered boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema("source_url string, retrieved_at timestamp, delivered boolean").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    q = blind_alarms(stream).writeStream.format("memory").queryName("alarms").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.source_url, round(r.quiet_days)) for r in spark.table("alarms").collect())
    assert got == [("a", 10), ("a", 10)]


def rule(snapshots):
    """Observations (key, hash of values, at) and revisions (key, old, new, at) of snapshots in the order of arrival, by the rule itself."""
    stored, revised = [], []
    for at, rows in snapshots:
        for key, value in rows.items():
            known = [x for x in stored if x[0] == key and x[2] <= at]
            prior = max(known, key=lambda x: x[2], default=None)
            if prior is None or prior[1] != value:
                if (key, value, at) not in stored:
                    stored.append((key, value, at))
                if prior is not None:
                    revised.append((key, prior[1], value, at))
    return sorted(stored), sorted(revised)


@pytest.mark.parametrize("order", [(0, 2, 1), (1, 2, 0), (2, 1, 0), (2, 0, 1)])
def test_snapshots_in_any_order(spark, tmp_path, order):
    v = Vintage(Store(spark, str(tmp_path / "s")))
    one = canonical(spark, tmp_path)
    values = [{"commercial": 100, "noncommercial": 200}, {"commercial": 150, "noncommercial": 200}, {"commercial": 100, "noncommercial": 210}]
    frame = lambda x: one.where(F.col("category").isin(*x)).withColumn("long_contracts", F.when(F.col("category") == "commercial", x["commercial"]).otherwise(x["noncommercial"]).cast("long"))
    for i in order:
        v.ingest(frame(values[i]), f"s{i}", T0 + timedelta(days=i))
    stored, revised = rule([(i, values[i]) for i in order])
    day = lambda t: (t.replace(tzinfo=UTC) - T0).days
    assert sorted((r.category, r.long_contracts, day(r.observed_at)) for r in v.observations().collect()) == stored
    assert sorted((r.category, int(r.old_value), int(r.new_value), day(r.detected_at)) for r in v.revisions().collect()) == revised


def test_a_hash_that_no_field_explains(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path / "s")))
    one = canonical(spark, tmp_path)
    v.ingest(one, "s1", T0)
    tampered = v.observations().withColumn("row_sha256", F.when(F.col("category") == "commercial", "x").otherwise(F.col("row_sha256")))
    v.store.replace(tampered, "observations", ["report_year"])
    changed = one.withColumn("long_contracts", F.when(F.col("category") == "noncommercial", 7).otherwise(F.col("long_contracts")))
    with pytest.raises(Q.ValidationError, match="no field"):  # beside a revision that is genuine
        v.ingest(changed, "s2", T0 + timedelta(days=1))
    assert v.revisions().count() == 0 and v.observations().count() == 3


def test_tombstones_and_migrations(spark, tmp_path):
    v = Vintage(Store(spark, str(tmp_path / "s")))
    one = canonical(spark, tmp_path, rows=[wide_row("legacy"), wide_row("legacy", code="2")])
    v.ingest(one, "s1", T0)
    moved = one.withColumn("long_contracts", F.col("long_contracts") + F.when(F.col("category") == "commercial", 5).when(F.col("category") == "noncommercial", -5).otherwise(0)).where("market_code = '088691'")
    assert v.ingest(moved, "s2", T0 + timedelta(days=1), tombstones=True)["observations"] == 5
    assert {r.market_code for r in v.asof().collect()} == {"088691"} and v.asof(T0).count() == 6
    assert v.ingest(moved, "s2", T0 + timedelta(days=1), tombstones=True)["observations"] == 0
    assert [(r.market_code, r.field, r.n, r.moved) for r in Q.category_migration(v.revisions()).collect()] == [("088691", "long_contracts", 2, 5.0)]
    assert v.ingest(one, "s3", T0 + timedelta(days=2), tombstones=True)["observations"] == 5 and v.asof().count() == 6
    with pytest.raises(StoreError):
        v.write_coverage("tff")


def test_updates_of_some_symbols_and_years(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"))
    reg = spark.createDataFrame([("KE", "Grains", "000001", "disagg", False, []), ("ZW", "Grains", "000002", "disagg", False, [])], registry.SCHEMA)
    rows = lambda f: [wide_row("legacy", date=d, code=c, factor=f) for d in ("2019-01-08", "2020-01-07") for c in ("1", "2")]

    def wide(name, f):
        write_zip(tmp_path / name, rows(f))
        return archives.read_report(spark, str(tmp_path / name), "legacy")

    state = lambda: {(r.name, r.report_date.year): int(float(r.Comm_Positions_Long_All)) for r in s.read_wide("cot_legacy").collect()}
    current.update(s, "legacy", wide("a.zip", 1), reg)
    assert set(state().values()) == {100}
    assert current.update(s, "legacy", wide("b.zip", 2), reg, ["ZW"]) == current.Result("legacy", True, 1)
    assert state() == {("KE_000001", 2019): 100, ("KE_000001", 2020): 100, ("ZW_000002", 2019): 200, ("ZW_000002", 2020): 200}
    current.update(s, "legacy", wide("c.zip", 3).where("year(report_date) = 2020"), reg, years=(2020, 2020))
    assert state() == {("KE_000001", 2019): 100, ("KE_000001", 2020): 300, ("ZW_000002", 2019): 200, ("ZW_000002", 2020): 300}
    assert {(e.name, e.n_rows) for e in s.entries().collect()} == {("KE_000001", 2), ("ZW_000002", 2)}


def test_an_archive_is_decoded_once(spark, tmp_path, monkeypatch):
    count = spark.sparkContext.accumulator(0)
    rows = archives._rows

    def counted(name, data):
        count.add(1)
        return rows(name, data)

    monkeypatch.setattr(archives, "_rows", counted)
    v = Vintage(Store(spark, str(tmp_path / "s")))
    write_zip(tmp_path / "a.zip", [wide_row("legacy")])
    with v.store.staging("decoded") as staged:
        wide = archives.read_report(spark, str(tmp_path / "a.zip"), "legacy", staged=staged)
        v.ingest(canonicalise(wide, "legacy"), "s1", T0)
    assert count.value == 1 and not list((tmp_path / "s/_staging").glob("*"))
