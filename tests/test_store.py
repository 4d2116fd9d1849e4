import json
import os
import shutil
from datetime import UTC, date, datetime

import pytest

from revlake import cli, registry
from revlake.operators import manifest as M
from revlake.operators import stitch as T
from revlake.sources import archives, html, http
from revlake.store import Store, StoreError, compare_stores, fresh_files, half_of, load_manifest, normal_path, read_json, report, require_schema, schema_version

NOW = datetime(2026, 8, 1, tzinfo=UTC)


def entry(day="2026-07-21", n=3, source="a", at="2026-07-24T20:00:00Z"):
    return {"last_date": day, "n_rows": n, "source": source, "updated_at": at}


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(data))


def test_tables_are_replaced_from_themselves(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    assert s.read("t", "a int").count() == 0
    s.replace(spark.range(5).selectExpr("cast(id as int) a"), "t")
    s.replace(s.read("t", "a int").where("a > 1"), "t")
    s.append(spark.range(1).selectExpr("cast(9 as int) a"), "t")
    assert sorted(r.a for r in s.read("t", "a int").collect()) == [2, 3, 4, 9] and not list((tmp_path / "_staging").glob("*"))


def test_manifest_overlay_migration_and_reconcile(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    write(tmp_path / "manifest.json", {"schema_version": 1, "cot_legacy": {"GC_1": entry(n=1), "OLD_2": entry()}, "prices": {"ES": entry(at="never")}})
    assert s.manifest()["cot_legacy"].keys() == {"GC_1", "OLD_2"}
    write(tmp_path / "manifests/cot.json", {"schema_version": 2, "cot_legacy": {"GC_1": entry(n=9)}})
    m = s.manifest()
    assert m["cot_legacy"] == {"GC_1": entry(n=9)} and m["prices"] and m["schema_version"] == 2
    assert s.unmigrated() == [("cot_legacy", "OLD_2"), ("prices", "ES")]
    assert s.migrate() == {"cot": 1, "prices": 1} and s.unmigrated() == [] and s.migrate() == {"cot": 0, "prices": 0}
    assert s.manifest()["cot_legacy"]["GC_1"]["n_rows"] == 9
    gone = s.reconcile(spark.createDataFrame([("cot_legacy", "GC_1")], "domain string, name string"))
    assert gone == [("cot_legacy", "OLD_2"), ("prices", "ES")] and "prices" not in s.manifest()
    assert s.require_schema(2) == 2
    with pytest.raises(StoreError):
        s.require_schema(3)
    with pytest.raises(StoreError):
        half_of("other")


def test_damaged_manifest_is_put_aside(tmp_path):
    (tmp_path / "m.json").write_text("{")
    assert read_json(tmp_path / "m.json") == {} == read_json(tmp_path / "none.json")
    with pytest.raises(StoreError):
        read_json(tmp_path / "m.json", strict=True)
    assert [p.name.startswith("m.json.damaged") for p in tmp_path.iterdir()] == [True]


def test_status_and_lag(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    write(tmp_path / "manifests/cot.json", {"schema_version": 2, "cot_legacy": {"A": entry(), "B": entry(at="2026-07-15T20:00:00Z"), "C": entry(at="never"), "R": entry(at="2020-01-01T00:00:00Z")}})
    write(tmp_path / "manifests/prices.json", {"prices": {"X": entry(at="2000-01-01T00:00:00Z"), "Y": entry()}})
    doc = s.status(today=date(2026, 7, 28), ignore=["R"])
    legacy = doc["domains"]["cot_legacy"]
    assert legacy["lagging"] == [["C", 9999], ["B", 9]] and legacy["rows"] == 12 and legacy["behind_today"] == 7
    assert doc["domains"]["prices"]["retired"] and doc["domains"]["prices"]["lagging"] == [] and doc["newest_data"]["cot_legacy"] == "2026-07-21"
    assert "behind: B by 9 days" in report(doc)
    assert json.loads(s.write_status({"results": []}).read_text())["last_run"] == {"results": []}


def test_replica_diff(spark, tmp_path):
    a, b = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    write(a.manifest_path("cot"), {"cot_legacy": {"A": entry(), "B": entry(source="x")}})
    write(b.manifest_path("cot"), {"cot_legacy": {"B": entry(source="y"), "C": entry()}})
    (tmp_path / "b/tables/extra").mkdir(parents=True)
    assert compare_stores(a, b) == {"only_in_target": [("cot_legacy", "C")], "different_source": [("cot_legacy", "B", "x", "y")], "files_only_in_target": [], "tables_only_in_target": ["extra"]}
    (tmp_path / "f.txt").write_text("x")
    files = spark.read.format("binaryFile").load(str(tmp_path / "f.txt"))
    assert [r.fresh for r in fresh_files(files, 24).collect()] == [True] and [r.fresh for r in fresh_files(files, 24, datetime(2100, 1, 1)).collect()] == [False]
    assert str(normal_path("raw\\x\\y.zip", tmp_path)) == f"{tmp_path}/raw/x/y.zip" and str(normal_path("/abs/y", tmp_path)) == "/abs/y"


def test_registry(spark, tmp_path):
    reg = registry.load(spark)
    assert reg.count() == 51 and registry.symbol(reg, "GC").first().code == "088691"
    assert {r.report_type for r in registry.by_asset_class(reg, "Equities").collect()} == {"tff"} and registry.symbol(reg, "GC").first().report_type == "disagg"
    names = spark.createDataFrame([("GC",), ("088691",), ("nothing",)], "name string")
    assert {r.name: r.symbol for r in T.resolve(names, reg).collect()} == {"GC": "GC", "088691": "GC", "nothing": None}
    assert "RTY_23977A" in {r.name for r in registry.retired_names(reg).collect()}
    (tmp_path / "r.yaml").write_text("Energy:\n  XX: {cftc_code: '1', hist_codes: [a, [b, 2]]}\n  YY: {cftc_code: '2', report_type: tff, is_equity: true}\n")
    rows = {r.symbol: r for r in registry.load(spark, str(tmp_path / "r.yaml")).collect()}
    assert [tuple(p) for p in rows["XX"].predecessors] == [("a", 1.0), ("b", 2.0)] and rows["XX"].report_type == "disagg" and rows["YY"].is_equity
    for text in ("[]", "A: 3", "A: {X: {}}", "A: {X: {cftc_code: '1'}}\nB: {X: {cftc_code: '1'}}", "A: {X: 3}", "{"):
        (tmp_path / "bad.yaml").write_text(text)
        with pytest.raises(registry.RegistryError):
            registry.load(spark, str(tmp_path / "bad.yaml"))
    with pytest.raises(FileNotFoundError):
        registry.load(spark, str(tmp_path / "none.csv"))


def pages(spark, *texts):
    return spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(texts)], "url string, html string")


def test_calendar(spark):
    page = "<h3><strong>2027 Release\n Schedule</strong></h3><table><tr><td>Month</td><td>Dates</td></tr><tr><td>January</td><td>04*</td><td> 08 </td><td>&nbsp;</td></tr><tr><td>February<span>&nbsp;</span></td><td>05</td></tr></table>"
    got = sorted((str(r.report_date), str(r.release_date), r.note) for r in html.calendar(pages(spark, page)).collect())
    assert got == [("2026-12-29", "2027-01-04", "delayed by a holiday"), ("2027-01-05", "2027-01-08", "published calendar"), ("2027-02-02", "2027-02-05", "published calendar")]
    for bad in ("<table><tr><td>January</td><td>04</td></tr></table>", "2027 Release Schedule", "2027 Release Schedule <table></table>"):
        with pytest.raises(html.PageError):
            html.calendar(pages(spark, bad))


PLAN = "<tr><th>COT Report Date</th><th>Original Publish Date</th><th>New Publish Date</th></tr>"


def test_newest_announced_plan_replaces_the_older(spark):
    page = (
        "<nav>July 1, 2001: menu</nav><div id=\"main-content\"><p>December 9, 2025:</p><p>faster</p><table>" + PLAN + "<tr><td>09/30/2025</td><td>10/03/2025</td><td>11/19/2025</td><td>+</td></tr><tr><td>+ footnote 11/11/2025</td></tr></table>"
        "<p>November 18, 2025: slow</p><table>" + PLAN + "<tr><td>09/30/2025</td><td>10/03/2025</td><td>11/25/2025</td></tr><tr><td>12/30/2025</td><td>01/05/2026</td><td>01/13/2026</td></tr></table>"
        "<table><tr><th>Contract</th><th>New Name</th></tr><tr><td>01/01/2025</td><td>01/02/2025</td><td>01/03/2025</td></tr></table></div><footer>x</footer>"
    )
    got = [(str(r.report_date), str(r.release_date), r.source, r.note) for r in html.announced(pages(spark, page)).collect()]
    assert got == [("2025-09-30", "2025-11-19", "announced", "special announcement 2025-12-09")]
    prose = sorted((str(r.announcement_date), r.raw_text[:24]) for r in html.announcements(pages(spark, page, "nothing here")).collect())
    assert [d for d, _ in prose] == ["2025-11-18", "2025-12-09"] and prose[1][1].startswith("December 9, 2025: faster")
    with pytest.raises(html.PageError):
        html.announced(pages(spark, "<table><tr><td>x</td></tr></table>"))


def test_conditional_download(tmp_path):
    seen = []

    def get(url, last_modified=None, **_):
        seen.append(last_modified)
        return http.Response(200, b"new", {"Last-Modified": "Fri, 24 Jul 2026 19:30:05 GMT"}) if len(seen) == 1 else http.Response(304)

    p = tmp_path / "c" / "x.zip"
    assert http.cached("u", p, get) == p and http.cached("u", p, get) == p
    assert seen == [None, "Fri, 24 Jul 2026 19:30:05 GMT"] and p.read_bytes() == b"new"

    def down(*_, **__):
        raise OSError

    assert http.cached("u", p, down) == p and http.cached("u", tmp_path / "none", down) is None


def test_source_catalogue(spark):
    got = http.sources(spark, 2026).groupBy("report_type", "kind").count().collect()
    assert {(r.report_type, r.kind): r["count"] for r in got} == {("legacy", "annual"): 41, ("supplemental", "annual"): 21, ("disaggregated", "annual"): 10, ("tff", "annual"): 10, ("disaggregated", "bundle"): 1, ("tff", "bundle"): 1, ("legacy", "weekly"): 1}


def test_cli(spark, tmp_path, capsys):
    from helpers import wide_row, write_zip

    body = write_zip(tmp_path / "x.zip", [wide_row("legacy", date="2026-07-21", Junk="y" * 3000)])

    def get(url, etag=None, last_modified=None, method="GET"):
        if "deacot2026" in url:
            return http.Response(200, body, {"Last-Modified": "Fri, 24 Jul 2026 19:30:05 GMT"})
        raise OSError("unreachable")

    root = ["--store", str(tmp_path / "s")]
    assert cli.main([*root, "update", "--legacy", "--years", "2026", "2026"], get) == 0
    assert cli.main([*root, "update", "--tff", "--years", "2026", "2026"], get) == 1
    assert cli.main([*root, "update", "--check"]) == 0 and "cot_legacy: 1 entries" in capsys.readouterr().out
    assert cli.main([*root, "update", "--reconcile"]) == 0 and cli.main([*root, "update", "--migrate-manifests"]) == 0
    assert cli.main([*root, "vintage", "fetch", "--year", "2026"], get) == 0
    assert cli.main([*root, "vintage", "ingest"], get) == 0
    for command in (["diff"], ["asof", "--t", "2030-01-01"], ["coverage"], ["zero-sum"]):
        assert cli.main([*root, "vintage", *command]) == 0
    assert cli.main([*root, "schedule", "published"]) == 0 and cli.main([*root, "schedule", "backfill"]) == 0
    assert "088691" in capsys.readouterr().out


def test_only_in_and_touch(spark):
    old = spark.createDataFrame([("d", "a", 1), ("d", "b", 2)], "domain string, name string, n int")
    new = spark.createDataFrame([("d", "b", 5)], "domain string, name string, n int")
    assert sorted(map(tuple, M.touch(old, new).collect())) == [("d", "a", 1), ("d", "b", 5)]


def test_a_reader_keeps_its_version(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.replace(spark.range(3), "t")
    old = s.read("t", "id long")
    s.replace(spark.range(5), "t")
    assert old.count() == 3 and s.read("t", "id long").count() == 5
    s.append(spark.range(2), "t")
    assert s.read("t", "id long").count() == 7 and len(list((tmp_path / "tables/t").glob("v=*"))) == 2


def test_new_data_and_replicas(spark, tmp_path, capsys):
    a, b = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    write(a.manifest_path("cot"), {"cot_legacy": {"A": entry()}})
    assert json.loads(a.write_status().read_text())["new_data"] == {"cot_legacy": [None, "2026-07-21"]}
    assert json.loads(a.write_status().read_text())["new_data"] == {}
    assert (load_manifest(a)["cot_legacy"]["A"]["n_rows"], schema_version(a)) == (entry()["n_rows"], 0)
    with pytest.raises(StoreError):
        require_schema(a, 9)
    command = ["--store", str(tmp_path / "a"), "replica"]
    assert cli.main([*command, str(tmp_path / "none")]) == 2
    a.replace(spark.range(1).selectExpr("id", "'A' name"), "cot_legacy", ["name"])
    shutil.copytree(tmp_path / "a", tmp_path / "b", dirs_exist_ok=True)
    assert cli.main([*command, str(tmp_path / "b")]) == 0 and "0 files differ" in capsys.readouterr().out
    os.utime(tmp_path / "b/status.json", (0, 0))
    assert cli.main([*command, str(tmp_path / "b")]) == 1
    b.append(spark.range(1).selectExpr("id", "'B' name"), "cot_legacy", ["name"])
    assert compare_stores(a, b)["files_only_in_target"] == [("cot_legacy", "name=B")]
    assert cli.main([*command, str(tmp_path / "b")]) == 1


def test_all_rows_are_printed(spark, capsys):
    cli._print(spark.range(1500), "rows")
    assert len(capsys.readouterr().out.split()) == 1503


def test_workbooks_need_only_a_reader(monkeypatch):
    """The box has no engine for workbooks: what pandas would read with one becomes rows like those of a CSV member."""
    import pandas as pd

    sheet = pd.DataFrame({" Market ": ["GOLD", None], "Code": ["088691", "1"]})
    monkeypatch.setattr(pd, "read_excel", lambda data, dtype: sheet)
    assert list(archives._rows("annual.XLS", b"")) == [{"Market": "GOLD", "Code": "088691"}, {"Market": None, "Code": "1"}]
