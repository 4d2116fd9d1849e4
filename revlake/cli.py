"""Command line: ``python -m revlake.cli update|vintage|schedule ...``. A run that leaves something wrong ends with status 1."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake import current, registry, store
from revlake.operators import bitemporal as B
from revlake.operators import quality as Q
from revlake.schema import FIRST_YEAR
from revlake.session import session
from revlake.sources import archives, html, http
from revlake.vintage import Vintage

NAMES = {"legacy": "legacy", "disagg": "disaggregated", "tff": "tff", "supplemental": "supplemental"}
PAGES = {"calendar": "https://www.cftc.gov/MarketReports/CommitmentsofTraders/ReleaseSchedule/index.htm", "announced": "https://www.cftc.gov/MarketReports/CommitmentsofTraders/SpecialAnnouncements/index.htm"}


def _when(text: str) -> datetime:
    t = datetime.fromisoformat(text)
    return t if t.tzinfo else t.replace(tzinfo=UTC)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="revlake")
    p.add_argument("--store")
    top = p.add_subparsers(dest="command", required=True)
    u = top.add_parser("update", help="renew the current-state store from archives")
    for kind in NAMES:
        u.add_argument(f"--{kind}", action="store_true")
    u.add_argument("--all", action="store_true")
    u.add_argument("--symbols", nargs="*", default=[])
    u.add_argument("--years", type=int, nargs=2)
    u.add_argument("--check", action="store_true", help="report and change nothing")
    u.add_argument("--migrate-manifests", action="store_true")
    u.add_argument("--reconcile", action="store_true")
    v = top.add_parser("vintage", help="the bitemporal store").add_subparsers(dest="action", required=True)
    f = v.add_parser("fetch")
    f.add_argument("--year", type=int)
    f.add_argument("--all", action="store_true")
    f.add_argument("--no-weekly", action="store_true")
    i = v.add_parser("ingest")
    i.add_argument("--snapshot")
    i.add_argument("--retry", action="store_true")
    i.add_argument("--everything", action="store_true")
    d = v.add_parser("diff")
    d.add_argument("--since", type=_when)
    a = v.add_parser("asof")
    a.add_argument("--t", type=_when)
    a.add_argument("--date", type=date.fromisoformat)
    c = v.add_parser("coverage")
    z = v.add_parser("zero-sum")
    z.add_argument("--weeks", type=int, default=10)
    for s in (d, a, c, z):
        s.add_argument("--market")
        s.add_argument("--report-type", default="legacy" if s in (c, z) else None)
    r = top.add_parser("replica", help="whether the store may be mirrored to another, and whether a replica is fresh")
    r.add_argument("target")
    r.add_argument("--max-age-days", type=float, help="age of the newest file; without it the target's status must be of today")
    top.add_parser("schedule", help="release dates").add_argument("action", choices=["sync", "published", "backfill"])
    return p


def _print(df: DataFrame, what: str) -> None:
    """How many rows there are, and all of them, fetched partition by partition."""
    df = df.persist()
    print(f"{df.count()} {what}")
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*row, sep="\t")
    df.unpersist()


def _update(args, s: store.Store, get: http.Fetch) -> int:
    if args.migrate_manifests:
        print(s.migrate(), "not moved:", s.unmigrated())
        return int(bool(s.unmigrated()))
    if args.reconcile:
        files = store.data_files(s).where("domain like 'cot_%'").select("domain", F.split_part("name", F.lit("="), F.lit(2)).alias("name"))
        print("dropped:", s.reconcile(files))
        return 0
    if args.check:
        print(store.report(s.status(ignore=[r["name"] for r in registry.retired_names(registry.load(s.spark)).collect()])))
        return 0
    results = []
    for kind, report_type in NAMES.items():
        if args.all or getattr(args, kind):
            now = datetime.now(UTC).year
            first, last = args.years or (FIRST_YEAR[report_type], now)
            plan = http.sources(s.spark, last, [report_type]).where("kind <> 'weekly'").collect()
            wanted = [r for r in plan if r["report_year"] >= first]
            files = {r["report_year"]: http.cached(r["url"], s.root / "cache" / r["url"].rsplit("/", 1)[-1], get) for r in wanted}
            paths = [str(p) for p in files.values() if p]
            with s.staging("decoded") as staged:
                wide = archives.read_report(s.spark, paths, report_type, (first, last), staged=staged) if files.get(last) else None
                results.append(current.update(s, kind, wide, registry.load(s.spark), args.symbols, years=args.years and (first, last)))
    run = {"results": [vars(r) for r in results], "at": f"{datetime.now(UTC):%FT%TZ}"}
    s.write_status(run)
    print(store.run_summary(run))
    return int(not all(r.ok for r in results))


def _vintage(args, s: store.Store, get: http.Fetch) -> int:
    v = Vintage(s)
    if args.action == "fetch":
        year = args.year or datetime.now(UTC).year
        plan = http.sources(s.spark, year).where("kind <> 'bundle'")
        if not args.all:
            plan = plan.where(F.col("report_year").isNull() | F.col("report_year").isin(year, year - 1))
        if args.no_weekly:
            plan = plan.where("kind <> 'weekly'")
        print(v.fetch([r.asDict() for r in plan.orderBy("report_type", "report_year").collect()], get))
        return 0
    if args.action == "ingest":
        before = datetime.now(UTC)
        got = v.ingest_pending(snapshot_id=args.snapshot, retry=args.retry, everything=args.everything)
        print({k: got[k] for k in ("ok", "failed", "observations", "revisions")}, *got["warnings"], *got["errors"], sep="\n")
        if got["revisions"]:
            B.recent(v.revisions(), ["detected_at", "revision_id"], 20).show(truncate=False)
        alerts = v.classified().where("alert is not null").orderBy(F.col("retrieved_at").desc()).limit(5).collect()
        print(*[f"{r['source_url']} {r['retrieved_at']}: {r['alert']}" for r in alerts], sep="\n")
        return int(bool(got["failed"] or got["revisions"] or any(r["retrieved_at"].replace(tzinfo=UTC) >= before for r in alerts)))
    if args.action == "diff":
        _print(v.diff(args.since, args.market, args.report_type).orderBy("detected_at"), "revisions")
    elif args.action == "asof":
        _print(v.asof(args.t, args.date, args.market, args.report_type).orderBy("report_date", "market_code", "category"), "rows known")
    elif args.action == "coverage":
        cov = v.write_coverage(args.report_type)
        _print(Q.year_counts(cov.withColumn("report_year", F.col("report_year").cast("int")), F.col("report_year"), "market_code", "first_report_date").orderBy("y"), "years")
        _print(cov.orderBy("report_year", "market_code"), "market-years")
        _print(Q.coverage_changes(cov).orderBy("report_year", "change", "market_code"), "changes")
    else:
        checked = v.zero_sum(market_code=args.market, report_type=args.report_type)
        Q.zero_sum_summary(checked).show()
        checked.orderBy(F.col("report_date").desc()).limit(args.weeks).show(truncate=False)
        Q.interval_gaps(checked, "market_code", "report_date").groupBy("market_code").agg(F.count("*").alias("n"), F.min("gap"), F.max("gap")).show()
    return 0


def _schedule(args, s: store.Store, get: http.Fetch) -> int:
    v, at = Vintage(s), datetime.now(UTC)
    if args.action == "sync":
        page = lambda url: s.spark.createDataFrame([(url, get(url).content.decode("utf-8", "replace"))], "url string, html string")
        special = page(PAGES["announced"])
        v.sync_schedule(html.calendar(page(PAGES["calendar"])))
        v.sync_announcements(html.announcements(special), at)
        v.sync_schedule(html.announced(special))
    elif args.action == "published":
        v.sync_schedule(v.published())
    else:
        print(v.backfill())
    return 0


def _replica(args, s: store.Store, get: http.Fetch) -> int:
    """Status 1 if a mirror to the target would destroy something or the target isn't fresh, 2 if there is nothing to compare."""
    target = store.Store(s.spark, args.target)
    if target.root.resolve() == s.root.resolve() or not (s.root.is_dir() and target.root.is_dir()):
        print("name two stores that exist")
        return 2
    found = store.compare_stores(s, target)
    print(*[f"{k}: {v[:8]}{f' and {len(v) - 8} more' if len(v) > 8 else ''}" for k, v in found.items() if v] or ["safe: the target holds nothing that the store doesn't"], sep="\n")
    status = target.root / "status.json"
    times = [(str(status), datetime.fromtimestamp(status.stat().st_mtime, UTC))] if status.exists() else []
    fresh = store.fresh_files(s.spark.createDataFrame(times, "path string, modificationTime timestamp"), args.max_age_days and args.max_age_days * 24).where("fresh").count()
    print("fresh" if fresh else "not fresh: no status document of the time asked for")
    a, b = (store.data_files(x).withColumn("name", F.concat_ws("/", "domain", "name")) for x in (s, target))
    behind = store.unequal_times(a, b).count()
    print(f"{behind} files differ in their times")
    return int(any(found.values()) or not fresh)


def main(argv: Sequence[str] | None = None, get: http.Fetch = http.http_get) -> int:
    args = parser().parse_args(argv)
    s = store.Store(session(), args.store and str(Path(args.store)))
    return {"update": _update, "vintage": _vintage, "schedule": _schedule, "replica": _replica}[args.command](args, s, get)


if __name__ == "__main__":
    raise SystemExit(main())
