"""The bitemporal store: capture of raw files, change-only ingest, point-in-time reads and release dates."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterable
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.operators import bitemporal as B
from revlake.operators import capture as C
from revlake.operators import quality as Q
from revlake.operators import release as R
from revlake.operators.canonical import canonicalise, stamped, vanished
from revlake.schema import ANNOUNCEMENT, COVERAGE, NATURAL_KEY, OBSERVATION, REVISION, SCHEDULE, VALUE_FIELDS, VINTAGE_ORDER
from revlake.sources import archives, http
from revlake.store import FLOORS, Store, StoreError, normal_path, read_json, require_size, write_json

SNAPSHOT = (
    "snapshot_id string, source_url string, kind string, report_type string, report_year int, retrieved_at timestamp, http_status int, http_etag string, "
    "http_last_modified string, content_sha256 string, byte_size long, local_path string, error string"
)
_PARTITION = {"observations": "report_year", "revisions": "detected_year"}


class Vintage:
    def __init__(self, store: Store):
        self.store, self.spark = store, store.spark
        self.log_path = store.root / "snapshots.json"

    # capture

    def snapshots(self) -> list[dict]:
        return read_json(self.log_path, strict=True).get("snapshots", [])

    def log(self) -> DataFrame:
        names = [f.split()[0] for f in SNAPSHOT.split(", ")]
        rows = [tuple(datetime.fromisoformat(s[n]) if n == "retrieved_at" else s.get(n) for n in names) for s in self.snapshots()]
        return self.spark.createDataFrame(rows, SNAPSHOT)

    def classified(self) -> DataFrame:
        return C.classify(self.log())

    def fetch(self, sources: Iterable[dict], get: http.Fetch = http.http_get, now: Callable[[], datetime] = lambda: datetime.now(UTC), wait: float = 1.0) -> dict[str, int]:
        """Capture each source (report_type, report_year, kind, url) in turn; a failed one is recorded and the sweep goes on.

        Content equal to the last that the source had is recorded but not kept again. The log is written
        after every source. How many outcomes of each kind there were.
        """
        counts: dict[str, int] = {}
        for i, s in enumerate(sources):
            if i:
                http.pause(wait)
            log, at = self.snapshots(), now()
            held = [x for x in log if x["source_url"] == s["url"] and x.get("content_sha256")]
            last = max(held, key=lambda x: x["retrieved_at"], default={})
            tag = hashlib.sha256(s["url"].encode()).hexdigest()[:8]
            rec = {"snapshot_id": f"{at:%Y%m%dT%H%M%SZ}_{s['report_type']}_{tag}", "source_url": s["url"], "kind": s["kind"], "report_type": s["report_type"], "report_year": s.get("report_year"), "retrieved_at": at.isoformat(), "error": None, "parse_status": "skipped"}
            try:
                got = get(s["url"], etag=last.get("http_etag"), last_modified=last.get("http_last_modified"))
                rec |= {"http_status": got.status, "http_etag": got.etag, "http_last_modified": got.last_modified}
                if got.status == 200:
                    require_size(got.content, s["kind"] if s["kind"] in FLOORS else "annual")
                    sha = hashlib.sha256(got.content).hexdigest()
                    rec |= {"content_sha256": sha, "byte_size": len(got.content)}
                    if sha == last.get("content_sha256"):
                        outcome = "deduped"
                        rec["local_path"] = last["local_path"]
                    else:
                        outcome = "changed" if last else "first"
                        suffix = Path(s["url"]).suffix or ".bin"
                        rec["local_path"] = f"raw/{s['report_type']}/{s.get('report_year') or 'weekly'}/{at:%Y%m%dT%H%M%SZ}_{sha[:8]}{suffix}"
                        rec["parse_status"] = "pending"
                        path = self.store.root / rec["local_path"]
                        path.parent.mkdir(parents=True, exist_ok=True)
                        part = path.with_name(path.name + ".part")
                        part.write_bytes(got.content)
                        os.replace(part, path)
                else:
                    outcome = "not_modified"
            except Exception as e:
                outcome = "failed"
                rec["error"] = f"{type(e).__name__}: {e}"
            counts[outcome] = counts.get(outcome, 0) + 1
            write_json(self.log_path, {"snapshots": [*log, rec]})
        return counts

    def mark(self, snapshot_id: str, **fields) -> bool:
        """Change fields of one snapshot's record, such as its parse state."""
        log = self.snapshots()
        hit = [s for s in log if s["snapshot_id"] == snapshot_id]
        for s in hit:
            s.update(fields)
        if hit:
            write_json(self.log_path, {"snapshots": log})
        return bool(hit)

    def select(self, snapshot_id: str | None = None, retry: bool = False, everything: bool = False) -> list[dict]:
        """Snapshots to ingest: pending ones, one by name, those that failed too, or all that have content."""
        log = [s for s in self.snapshots() if s.get("local_path")]
        if snapshot_id:
            return [s for s in log if s["snapshot_id"] == snapshot_id]
        states = {"pending", "failed"} if retry else {"pending"}
        return [s for s in log if everything or s.get("parse_status") in states]

    # ingest

    def observations(self, years: Iterable[int] | None = None) -> DataFrame:
        df = self.store.read("observations", OBSERVATION + ", report_year int")
        return df.where(F.col("report_year").isin(*years)) if years is not None else df

    def revisions(self, years: Iterable[int] | None = None) -> DataFrame:
        df = self.store.read("revisions", REVISION + ", detected_year int")
        return df.where(F.col("detected_year").isin(*years)) if years is not None else df

    def ingest(self, canonical: DataFrame, snapshot_id: str, observed_at: datetime, validate: bool = True, tombstones: bool = False) -> dict:
        """Store what changed. Revisions go first: a crash in between leaves revisions that the retry writes again under the same id.

        ``tombstones``: also mark the known keys that the snapshot lacks though it covers their report and date.
        """
        warnings = Q.validate(canonical) if validate else []
        years = [r[0] for r in canonical.select(F.year("report_date").alias("y")).distinct().collect()]
        with self.store.lock():
            incoming, stored = stamped(canonical, snapshot_id, observed_at), self.observations(years).drop("report_year")
            new, revisions = B.diff(incoming, stored, NATURAL_KEY, VINTAGE_ORDER, VALUE_FIELDS, F.lit(observed_at).cast("timestamp"))
            if tombstones:
                known = B.asof(stored, F.lit(observed_at).cast("timestamp"), NATURAL_KEY, VINTAGE_ORDER).where("not is_tombstone")
                gone = B.tombstones(known, incoming, NATURAL_KEY, ["report_date", "report_type", "combined"])
                new = new.unionByName(vanished(gone, snapshot_id, observed_at).withColumn("_unexplained", F.lit(False)))
            new = new.withColumn("report_year", F.year("report_date")).persist()
            revisions = revisions.withColumn("detected_year", F.year("detected_at")).persist()
            try:
                counts = new.agg(F.count("*").alias("n"), F.count_if("_unexplained").alias("odd")).first()
                n, m = counts["n"], revisions.count()
                if counts["odd"]:
                    raise Q.ValidationError(f"the hash of {counts['odd']} rows changed though no field did")
                if m:
                    self.store.append(revisions, "revisions", [_PARTITION["revisions"]])
                if n:
                    self.store.append(new.drop("_unexplained"), "observations", [_PARTITION["observations"]])
            finally:
                new.unpersist()
                revisions.unpersist()
        return {"observations": n, "revisions": m, "warnings": warnings}

    def ingest_pending(self, **which) -> dict:
        """Ingest the selected snapshots, each on its own: one that can't be read is marked failed and the others go on."""
        out = {"ok": 0, "failed": 0, "observations": 0, "revisions": 0, "warnings": [], "errors": []}
        for s in sorted(self.select(**which), key=lambda s: s["retrieved_at"]):
            try:
                with self.store.staging("decoded") as staged:
                    wide = archives.read_report(self.spark, str(normal_path(s["local_path"], self.store.root)), s["report_type"], staged=staged)
                    got = self.ingest(canonicalise(wide, s["report_type"]), s["snapshot_id"], datetime.fromisoformat(s["retrieved_at"]))
                self.mark(s["snapshot_id"], parse_status="ok", parse_error=None)
                out["ok"] += 1
                for k in ("observations", "revisions"):
                    out[k] += got[k]
                out["warnings"] += got["warnings"]
            except Exception as e:
                self.mark(s["snapshot_id"], parse_status="failed", parse_error=str(e)[:500])
                out["failed"] += 1
                out["errors"].append((s["snapshot_id"], str(e)[:500]))
        return out

    # reads

    def asof(self, t: datetime | None = None, report_date: date | None = None, market_code: str | None = None, report_type: str | None = None) -> DataFrame:
        """What was known at ``t``, without what had vanished by then; None is everything known now. A report date also prunes partitions."""
        df = self.observations([report_date.year] if report_date else None)
        for c, v in (("report_date", report_date), ("market_code", market_code), ("report_type", report_type)):
            if v is not None:
                df = df.where(F.col(c) == F.lit(v))
        return B.asof(df, F.lit(t).cast("timestamp") if t else None, NATURAL_KEY, VINTAGE_ORDER).where("not is_tombstone").drop("report_year")

    def diff(self, since: datetime | None = None, market: str | None = None, report_type: str | None = None) -> DataFrame:
        df = self.revisions(None).drop("detected_year")
        if since:
            df = df.where(F.col("detected_at") >= F.lit(since).cast("timestamp"))
        if market:
            df = df.where(F.col("market_code") == market)
        return df.where(F.col("report_type") == report_type) if report_type else df

    def deep_revisions(self, days: int = 30) -> DataFrame:
        return self.revisions().where(F.col("age_days") > days)

    def zero_sum(self, **which) -> DataFrame:
        return Q.zero_sum(self.asof(**which))

    def coverage(self, report_type: str) -> DataFrame:
        found = Q.coverage(self.asof(report_type=report_type)).withColumnRenamed("n_weeks", "weeks")
        return found.select(F.lit(report_type).alias("report_type"), *[c.split()[0] for c in COVERAGE.split(", ")[1:]])

    def write_coverage(self, report_type: str) -> DataFrame:
        """Keep the coverage as a table; a report without observations leaves the table there is."""
        found = self.coverage(report_type)
        if found.isEmpty():
            raise StoreError(f"no observations of {report_type}: its coverage stays as it is")
        with self.store.lock():
            self.store.replace(found, f"coverage_{report_type}")
        return self.read_coverage(report_type)

    def read_coverage(self, report_type: str) -> DataFrame:
        return self.store.read(f"coverage_{report_type}", COVERAGE)

    # release dates

    def schedule(self) -> DataFrame:
        return self.store.read("release_schedule", SCHEDULE)

    def sync_schedule(self, rows: DataFrame) -> None:
        self.store.replace(R.merge_schedule(self.schedule(), rows.select(*[c.split()[0] for c in SCHEDULE.split(", ")])), "release_schedule")

    def sync_announcements(self, rows: DataFrame, scraped_at: datetime) -> None:
        new = rows.select("announcement_date", "raw_text", "url", F.lit(scraped_at).cast("timestamp").alias("scraped_at"), F.lit(None).cast("date").alias("affected_report_date"), F.lit(None).cast("string").alias("affected_market"))
        old = self.store.read("announcements", ANNOUNCEMENT)
        self.store.replace(B.first_by_key(old.unionByName(new), ["announcement_date", "raw_text"], [F.col("scraped_at").asc()]), "announcements")

    def published(self) -> DataFrame:
        """Schedule rows of the retained weekly files: the server's date of the first file of each report date."""
        weekly = [s for s in self.snapshots() if s["kind"] == "weekly" and s.get("local_path") and s.get("http_last_modified")]
        if not weekly:
            return self.spark.createDataFrame([], SCHEDULE)
        paths = sorted({str(normal_path(s["local_path"], self.store.root)) for s in weekly})
        dates = archives.weekly_report_dates(self.spark, paths).withColumn("local_path", F.regexp_extract("path", r"(raw/.*)$", 1))
        from revlake.functions.scalar import http_release_date

        rows = self.log().join(dates, "local_path").where("report_date is not null").select(
            "report_date", http_release_date(F.col("http_last_modified")).alias("release_date"), F.lit("published").alias("source"), F.concat_ws(" ", F.lit("weekly file of"), "http_last_modified").alias("note"), F.col("retrieved_at").alias("ingested_at"),
        )
        return B.first_by_key(rows.where("release_date is not null"), ["report_date"], [F.col("ingested_at").asc()])

    def backfill(self) -> dict[str, int]:
        """Resolve the release dates of all observations in place; how many came from each source."""
        with self.store.lock():
            schedule = R.merge_schedule(self.schedule(), self.published())
            resolved = R.backfill(self.observations(), schedule)
            self.store.replace(resolved, "observations", ["report_year"])
        return {r["release_date_source"]: r["n"] for r in R.source_counts(self.observations()).collect()}

    def release_gaps(self) -> DataFrame:
        """Releases that aren't three days after their report date: holiday shifts, backlog weeks, unknown dates."""
        return Q.release_gaps(self.observations())
