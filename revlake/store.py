"""The store on disk: staged table writes, a single-writer lock, manifests of two halves and the status document.

Layout below the root: ``tables/{domain}/v={id}`` (Parquet, partitioned), ``tables/{domain}.json`` that names the version to read,
``manifests/{half}.json``, ``status.json``, ``raw/``. A table is replaced by writing another version and then the file that names it, in
one rename, so no job overwrites what it reads and a reader or a crash finds the old table or the new one. JSON files are control
plane, some entries per domain, and stay on the driver.
"""

from __future__ import annotations

import contextlib
import json
import os
import shutil
import socket
import uuid
from collections.abc import Iterator, Sequence
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.operators import manifest as M
from revlake.schema import STORE_SCHEMA_VERSION

HALVES = {"cot": ["cot_legacy", "cot_disagg", "cot_tff", "cot_supplemental"], "prices": ["prices", "metadata"]}
RETIRED = ("prices", "metadata")
FLOORS = {"annual": 1024, "weekly": 512}


class StoreError(RuntimeError):
    """A store that can't be used as asked."""


def half_of(domain: str) -> str:
    for half, domains in HALVES.items():
        if domain in domains:
            return half
    raise StoreError(f"domain {domain} belongs to no half")


def require_size(content: bytes, kind: str) -> None:
    if len(content) < FLOORS[kind]:
        raise StoreError(f"{len(content)} bytes are too few for a file of kind {kind}")


def read_json(path: Path, strict: bool = False) -> dict:
    """A JSON object; a missing file is empty. A damaged one is empty too, or if ``strict`` is put aside and raises."""
    if not path.exists():
        return {}
    try:
        return json.loads(path.read_text())
    except json.JSONDecodeError as e:
        if not strict:
            return {}
        aside = path.with_name(f"{path.name}.damaged-{datetime.now(UTC):%Y%m%dT%H%M%S}")
        os.replace(path, aside)
        raise StoreError(f"{path} is damaged and was moved to {aside}") from e


def write_json(path: Path, data: dict) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    part.write_text(json.dumps(data, indent=1, sort_keys=True, default=str))
    os.replace(part, path)


def normal_path(path: str, root: Path) -> Path:
    """A recorded path, whichever separators it was written with; relative ones are below the root."""
    p = path.replace("\\", "/")
    return Path(p) if p.startswith("/") or p[1:3] == ":/" else root / p


class Store:
    def __init__(self, spark: SparkSession, root: str | None = None):
        root = root or os.environ.get("REVLAKE_STORE")
        if not root:
            raise StoreError("name a store, by argument or in REVLAKE_STORE")
        self.spark, self.root = spark, Path(root)

    # tables

    def table_path(self, domain: str) -> Path:
        version = read_json(self._pointer(domain)).get("version")
        return self.root / "tables" / domain / (f"v={version}" if version else "")

    def _pointer(self, domain: str) -> Path:
        return self.root / "tables" / f"{domain}.json"

    @contextlib.contextmanager
    def staging(self, name: str) -> Iterator[str]:
        """A folder of the store for what a job stages; gone afterwards."""
        path = self.root / "_staging" / f"{name}-{uuid.uuid4().hex}"
        try:
            yield str(path)
        finally:
            shutil.rmtree(path, ignore_errors=True)

    def exists(self, domain: str) -> bool:
        return self.table_path(domain).is_dir() and any(self.table_path(domain).rglob("*.parquet"))

    def read(self, domain: str, schema: str) -> DataFrame:
        """The table, or an empty one of its schema where nothing was written yet."""
        if not self.exists(domain):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(str(self.table_path(domain)))

    def read_wide(self, domain: str) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", "true").parquet(str(self.table_path(domain))) if self.exists(domain) else None

    def replace(self, df: DataFrame, domain: str, partition: Sequence[str] = ()) -> None:
        """Write another version and then switch to it; the version before stays for those who read it, older ones go."""
        version, old = uuid.uuid4().hex, read_json(self._pointer(domain)).get("version")
        target = self.root / "tables" / domain
        self._spread(df, partition).write.partitionBy(*partition).parquet(str(target / f"v={version}"))
        write_json(self._pointer(domain), {"version": version})
        for path in target.glob("v=*"):
            if path.name not in (f"v={version}", f"v={old}"):
                shutil.rmtree(path, ignore_errors=True)

    def append(self, df: DataFrame, domain: str, partition: Sequence[str] = ()) -> None:
        if not read_json(self._pointer(domain)).get("version"):
            write_json(self._pointer(domain), {"version": uuid.uuid4().hex})
        self._spread(df, partition).write.mode("append").partitionBy(*partition).parquet(str(self.table_path(domain)))

    @staticmethod
    def _spread(df: DataFrame, partition: Sequence[str]) -> DataFrame:
        """Rows of one partition value near one another, in as many tasks as their size asks for: adaptive execution splits large ones."""
        return df.hint("rebalance", *partition) if partition else df

    @contextlib.contextmanager
    def lock(self) -> Iterator[None]:
        """One writer at a time; a second one fails loudly and names the first."""
        path = self.root / ".lock"
        path.parent.mkdir(parents=True, exist_ok=True)
        try:
            fd = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            raise StoreError(f"{path} is held by {path.read_text() or 'another writer'}") from None
        try:
            os.write(fd, f"{socket.gethostname()} pid {os.getpid()} since {datetime.now(UTC):%FT%TZ}".encode())
            os.close(fd)
            yield
        finally:
            path.unlink(missing_ok=True)

    # manifests

    def manifest_path(self, half: str) -> Path:
        if half not in HALVES:
            raise StoreError(f"no half {half}")
        return self.root / "manifests" / f"{half}.json"

    def manifest(self) -> dict:
        """Both halves; of a half without a file of its own, what the old aggregate ``manifest.json`` has of its domains."""
        old = read_json(self.root / "manifest.json")
        out: dict = {"schema_version": 0}
        for half, domains in HALVES.items():
            path = self.manifest_path(half)
            part = read_json(path, strict=True) if path.exists() else {d: old[d] for d in domains if d in old} | {"schema_version": old.get("schema_version", 0)}
            out["schema_version"] = max(int(out["schema_version"]), int(part.get("schema_version") or 0))
            out |= {d: part[d] for d in domains if part.get(d)}
        return out

    def entries(self) -> DataFrame:
        rows = [
            (d, n, _date(e.get("last_date")), int(e.get("n_rows") or 0), e.get("source"), _time(e.get("updated_at")))
            for d, es in self.manifest().items() if isinstance(es, dict) for n, e in es.items()
        ]
        return self.spark.createDataFrame(rows, M.ENTRY)

    def touch(self, new: DataFrame) -> None:
        """Put entries (as ``manifest.describe`` makes them) in place; one small row for each instrument."""
        by_half: dict[str, list] = {}
        for r in new.collect():
            by_half.setdefault(half_of(r["domain"]), []).append(r)
        for half, rows in by_half.items():
            data = read_json(self.manifest_path(half), strict=True) or {k: v for k, v in self.manifest().items() if k in HALVES[half]}
            for r in rows:
                data.setdefault(r["domain"], {})[r["name"]] = {"last_date": str(r["last_date"]), "n_rows": r["n_rows"], "source": r["source"], "updated_at": f"{r['updated_at']:%Y-%m-%dT%H:%M:%SZ}"}
            write_json(self.manifest_path(half), data | {"schema_version": STORE_SCHEMA_VERSION})

    def migrate(self) -> dict[str, int]:
        """Move entries of the old aggregate that a half lacks into it; how many each half got."""
        old, moved = read_json(self.root / "manifest.json"), {}
        for half, domains in HALVES.items():
            data, n = read_json(self.manifest_path(half), strict=True), 0
            for d in domains:
                for name, entry in (old.get(d) or {}).items():
                    if name not in data.setdefault(d, {}):
                        data[d][name] = entry
                        n += 1
            if n:
                write_json(self.manifest_path(half), data | {"schema_version": max(STORE_SCHEMA_VERSION, int(data.get("schema_version") or 0))})
            moved[half] = n
        return moved

    def unmigrated(self) -> list[tuple[str, str]]:
        """Entries of the old aggregate that no half has."""
        old = read_json(self.root / "manifest.json")
        halves = {d: read_json(self.manifest_path(h)).get(d) or {} for h, ds in HALVES.items() for d in ds}
        return sorted((d, n) for d, es in old.items() if isinstance(es, dict) for n in es if n not in halves.get(d, {}))

    def reconcile(self, files: DataFrame) -> list[tuple[str, str]]:
        """Drop the entries that no file (domain, name) stands behind; what was dropped."""
        gone = sorted((r["domain"], r["name"]) for r in M.ghosts(self.entries(), files, ["domain", "name"]).collect())
        for half in HALVES:
            data = read_json(self.manifest_path(half), strict=True)
            for d, n in gone:
                if d in HALVES[half]:
                    data.get(d, {}).pop(n, None)
                    if not data.get(d, True):
                        del data[d]
            if data:
                write_json(self.manifest_path(half), data)
        return gone

    def require_schema(self, least: int) -> int:
        version = int(self.manifest()["schema_version"])
        if version < least:
            raise StoreError(f"the store has schema {version}; {least} is needed")
        return version

    # status

    def status(self, last_run: dict | None = None, today: date | None = None, ignore: Sequence[str] = ()) -> dict:
        entries = self.entries()
        domains = {r["domain"]: r for r in M.summarise(entries, F.lit(today or datetime.now(UTC).date())).collect()}
        late: dict[str, list] = {}
        for r in M.lag_days(entries, RETIRED, ignore).collect():
            late.setdefault(r["domain"], []).append([r["name"], r["days"]])
        doc = {
            "generated_at": f"{datetime.now(UTC):%Y-%m-%dT%H:%M:%SZ}", "schema_version": self.manifest()["schema_version"], "newest_data": {d: str(r["newest"]) for d, r in domains.items()},
            "domains": {
                d: {"newest_data": str(r["newest"]), "oldest_data": str(r["oldest"]), "last_write": str(r["last_write"]), "entries": r["entries"], "rows": r["n_rows"], "behind_today": r["days_behind"], "lagging": late.get(d, []), "retired": d in RETIRED}
                for d, r in domains.items()
            },
        }
        return doc | ({"last_run": last_run} if last_run else {})

    def write_status(self, last_run: dict | None = None) -> Path:
        """The status document; ``new_data`` has the domains whose newest date moved on since the one before."""
        path, doc = self.root / "status.json", self.status(last_run)
        write_json(path, doc | {"new_data": {d: list(x) for d, x in new_data(read_json(path), doc).items()}})
        return path


def load_manifest(store: Store) -> dict:
    return store.manifest()


def schema_version(store: Store) -> int:
    return int(store.manifest()["schema_version"])


def require_schema(store: Store, least: int) -> int:
    return store.require_schema(least)


def report(status: dict) -> str:
    lines = [f"store schema {status['schema_version']}, {status['generated_at']}"]
    for d, s in sorted(status["domains"].items()):
        lines.append(f"{d}: {s['entries']} entries, {s['rows']} rows, {s['oldest_data']} to {s['newest_data']}, written {s['last_write']}" + " (retired)" * s["retired"])
        lines += [f"  behind: {n} by {days} days" for n, days in s["lagging"][:15]]
    return "\n".join(lines)


def run_summary(run: dict) -> str:
    return "; ".join(f"{r['kind']}: {r['wrote']} written" + ("" if r["ok"] else ", FAILED") for r in run.get("results", [])) or "nothing ran"


def fresh_files(files: DataFrame, max_age_hours: float | None = None, now=None) -> DataFrame:
    """(path, modificationTime, fresh) of a listing: whether a replica was refreshed within the hours, or without them on today's date."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    fresh = at.cast("date") == F.col("modificationTime").cast("date") if max_age_hours is None else (F.unix_timestamp(at) - F.unix_timestamp("modificationTime")) <= max_age_hours * 3600
    return files.select("path", "modificationTime", fresh.alias("fresh"))


def unequal_times(a: DataFrame, b: DataFrame) -> DataFrame:
    """(name, ta, tb) of files (name, modificationTime) of two replicas that should carry the producer's own time and don't."""
    both = a.select("name", F.col("modificationTime").alias("ta")).join(b.select("name", F.col("modificationTime").alias("tb")), "name")
    return both.where("ta <> tb")


def data_files(store: Store) -> DataFrame:
    """(domain, name, modificationTime): the partitions (or whole tables) that a store's current versions hold, with the newest file's time."""
    rows: dict[tuple[str, str], float] = {}
    for pointer in (store.root / "tables").glob("*.json"):
        table = store.table_path(pointer.stem)
        for f in table.rglob("*.parquet"):
            key = pointer.stem, str(f.parent.relative_to(table))
            rows[key] = max(rows.get(key, 0.0), f.stat().st_mtime)
    return store.spark.createDataFrame([(d, n, datetime.fromtimestamp(int(t), UTC)) for (d, n), t in sorted(rows.items())], "domain string, name string, modificationTime timestamp")


def compare_stores(a: Store, b: Store) -> dict[str, list]:
    """What a mirror from ``a`` to ``b`` would destroy: entries, files and tables only in ``b``, and entries of one name from different sources."""
    ea, eb, fa, fb = a.entries(), b.entries(), data_files(a), data_files(b)
    rows = lambda df: sorted(tuple(r) for r in df.collect())  # noqa: E731 - control plane: one row for each instrument
    tables = lambda s: {p.name for p in (s.root / "tables").glob("*") if p.is_dir()}
    return {
        "only_in_target": rows(M.only_in(eb, ea, ["domain", "name"]).select("domain", "name")),
        "different_source": rows(M.replica_diff(ea, eb, ["domain", "name"], "source")),
        "files_only_in_target": rows(M.only_in(fb, fa, ["domain", "name"]).select("domain", "name")),
        "tables_only_in_target": sorted(tables(b) - tables(a)),
    }


def new_data(before: dict, now: dict) -> dict[str, tuple[str | None, str]]:
    """Domains whose newest date moved on between two status documents, retired ones aside: (last seen, newest)."""
    seen = before.get("newest_data", {})
    return {d: (seen.get(d), n) for d, n in now["newest_data"].items() if not now["domains"][d]["retired"] and n != "None" and n > (seen.get(d) or "")}


def _date(text) -> date | None:
    try:
        return date.fromisoformat(str(text)[:10])
    except ValueError:
        return None


def _time(text) -> datetime | None:
    try:
        t = datetime.fromisoformat(str(text))
        return t if t.tzinfo else t.replace(tzinfo=UTC)
    except ValueError:
        return None
