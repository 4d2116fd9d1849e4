"""Conditional downloads; every function that reaches the network takes the fetcher as an argument."""

from __future__ import annotations

import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from email.utils import format_datetime, parsedate_to_datetime
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.schema import FIRST_YEAR

BASE = "https://www.cftc.gov/files/dea/history/"
ARCHIVES = {"legacy": "deacot{y}.zip", "disaggregated": "fut_disagg_txt_{y}.zip", "tff": "fut_fin_txt_{y}.zip", "supplemental": "dea_cit_txt_{y}.zip"}
BUNDLES = {"disaggregated": "fut_disagg_txt_hist_2006_2016.zip", "tff": "fin_fut_txt_2006_2016.zip"}
WEEKLY = "https://www.cftc.gov/dea/newcot/deafut.txt"


@dataclass
class Response:
    status: int
    content: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)

    @property
    def etag(self) -> str | None:
        return self.headers.get("ETag")

    @property
    def last_modified(self) -> str | None:
        return self.headers.get("Last-Modified")


Fetch = Callable[..., Response]


def http_get(url: str, etag: str | None = None, last_modified: str | None = None, method: str = "GET", timeout: float = 60) -> Response:
    headers = {"User-Agent": os.environ.get("REVLAKE_USER_AGENT", "revlake")} | ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": last_modified} if last_modified else {})
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers, method=method), timeout=timeout) as r:
            return Response(r.status, r.read(), dict(r.headers))
    except urllib.error.HTTPError as e:
        if e.code == 304:
            return Response(304, b"", dict(e.headers))
        raise


def cached(url: str, path: Path, fetch: Fetch = http_get) -> Path | None:
    """The file at ``path``, renewed if the server has a later one; the stale file, or None, if it can't be reached."""
    try:
        since = format_datetime(datetime.fromtimestamp(path.stat().st_mtime, UTC), usegmt=True) if path.exists() else None
        got = fetch(url, last_modified=since)
        if got.status == 200:
            path.parent.mkdir(parents=True, exist_ok=True)
            part = path.with_name(path.name + ".part")
            part.write_bytes(got.content)
            os.replace(part, path)
            if got.last_modified:
                at = parsedate_to_datetime(got.last_modified).timestamp()
                os.utime(path, (at, at))
    except (OSError, urllib.error.URLError):
        pass
    return path if path.exists() else None


def sources(spark: SparkSession, year: int, kinds: list[str] | None = None) -> DataFrame:
    """(report_type, report_year, kind, url) of every archive up to a year, the bundles and the weekly file."""
    rows = [(t, FIRST_YEAR[t], p, BUNDLES.get(t)) for t, p in ARCHIVES.items() if not kinds or t in kinds]
    plan = spark.createDataFrame(rows, "report_type string, first int, pattern string, bundle string")
    start = F.when(F.col("bundle").isNull(), F.col("first")).otherwise(2017)
    years = plan.select("report_type", "pattern", F.explode(F.sequence(start, F.lit(year))).alias("report_year")).select("report_type", "report_year", F.lit("annual").alias("kind"), F.concat(F.lit(BASE), F.replace("pattern", F.lit("{y}"), F.col("report_year").cast("string"))).alias("url"))
    bundles = plan.where("bundle is not null").select("report_type", F.lit(2016).alias("report_year"), F.lit("bundle").alias("kind"), F.concat(F.lit(BASE), F.col("bundle")).alias("url"))
    weekly = spark.createDataFrame([("legacy", None, "weekly", WEEKLY)], "report_type string, report_year int, kind string, url string")
    return years.unionByName(bundles).unionByName(weekly)


def pause(seconds: float, sleep: Callable[[float], None] = time.sleep) -> None:
    if seconds > 0:
        sleep(seconds)
