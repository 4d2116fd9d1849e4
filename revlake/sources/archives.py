"""Report archives: zipped CSV, zipped workbooks and the headerless weekly file."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.functions import scalar as S
from revlake.schema import CODE, FLAG, LEGACY_COLUMNS

DATE = "report_date"


class LayoutError(ValueError):
    """A file whose columns aren't those of its report."""


def _rows(name: str, data: bytes) -> Iterator[dict[str, str | None]]:
    if name.lower().endswith((".xls", ".xlsx")):
        import pandas as pd  # workbooks need an engine that pandas finds, such as xlrd

        for row in pd.read_excel(io.BytesIO(data), dtype=str).to_dict("records"):
            yield {str(k).strip(): None if v != v else v for k, v in row.items()}
        return
    reader = csv.reader(io.StringIO(data.decode("utf-8-sig", "replace"), newline=""))
    header = [c.strip() for c in next(reader, [])]
    for row in reader:
        if any(row):
            yield dict(zip(header, [c if c.strip() else None for c in row], strict=False))


def _header(name: str, z: zipfile.ZipFile) -> list[str]:
    """Names of the columns of a member, of which only the first line is decoded."""
    if name.lower().endswith((".xls", ".xlsx")):
        return list(next(_rows(name, z.read(name)), {}))
    with z.open(name) as f:
        return [c.strip() for c in next(csv.reader(io.TextIOWrapper(f, "utf-8-sig", "replace", newline="")), [])]


def read_archives(spark: SparkSession, paths: str | Sequence[str], keep: Sequence[str] | None = None, staged: str | None = None) -> DataFrame:
    """All rows of the first member of each zip, every column a string under its stripped name; ``path`` tells the file.

    A column that only some files have is null elsewhere; so is a blank cell. Archives are decoded by the
    executors, one file a task; the driver only learns the names of the columns, from the first lines. With ``staged``, a new
    folder, each file is decoded once, into Parquet there that all later reads take.
    """
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select("path", "content")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    member = z.namelist()[0]
                    rows = list(_rows(member, z.read(member)))
                for a in range(0, len(rows), 10_000):
                    part = rows[a : a + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array([list(r.items()) for r in part], pa.map_(pa.string(), pa.string()))], ["path", "row"])

    def header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = set()
            for content in batch.column("content").to_pylist():
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names.update(_header(z.namelist()[0], z))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(names), pa.string())], ["name"])

    names = keep or [r["name"] for r in files.mapInArrow(header, "name string").distinct().orderBy("name").collect() if r["name"]]
    rows = files.mapInArrow(decode, "path string, row map<string,string>").select("path", *[F.col("row").getItem(n).alias(n) for n in names])
    if staged is None:
        return rows
    rows.write.parquet(staged)
    return spark.read.schema(rows.schema).parquet(staged)


def with_report_date(df: DataFrame) -> DataFrame:
    """The file's date column, parsed whatever its format, as ``report_date``; codes standardised."""
    named = [c for c in df.columns if "Report_Date" in c] or [c for c in df.columns if c.startswith("As_of_Date") and not c.endswith("YYMMDD")]
    if not named:
        raise LayoutError("no report date column")
    date = F.coalesce(*[S.mixed_date(F.col(f"`{c}`")) for c in named])
    return df.withColumns({DATE: date, CODE: S.standard_code(F.col(CODE))}).drop(*[c for c in named if c != DATE])


def read_report(spark: SparkSession, paths: str | Sequence[str], report_type: str, years: tuple[int, int] | None = None, today=None, staged: str | None = None) -> DataFrame:
    """Wide rows of one report: legacy has its published columns only, the others all they come with.

    ``years`` keeps a range of a bundle. A date more than a week ahead is a parsing fault and raises.
    """
    df = with_report_date(read_archives(spark, paths, LEGACY_COLUMNS if report_type == "legacy" else None, staged))
    if years:
        df = df.where(F.year(DATE).between(*years))
    now = F.lit(today).cast("date") if today else F.current_date()
    newest, ahead = df.agg(F.max(DATE), F.max(DATE) > F.date_add(now, 7)).first()
    if ahead:
        raise LayoutError(f"report date {newest} lies ahead")
    return df


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def combined_flag(df: DataFrame, report_type: str) -> bool:
    """Whether a report covers futures and options combined; a file of both raises, the supplemental must be combined."""
    seen = set() if FLAG not in df.columns else {r[0] for r in df.select(F.lower(F.trim(F.col(FLAG)))).where(F.col(FLAG).isNotNull()).distinct().collect()}
    if len(seen) > 1:
        raise LayoutError(f"futures-only and combined rows in one file: {sorted(seen)}")
    combined = any("combined" in s for s in seen)
    if report_type == "supplemental":
        if seen and not combined:
            raise LayoutError("a supplemental report that isn't combined")
        return True
    return combined


def weekly_report_dates(spark: SparkSession, paths: str | Sequence[str], field: int = 2) -> DataFrame:
    """(path, report_date): the date in the given field of the first long enough line of each headerless file."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("path"), F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(field + 1)))).alias("r"))
    return lines.where(F.col(f"r.c{field}").isNotNull()).groupBy("path").agg(F.first(S.mixed_date(F.col(f"r.c{field}")), ignorenulls=True).alias("report_date"))


def binary_hashes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, length, modificationTime, content_sha256) of files; the content stays with the executors."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select("path", "length", "modificationTime", S.content_sha256(F.col("content")).alias("content_sha256"))
