"""Wide published reports to canonical long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.functions import scalar as S
from revlake.operators.bitemporal import melt
from revlake.schema import CODE, CONCENTRATION, GROUPS, NAME, OPEN_INTEREST, VALUE_FIELDS
from revlake.sources.archives import DATE, LayoutError, combined_flag

#: Spellings that publishers have used for one another; up to three of them may apply to one name.
VARIANTS = [("__", "_"), ("_", "__"), ("Postions", "Positions"), ("Positions", "Postions"), ("NComm", "NonComm"), ("NonComm", "NComm"), ("_All_NoCIT", "_NoCIT"), ("NonRept", "NonRpt"), (" ", "_")]


def resolve_header(columns: Sequence[str], name: str, depth: int = 3) -> str:
    """The column that a name means: itself, else the nearest spelling within ``depth`` substitutions; none raises."""
    have, reached = set(columns), {name}
    for _ in range(depth + 1):
        hits = sorted(reached & have)
        if hits:
            return hits[0]
        reached |= {n.replace(a, b, 1) for n in reached for a, b in VARIANTS if a in n}
    raise LayoutError(f"no column for {name}")


def canonicalise(wide: DataFrame, report_type: str) -> DataFrame:
    """One row per category with all canonical columns; what the report doesn't publish is null, as is a suppressed figure."""
    combined = combined_flag(wide, report_type)
    find = lambda n: F.col(f"`{resolve_header(wide.columns, n)}`")
    number = lambda n, kind="long": S.to_number(find(n), kind) if n else F.lit(None).cast(kind)

    def concentration(name: str):
        try:
            return number(name, "double") if report_type != "legacy" else F.lit(None).cast("double")
        except LayoutError:
            return F.lit(None).cast("double")

    values = {}
    for category, (long, short, spread, many_long, many_short) in GROUPS[report_type].items():
        figures = [number(long), number(short), number(spread), number(many_long), number(many_short), number(OPEN_INTEREST)]
        values[category] = dict(zip(VALUE_FIELDS, figures, strict=False)) | {f: concentration(n) for f, n in CONCENTRATION.items()}
    rows = wide.select("*", F.col(DATE).cast("date").alias("_d"), S.standard_code(find(CODE)).alias("market_code"), S.clean_name(find(NAME)).alias("market_name"))
    long = melt(rows, ["_d", "market_code", "market_name"], values)
    return long.select(F.col("_d").alias("report_date"), "market_code", F.lit(report_type).alias("report_type"), F.lit(combined).alias("combined"), "category", "market_name", *VALUE_FIELDS)


def with_hash(rows: DataFrame) -> DataFrame:
    kinds = dict(rows.dtypes)
    return rows.withColumn("row_sha256", S.row_hash({f: S.canonical_value(F.col(f), kinds[f]) for f in VALUE_FIELDS}))


def vanished(gone: DataFrame, snapshot_id: str, observed_at) -> DataFrame:
    """Observations of keys that a snapshot lacks: no values, the hash of none, ``is_tombstone``."""
    nothing = {f: F.lit(None).cast(gone.schema[f].dataType) for f in VALUE_FIELDS}
    rows = with_hash(gone.select(*[nothing[c].alias(c) if c in nothing else F.col(c) for c in gone.columns if c != "row_sha256"]))
    stamp = {"observed_at": F.lit(observed_at).cast("timestamp"), "snapshot_id": F.lit(snapshot_id), "is_tombstone": F.lit(True)}
    return rows.withColumns(stamp).select(*gone.columns)


def stamped(canonical: DataFrame, snapshot_id: str, observed_at) -> DataFrame:
    """Canonical rows as the observations of one snapshot."""
    rows = with_hash(canonical)
    return rows.select(
        *rows.columns[:-1], F.lit(None).cast("date").alias("release_date"), F.lit("unknown").alias("release_date_source"), F.lit(observed_at).cast("timestamp").alias("observed_at"),
        F.lit(snapshot_id).alias("snapshot_id"), "row_sha256", F.lit(False).alias("is_tombstone"),
    )
