"""The current-state store: the latest wide report of each instrument, replaced as a whole, and reads that stitch predecessors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake import registry as G
from revlake.operators import manifest as M
from revlake.operators import stitch as T
from revlake.operators.bitemporal import first_by_key
from revlake.schema import CODE
from revlake.sources.archives import DATE
from revlake.store import Store, StoreError
from revlake.vintage import Vintage

DOMAINS = {"legacy": "cot_legacy", "disagg": "cot_disagg", "tff": "cot_tff", "supplemental": "cot_supplemental"}
#: Report types whose totals may be compared, week by week; the supplemental covers options too.
COMPARABLE = {frozenset(("legacy", "disagg")), frozenset(("legacy", "tff"))}


@dataclass
class Result:
    kind: str
    ok: bool
    wrote: int
    error: str | None = None


def update(store: Store, kind: str, wide: DataFrame | None, registry: DataFrame, symbols: Sequence[str] = (), source: str = "archive", years: tuple[int, int] | None = None) -> Result:
    """Renew a domain by the rows of the registry's codes, current and predecessor, in one pass over the archives.

    Without ``symbols`` and ``years`` they replace the domain. With them they replace the instruments of those symbols, or
    the rows of those years, and everything else stays, entries included.
    """
    if wide is None:
        return Result(kind, False, 0, "the current year could not be read")
    codes = T.code_names(registry if not symbols else registry.where(F.col("symbol").isin(*symbols)))
    names = codes.select(F.col("code").alias(CODE), F.concat_ws("_", "symbol", "code").alias("name"))
    kept = wide.join(names, CODE).drop("path")
    with store.lock():
        old = store.read_wide(DOMAINS[kind]) if symbols or years else None
        if old is not None:
            goes = names.select("name", F.lit(True).alias("_goes"))
            old = old.join(goes, "name", "left").where(~(F.coalesce("_goes", F.lit(False)) & (F.year(DATE).between(*years) if years else F.lit(True)))).drop("_goes")
            kept = kept.unionByName(old, allowMissingColumns=True)
        store.replace(kept.sortWithinPartitions(DATE), DOMAINS[kind], ["name"])
        rows = store.read_wide(DOMAINS[kind]).withColumn("domain", F.lit(DOMAINS[kind]))
        entries = M.describe(rows.join(names.select("name").distinct(), "name", "left_semi"), "domain", "name", DATE, source).persist()
        store.touch(entries)
        n = entries.count()
        entries.unpersist()
    return Result(kind, True, n)


def _numbers(df: DataFrame) -> list[str]:
    """Columns that scale with the size of a contract: positions and open interest, not numbers of traders or shares."""
    return [c for c in df.columns if ("Positions" in c or "Postions" in c or c.startswith("Open_Interest")) and not c.startswith("Pct")]


def read(store: Store, name: str, report: str = "legacy", registry: DataFrame | None = None) -> DataFrame | None:
    """An instrument's weekly history by symbol or current code, its predecessors' weeks behind it; None if the domain is empty.

    Predecessor rows are scaled to the current contract and relabelled with the current code. Where both have a
    week, the current code wins. A name that the registry doesn't know is read as it is.
    """
    if report not in DOMAINS:
        raise ValueError(f"no report {report}; there are {', '.join(DOMAINS)}")
    rows = store.read_wide(DOMAINS[report])
    if rows is None:
        return None
    registry = registry if registry is not None else G.load(store.spark)
    hit = registry.where((F.col("symbol") == name) | (F.col("code") == name)).orderBy((F.col("symbol") != name).cast("int")).first()
    if hit is None:
        return rows.where(F.col("name") == name)
    numbers = _numbers(rows)
    parts = rows.where(F.col("name") == f"{hit['symbol']}_{hit['code']}").withColumn("_p", F.lit(0))
    for i, p in enumerate(hit["predecessors"], 1):
        old = rows.where(F.col("name") == f"{hit['symbol']}_{p['code']}").withColumn("_p", F.lit(i))
        if p["scale"] != 1.0:
            old = old.withColumns({c: (F.col(c).try_cast("double") * p["scale"]).cast(rows.schema[c].dataType) for c in numbers})
        parts = parts.unionByName(old.withColumn(CODE, F.lit(hit["code"])))
    return first_by_key(parts, [DATE], [F.col("_p").asc(), F.col("name").asc()]).drop("_p").orderBy(DATE)


def from_vintage(vintage: Vintage, as_of=None, market_code: str | None = None, report_type: str | None = None) -> DataFrame:
    """A point-in-time panel: what was known at ``as_of``."""
    return vintage.asof(as_of, market_code=market_code, report_type=report_type)


def from_current_store(store: Store, code: str, report: str = "legacy", registry: DataFrame | None = None) -> DataFrame | None:
    """The present state, which is not point-in-time: later revisions are in it."""
    return read(store, code, report, registry)


def reconcile(a: DataFrame, b: DataFrame, kinds: tuple[str, str], sums: dict[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """Differences between sums of columns that two reports should share: market, date and one column per identity."""
    if frozenset(kinds) not in COMPARABLE:
        raise StoreError(f"{kinds[0]} and {kinds[1]} don't measure the same quantities")
    total = lambda cols: sum((F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    left = a.select(CODE, DATE, *[total(x).alias(n) for n, (x, _) in sums.items()])
    right = b.select(CODE, DATE, *[total(y).alias(f"_{n}") for n, (_, y) in sums.items()])
    return left.join(right, [CODE, DATE]).select(CODE, DATE, *[(F.col(n) - F.col(f"_{n}")).alias(n) for n in sums])
