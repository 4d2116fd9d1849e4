"""The instrument registry: symbol, asset class, contract code and predecessor codes with their contract scale.

The packaged table is CSV; a YAML file of ``class: {symbol: {cftc_code, hist_codes, report_type, is_equity}}`` may take its place, by argument or
by the environment variable REVLAKE_REGISTRY.
"""

from __future__ import annotations

import csv
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.functions import scalar as S

SCHEMA = "symbol string, asset_class string, code string, report_type string, is_equity boolean, predecessors array<struct<code:string,scale:double>>"


class RegistryError(ValueError):
    """A registry file that can't be used."""


def predecessors(raw) -> list[tuple[str, float]]:
    """(code, scale) of each entry; a bare code has scale 1."""
    return [(str(p[0]), float(p[1])) if isinstance(p, (list, tuple)) else (str(p), 1.0) for p in raw or []]


def _yaml_rows(path: str) -> list[tuple]:
    import yaml

    try:
        data = yaml.safe_load(Path(path).read_text())
    except yaml.YAMLError as e:
        raise RegistryError(f"{path} is not YAML: {e}") from e
    if not isinstance(data, dict):
        raise RegistryError(f"{path}: expected asset classes at the top")
    rows = []
    for asset_class, symbols in data.items():
        if not isinstance(symbols, dict):
            raise RegistryError(f"{path}: class {asset_class} holds no symbols")
        for symbol, attributes in symbols.items():
            a = attributes or {}
            if not isinstance(a, dict):
                raise RegistryError(f"{path}: {symbol} has no attributes")
            rows.append((str(symbol), asset_class, a.get("cftc_code"), a.get("report_type"), a.get("is_equity"), predecessors(a.get("hist_codes"))))
    return rows


def _csv_rows(path: str) -> list[tuple]:
    with open(path, newline="") as f:
        return [
            (r["symbol"], r["asset_class"], r["code"] or None, r["report_type"] or None, {"True": True, "False": False}.get(r["is_equity"]), predecessors([p.split("*") if "*" in p else p for p in r["predecessors"].split()]))
            for r in csv.DictReader(f)
        ]


def load(spark: SparkSession, path: str | None = None) -> DataFrame:
    path = path or os.environ.get("REVLAKE_REGISTRY") or str(Path(__file__).with_name("registry.csv"))
    if not Path(path).exists():
        raise FileNotFoundError(f"no registry at {path}; set REVLAKE_REGISTRY")
    rows = _csv_rows(path) if path.endswith(".csv") else _yaml_rows(path)
    seen: set[str] = set()
    for symbol, _, code, *_ in rows:
        if symbol in seen:
            raise RegistryError(f"{path}: {symbol} is declared twice")
        if not code:
            raise RegistryError(f"{path}: {symbol} has no contract code")
        seen.add(symbol)
    df = spark.createDataFrame([(s, a, str(c), *rest) for s, a, c, *rest in rows], SCHEMA)
    equity, report = S.asset_defaults(F.col("asset_class"), F.col("report_type"), F.col("is_equity"))
    return df.withColumns({"is_equity": equity, "report_type": report})


def all_symbols(registry: DataFrame) -> list[str]:
    """Every symbol, sorted."""
    return [r["symbol"] for r in registry.select("symbol").orderBy("symbol").collect()]


def symbol(registry: DataFrame, name: str) -> DataFrame:
    return registry.where(F.col("symbol") == name)


def by_asset_class(registry: DataFrame, asset_class: str) -> DataFrame:
    return registry.where(F.col("asset_class") == asset_class)


def retired_names(registry: DataFrame) -> DataFrame:
    """Names (symbol_code) of predecessor entries, which are frozen for good."""
    return registry.select("symbol", F.explode("predecessors.code").alias("old")).select(F.concat_ws("_", "symbol", "old").alias("name"))
