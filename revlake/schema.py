"""The canonical long schema, its vocabularies and the published column names that feed it."""

from __future__ import annotations

NATURAL_KEY = ["report_date", "market_code", "report_type", "combined", "category"]
SIDE_FIELDS = ["long_contracts", "short_contracts", "open_interest"]
VALUE_FIELDS = [
    "long_contracts", "short_contracts", "spread_contracts", "trader_count_long", "trader_count_short", "open_interest",
    *(f"cr{n}_net_{side}" for n in (4, 8) for side in ("long", "short")),
]
VINTAGE_ORDER = ["observed_at", "snapshot_id"]

CANONICAL = (
    "report_date date, market_code string, report_type string, combined boolean, category string, market_name string, "
    + ", ".join(f"{f} {'double' if f.startswith('cr') else 'long'}" for f in VALUE_FIELDS)
)
OBSERVATION = CANONICAL + ", release_date date, release_date_source string, observed_at timestamp, snapshot_id string, row_sha256 string, is_tombstone boolean"
REVISION = (
    "report_date date, market_code string, report_type string, combined boolean, category string, field string, old_value string, new_value string, "
    "delta double, pct_delta double, old_snapshot_id string, new_snapshot_id string, detected_at timestamp, age_days int, revision_id string"
)
SCHEDULE = "report_date date, release_date date, source string, note string, ingested_at timestamp"
ANNOUNCEMENT = "announcement_date date, raw_text string, url string, scraped_at timestamp, affected_report_date date, affected_market string"
COVERAGE = "report_type string, report_year int, market_code string, market_name string, first_report_date date, last_report_date date, weeks long"

VOCABULARY = {
    "legacy": ["commercial", "noncommercial", "nonreportable"],
    "disaggregated": ["producer_merchant", "swap", "managed_money", "other_reportable", "nonreportable"],
    "tff": ["dealer", "asset_manager", "leveraged", "other_reportable", "nonreportable"],
    "supplemental": ["commercial", "noncommercial", "index_trader", "nonreportable"],
}


def _group(stem: str, spread: str | None = None, suffix: str = "_All", short: str | None = None, traders: str | None = None) -> list[str | None]:
    """[long, short, spread, traders long, traders short] column names of one trader group."""
    t = traders or stem
    return [f"{stem}_Positions_Long{suffix}", f"{short or stem}_Positions_Short{suffix}", spread, *([f"Traders_{t}_{s}{suffix}" for s in ("Long", "Short")] if traders != "" else [None, None])]


def _spread(stem: str) -> str:
    return f"{stem}_Positions_Spread_All"


_REST = ["NonRept_Positions_Long_All", "NonRept_Positions_Short_All", None, None, None]
#: report type -> category -> [long, short, spread, traders long, traders short]; None: the report doesn't publish it.
#: Doubled underscores and the misspelt ``Postions`` are the publisher's.
GROUPS: dict[str, dict[str, list[str | None]]] = {
    "legacy": {"commercial": _group("Comm"), "noncommercial": _group("NonComm"), "nonreportable": _REST},
    "disaggregated": {
        "producer_merchant": _group("Prod_Merc"),
        "swap": _group("Swap", _spread("Swap_"), short="Swap_"),
        "managed_money": _group("M_Money", _spread("M_Money")),
        "other_reportable": _group("Other_Rept", _spread("Other_Rept")),
        "nonreportable": _REST,
    },
    "tff": {c: _group(s, _spread(s)) for c, s in (("dealer", "Dealer"), ("asset_manager", "Asset_Mgr"), ("leveraged", "Lev_Money"), ("other_reportable", "Other_Rept"))} | {"nonreportable": _REST},
    "supplemental": {
        "noncommercial": _group("NComm", "NComm_Postions_Spread_All_NoCIT", "_All_NoCIT", traders="NonComm"),
        "commercial": _group("Comm", suffix="_All_NoCIT"),
        "index_trader": _group("CIT"),
        "nonreportable": _REST,
    },
}
CONCENTRATION = {f"cr{n}_net_{side.lower()}": f"Conc_Net_LE_{n}_TDR_{side}_All" for n in (4, 8) for side in ("Long", "Short")}
NAME, CODE, OPEN_INTEREST, FLAG = "Market_and_Exchange_Names", "CFTC_Contract_Market_Code", "Open_Interest_All", "FutOnly_or_Combined"
LEGACY_COLUMNS = [NAME, "Report_Date_as_MM_DD_YYYY", CODE, OPEN_INTEREST, *(c for g in GROUPS["legacy"].values() for c in g if c), "Traders_Tot_All"]
FIRST_YEAR = {"legacy": 1986, "disaggregated": 2006, "tff": 2006, "supplemental": 2006}
STORE_SCHEMA_VERSION = 2
