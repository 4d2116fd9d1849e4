"""Synthetic archives and pages in the published layouts."""

import io
import zipfile

from revlake.schema import CODE, CONCENTRATION, FLAG, GROUPS, NAME, OPEN_INTEREST


def wide_row(report_type, date="2026-07-21", code="088691", name="GOLD", factor=1, date_column=None, flag="FutOnly", **changes):
    """A balanced row: every category has as many long as short."""
    date_column = date_column or {"legacy": "Report_Date_as_MM_DD_YYYY", "supplemental": "As_of_Date_In_Form_YYYY-MM-DD"}.get(report_type, "Report_Date_as_YYYY-MM-DD")
    row = {NAME: name, CODE: code, date_column: date, OPEN_INTEREST: 0}
    if flag is not None:
        row[FLAG] = flag
    total = 0
    for k, (long, short, spread, a, b) in enumerate(GROUPS[report_type].values(), 1):
        row[long], row[short] = 100 * k * factor, 100 * k * factor
        total += 100 * k * factor
        if spread:
            row[spread] = 10 * factor
            total += 10 * factor
        for c in (a, b):
            if c:
                row[c] = 5 + k
    row[OPEN_INTEREST] = total
    if report_type != "legacy":
        row |= {c: 20.5 for c in CONCENTRATION.values()}
    return row | changes


def write_zip(path, rows, member="annual.txt"):
    columns = list(dict.fromkeys(c for r in rows for c in r))
    quote = lambda v: "" if v is None else f'"{v}"' if isinstance(v, str) and "," in v else str(v)
    text = "\n".join([",".join(f" {c} " for c in columns), *[",".join(quote(r.get(c)) for c in columns) for r in rows]])
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr(member, text)
        z.writestr("second.txt", "not,read\n1,2")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data.getvalue())
    return data.getvalue()
