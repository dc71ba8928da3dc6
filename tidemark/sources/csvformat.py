"""How datasets are kept as CSV."""

from __future__ import annotations

# How quotes, blanks and missing values are written in dataset CSV.
CSV_FORMAT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
MISSING = "\\N"
# Where a record is put that has not the expected cells.
BAD = "_bad_record"


def write_options(header: bool = False) -> dict[str, object]:
    """Options that make Spark write CSV the way datasets keep it."""
    return {**CSV_FORMAT, "nullValue": MISSING, "emptyValue": '""', "header": header}
