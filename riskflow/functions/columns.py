"""Column expressions: time-zone-exact conversions, wire formats, alert text.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen; nothing crosses into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamps on the wire: ISO-8601 UTC with microseconds, e.g.
# 2024-01-01T00:00:07.179575Z. Parsed back by from_json's default parser.
WIRE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# to_json options that keep microseconds (the defaults cut to milliseconds).
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Alert line of the per-batch alert sink (fixed text).
ALERT_PREFIX = "[ALERT] High-risk transaction detected: "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_utc_instant(ntz) -> Column:
    """TIMESTAMP_NTZ read as a UTC wall clock -> TIMESTAMP (an instant).

    Independent of the session time zone: the wall clock is first moved from
    UTC into the session zone, then cast (the cast reads it in that zone).
    """
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(ntz)).cast("timestamp")


def utc_wall_clock(ltz) -> Column:
    """TIMESTAMP (instant) -> TIMESTAMP_NTZ holding its UTC wall clock."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _col(ltz).cast("timestamp_ntz"))


def utc_wall_clock_of(df, col_name: str) -> Column:
    """UTC wall clock of a column of ``df``: TIMESTAMP (an instant) is
    converted, TIMESTAMP_NTZ is taken as a UTC wall clock already."""
    if df.schema[col_name].dataType.typeName() == "timestamp_ntz":
        return F.col(col_name)
    return utc_wall_clock(F.col(col_name))


def wire_timestamp_text(ntz_utc) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) -> wire text with a literal ``Z``."""
    return F.date_format(_col(ntz_utc), WIRE_TS_FORMAT)


def flatten_window(df, window_col: str = "window", utc: bool = False):
    """Replace a ``window`` struct by ``window_start``/``window_end`` columns.

    With ``utc=True`` instants are turned into UTC wall clocks (TIMESTAMP_NTZ),
    which is how batch results on the driver tables are compared.
    """
    start = F.col(f"{window_col}.start")
    end = F.col(f"{window_col}.end")
    if utc:
        start, end = utc_wall_clock(start), utc_wall_clock(end)
    others = [c for c in df.columns if c != window_col]
    return df.select(start.alias("window_start"), end.alias("window_end"), *others)


def alert_text(user_col="user_id", count_col="tx_count", amount_col="total_amount") -> Column:
    """``[ALERT] High-risk transaction detected: User=.. | Count=.. | Amount=..``.

    A NULL field prints as ``None``, as a Python f-string would.
    """
    def txt(c):
        return F.coalesce(_col(c).cast("string"), F.lit("None"))

    return F.concat(
        F.lit(ALERT_PREFIX),
        F.lit("User="), txt(user_col),
        F.lit(" | Count="), txt(count_col),
        F.lit(" | Amount="), txt(amount_col),
    )


def schema_fingerprint(path_col="field_path", definition_col="field_definition") -> Column:
    """Aggregate expression: SHA-256 over the sorted pairs of path and leaf
    definition, each written as a JSON array of two strings.

    Independent of field order; an empty group hashes the empty string.
    """
    pair = F.to_json(F.array(_col(path_col), F.coalesce(_col(definition_col), F.lit(""))))
    return F.sha2(F.array_join(F.sort_array(F.collect_list(pair)), "\n"), 256)
