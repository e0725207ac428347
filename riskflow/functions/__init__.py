"""Column expressions shared by the operators (all JVM-side built-ins)."""

from riskflow.functions.columns import (
    JSON_WRITE_OPTIONS,
    WIRE_TS_FORMAT,
    alert_text,
    as_utc_instant,
    flatten_window,
    schema_fingerprint,
    utc_wall_clock,
    wire_timestamp_text,
)

__all__ = [
    "JSON_WRITE_OPTIONS",
    "WIRE_TS_FORMAT",
    "alert_text",
    "as_utc_instant",
    "flatten_window",
    "schema_fingerprint",
    "utc_wall_clock",
    "wire_timestamp_text",
]
