"""Column functions (built-in expressions only; no Python UDFs)."""

from .scalars import (
    blank_to_null,
    extra_json,
    hidden,
    json_valid,
    parse_ts,
    pixel_bound,
    resolve_site,
    to_int_key,
)

__all__ = [
    "blank_to_null",
    "extra_json",
    "hidden",
    "json_valid",
    "parse_ts",
    "pixel_bound",
    "resolve_site",
    "to_int_key",
]
