"""Scalar column functions.

All of them are compositions of Spark built-ins, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp text that is not ISO-8601, by the shape it has and the
# formats that can read that shape, tried in order.  Month before day; day first
# where the month is impossible.
TIMESTAMP_SHAPES = (
    (r"^[0-9]{4}/", ("yyyy/M/d[ H:m[:s]]",)),
    (r"(?i)^[0-9]{4}-.*[ap]m$", ("yyyy-M-d h:m[:s] a",)),
    (r"(?i)^(0?[0-9]|1[0-2])/.*[ap]m$", ("M/d/yyyy h:m[:s] a",)),
    (r"(?i)^[0-9]+/.*[ap]m$", ("d/M/yyyy h:m[:s] a",)),
    (r"^(0?[0-9]|1[0-2])/", ("M/d/yyyy[ H:m[:s]]",)),
    (r"^[0-9]+/", ("d/M/yyyy[ H:m[:s]]",)),
    (r"(?i)^[a-z]{3} .*[ap]m$", ("MMM d[,] yyyy h[:m[:s]][ ]a", "MMM d[,] yyyy ha")),
    (r"(?i)^[a-z]{4,} .*[ap]m$", ("MMMM d[,] yyyy h[:m[:s]][ ]a",)),
    (r"(?i)^[a-z]{3} ", ("MMM d[,] yyyy[ H:m[:s]]",)),
    (r"(?i)^[a-z]{4,} ", ("MMMM d[,] yyyy[ H:m[:s]]",)),
    (r"(?i)^[0-9]+ [a-z]{3} .*[+-][0-9]+$", ("d MMM yyyy H:m:s Z",)),
    (r"(?i)^[0-9]+ [a-z]{3} ", ("d MMM yyyy[ H:m[:s][ z]]",)),
    (r"(?i)^[0-9]+ [a-z]{4,} ", ("d MMMM yyyy[ H:m[:s][ z]]",)),
    (r"^[0-9]{8}T", ("yyyyMMdd'T'HHmmss[X]",)),
    (r"^[0-9]{14}$", ("yyyyMMddHHmmss",)),
    (r"^[0-9]{8}$", ("yyyyMMdd",)),
)

# Fixed value: the start of ISO-8601 text, read by Spark's own cast (zones and
# fractions allowed).  A bare time is no timestamp: it would need today's date.
ISO_START = r"^[+-]?[0-9]{4,6}(-|$)"

# Fixed value: a weekday name before the date says nothing.
WEEKDAY = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+"

# Fixed value: non-finite numbers that the exports' JSON may hold.
NON_FINITE = r"(^|[\[:,\s])(NaN|-?Infinity)(?=\s*([,\]}]|$))"

# Fixed value: the predicted label that hides a timeseries or an image.
HIDDEN_LABEL = "nothing"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resolve_site(raw: Column | str) -> Column:
    """Site id from a camera id text.

    Surrounding whitespace is removed; an all-digit value is the id; else the
    part before the first ``_`` is the id when it is all digits; else NULL.
    ASCII digits and whitespace only; values beyond 64 bits give NULL.
    """
    trimmed = F.regexp_replace(_col(raw).cast("string"), r"^\s+|\s+$", "")
    digits = F.regexp_extract(trimmed, r"^([0-9]+)(_|$)", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def to_int_key(raw: Column | str) -> Column:
    """Integer form of an id text, NULL when it is not an integer of 64 bits."""
    return _col(raw).try_cast("bigint")


def blank_to_null(c: Column | str) -> Column:
    """Empty text counts as missing."""
    return F.nullif(_col(c), F.lit(""))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# One expression text, since callers use it many times: the formats of a text's shape.
_SHAPED = "t -> CASE " + " ".join(
    f"WHEN t RLIKE {_quoted(shape)} THEN coalesce({', '.join(f'try_to_timestamp(t, {_quoted(f)})' for f in formats)})"
    for shape, formats in TIMESTAMP_SHAPES
) + " END"


def parse_ts(c: Column | str) -> Column:
    """Free-form timestamp text to a UTC ``timestamp_ntz``.

    ISO-8601 first, then the formats of the text's shape; NULL when none reads
    the text, so callers can flag it.  Unzoned text is taken as UTC (session
    time zone); nothing depends on the clock.
    """
    col = F.trim(_col(c).cast("string"))

    # The rare shapes are evaluated as a lambda: sixteen parsers inlined in the
    # generated code of every caller would make it too long to be compiled.
    rare = F.element_at(F.call_function("transform", F.array(F.regexp_replace(col, WEEKDAY, "")), F.expr(_SHAPED)), 1)
    iso = F.when(col.rlike(ISO_START), F.try_to_timestamp(col))
    return F.coalesce(iso, rare).cast("timestamp_ntz")


def optional_ts(c: Column | str) -> tuple[Column, Column]:
    """(value, error) for a timestamp that may be blank: blank is NULL, junk is an error."""
    text = blank_to_null(c)
    parsed = parse_ts(text)
    return parsed, text.isNotNull() & parsed.isNull()


def hidden(label: Column | str) -> Column:
    """NULL-safe ``label == 'nothing'`` (F8): NULL gives false."""
    return _col(label).eqNullSafe(F.lit(HIDDEN_LABEL))


def json_valid(text: Column | str) -> Column:
    """True when the text parses as JSON (X7); NULL text is not valid.

    ``NaN`` and infinities count as numbers and a repeated key is allowed
    (the session setting that ``configure`` makes); trailing commas, single
    quotes and comments are errors.
    """
    return F.try_parse_json(F.regexp_replace(_col(text), NON_FINITE, "$1 0")).isNotNull()


def extra_json(*cols: str) -> Column:
    """JSON object from columns, keys kept for NULL values."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def pixel_bound(fraction: Column | str, size: Column | str) -> Column:
    """Normalised coordinate times image size, rounded half to even."""
    return F.bround(_col(fraction) * _col(size).cast("double")).cast("int")
