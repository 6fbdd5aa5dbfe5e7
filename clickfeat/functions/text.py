"""Text to typed values and back. Bad text raises; blank text is missing (NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters up to the space, which trimming removes.
_BLANKS = "".join(chr(code) for code in range(33))
_HEX = "^[+-]?0*[0-7]?[0-9a-fA-F]{1,15}$"
_INTEGER = "^[+-]?[0-9]+$"


def has_controls(text: Column) -> Column:
    return text.rlike("[\\x00-\\x1f]")


def trim_blanks(text: Column, controls: Column) -> Column:
    """Trim spaces, and control characters too where the text may hold any (the slower way)."""
    return F.when(controls, F.btrim(text, F.lit(_BLANKS))).otherwise(F.trim(text))


def _strict(text: Column, parsed: Column, kind: str) -> Column:
    complaint = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text))
    return F.when(text != "", F.coalesce(parsed, complaint))


def to_double(text: Column) -> Column:
    """Decimal text as double. ``NaN`` text is missing too."""
    value = _strict(text, text.try_cast("double"), "number")
    return F.when(~F.isnan(value), value)


def to_integer(text: Column, type: str = "bigint") -> Column:
    return _strict(text, F.when(text.rlike(_INTEGER), text.try_cast(type)), type)


def hex_to_long(text: Column) -> Column:
    """Base-16 text, with an optional sign, as a signed 64-bit integer."""
    signed = text.startswith("-") | text.startswith("+")
    digits = F.when(signed, text.substr(F.lit(2), F.length(text))).otherwise(text)
    # Validated text only: conv() would accept a bad tail silently.
    magnitude = F.when(text.rlike(_HEX), F.conv(digits, 16, 10)).try_cast("bigint")
    return _strict(text, F.when(text.startswith("-"), -magnitude).otherwise(magnitude), "hex number")


def long_to_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def cell_text(value: Column, missing: str = "null") -> Column:
    return F.coalesce(value.cast("string"), F.lit(missing))
