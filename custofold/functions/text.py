"""Column expressions for cleaning text. All are built-in Spark functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "Not Available"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_default(c: Column | str) -> Column:
    """NULL becomes the empty string; the value is text from here on."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def clean(c: Column | str) -> Column:
    """Spaces removed at both ends."""
    return F.trim(_col(c))


def has_value(c: Column | str) -> Column:
    """True when the text is neither NULL nor blank (never NULL itself)."""
    return _col(c).isNotNull() & (F.trim(_col(c)) != "")


def blank_to(c: Column | str, default: str = NOT_AVAILABLE) -> Column:
    """NULL or blank text becomes ``default``; any other value is kept as it is, untrimmed."""
    return F.when(has_value(c), _col(c)).otherwise(F.lit(default))


def code_concat(*parts: Column | str) -> Column:
    """Codes joined without a separator; NULL as soon as one part is NULL."""
    return F.concat(*[_col(p) for p in parts])


def full_name(*parts: Column | str) -> Column:
    """Display name: trimmed parts with one space between each, blank middle parts leaving their space."""
    return F.trim(F.concat_ws(" ", *[F.trim(blank_default(p)) for p in parts]))


def value_if(condition: Column, value: Column | str) -> Column:
    """The trimmed value where the condition holds, else NULL."""
    return F.when(condition, clean(value))


def null_fallback(first: Column | str, second: Column | str) -> Column:
    """The first value, or the second where the first is NULL."""
    return F.coalesce(_col(first), _col(second))


def typed_null(dtype: str = "string") -> Column:
    """A NULL column of a real type; an untyped NULL cannot be written to most stores."""
    return F.lit(None).cast(dtype)


def xml_text(c: Column | str) -> Column:
    """Text escaped for an XML element; NULL becomes the empty string."""
    escaped = blank_default(c)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(entity))
    return escaped
