"""Column-level building blocks."""

from custofold.functions.text import (
    NOT_AVAILABLE,
    blank_default,
    blank_to,
    clean,
    code_concat,
    full_name,
    has_value,
    null_fallback,
    typed_null,
    value_if,
    xml_text,
)
from custofold.functions.time import default_today, newest, parse_ts

__all__ = [
    "NOT_AVAILABLE",
    "blank_default",
    "blank_to",
    "clean",
    "code_concat",
    "default_today",
    "full_name",
    "has_value",
    "newest",
    "null_fallback",
    "parse_ts",
    "typed_null",
    "value_if",
    "xml_text",
]
