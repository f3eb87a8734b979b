"""Column expressions shared by the operators. All run inside the JVM."""

from .payload import (
    not_an_object,
    parse,
    rescued_document,
    to_payload,
    typed_document,
    with_document,
    with_rescued,
)
from .timecut import as_of_column, at_or_before, iso_utc, seconds_of, slot, within

__all__ = [
    "as_of_column",
    "at_or_before",
    "iso_utc",
    "not_an_object",
    "parse",
    "rescued_document",
    "seconds_of",
    "slot",
    "to_payload",
    "typed_document",
    "with_document",
    "with_rescued",
    "within",
]
