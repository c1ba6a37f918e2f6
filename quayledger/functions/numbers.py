"""Casts for numbers typed by hand: blanks, thousands commas, stray minus signs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import TONNES


def _filled(text: Column) -> Column:
    return F.nullif(F.trim(text.cast("string")), F.lit(""))


def to_tonnes(text: Column) -> Column:
    """Tonnes from a cell that may be blank or unreadable; those count as 0."""
    return F.coalesce(_filled(text).try_cast(TONNES), F.lit(0).cast(TONNES))


def kilos_to_tonnes(text: Column) -> Column:
    """Tonnes from a kilogram reading with thousands commas."""
    kilos = F.replace(text, F.lit(","), F.lit("")).cast("bigint")
    return (kilos.cast("decimal(15,0)") * F.lit("0.001").cast("decimal(3,3)")).cast(TONNES)


def to_count(text: Column) -> Column:
    """A whole number, blank as 0."""
    return F.coalesce(_filled(text).cast("bigint"), F.lit(0).cast("bigint"))


def outgoing_count(text: Column) -> Column:
    """A whole number written with or without minus signs, always counted as negative."""
    return to_count(F.btrim(text.cast("string"), F.lit("-"))) * F.lit(-1)


#: How each kind of hand-typed number is cleaned before it is read, and the type it is read as.
_READERS = {
    "tonnes": (_filled, TONNES),
    "kilos": (lambda text: F.replace(text, F.lit(","), F.lit("")), "bigint"),
    "count": (_filled, "bigint"),
    "outgoing": (lambda text: _filled(F.btrim(text.cast("string"), F.lit("-"))), "bigint"),
}
KINDS = tuple(_READERS)


def unreadable(text: Column, kind: str) -> Column:
    """Whether a cell holds something that is no number of its kind. Blank and null cells hold nothing."""
    clean, read_as = _READERS[kind]
    return _filled(text).isNotNull() & clean(text).try_cast(read_as).isNull()
