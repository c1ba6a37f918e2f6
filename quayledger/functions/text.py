"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_company(name: Column) -> Column:
    """Company name without a closing S.A., S.A or SA."""
    return F.regexp_replace(name, r" (S\.A\.|S\.A|SA)$", "")


def cold_store_destination(customer: Column) -> Column:
    """Destination text of a cold-store unloading for a customer."""
    return F.concat(F.lit("CCCS ("), short_company(customer), F.lit(")"))


def species_name(text: Column) -> Column:
    """Text before the first spaced dash; null when there is none."""
    return F.when(text.rlike(r"\s-\s"), F.regexp_extract(text, r"^(.*?)(\s-\s)", 1))


def remark_detail(remarks: Column) -> Column:
    """The part of a remark after its first slash, or after the second when that part starts with OT."""
    parts = F.split(remarks, "/ ", 2)
    detail = F.get(parts, F.lit(1))
    after_overtime = F.get(F.split(detail, " / ", 2), F.lit(1))
    return F.trim(F.when(detail.startswith("OT"), after_overtime).otherwise(detail))
