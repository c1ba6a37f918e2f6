"""Table-wide quality checks: container numbers, row rules and name lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTAINER_PATTERN = "^[A-Z]{4}[0-9]{7}$"


def _letter_value(letter: Column) -> Column:
    """10 for A, counting up and skipping the multiples of 11."""
    index = F.ascii(letter) - 65
    return index + 10 + F.floor((index + 9) / 10).cast("int")


def check_digit(code: Column) -> Column:
    """Check digit that the first ten characters of a container number call for."""
    total = F.lit(0)
    for i in range(10):
        character = F.substring(code, i + 1, 1)
        value = _letter_value(character) if i < 4 else F.ascii(character) - 48
        total = total + value * (2**i)
    return total % 11 % 10


def container_status(number: Column) -> Column:
    """'ok', or the first rule a container number breaks: 'length', 'format' or 'check digit'."""
    code = F.trim(number)
    return (
        F.when(F.coalesce(F.length(code), F.lit(0)) != 11, "length")
        .when(~code.rlike(CONTAINER_PATTERN), "format")
        .when(check_digit(code) != F.ascii(F.substring(code, 11, 1)) - 48, "check digit")
        .otherwise("ok")
    )


def container_report(df: DataFrame, number: str) -> DataFrame:
    """Rows and distinct numbers per container status."""
    return (
        df.groupBy(F.trim(number).alias("_code"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(container_status(F.col("_code")).alias("status"))
        .agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("numbers"))
    )


def with_errors(df: DataFrame, rules: dict[str, Column], name: str = "errors") -> DataFrame:
    """Add the names of the rules that a row breaks; a rule that is null counts as broken."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(n)) for n, rule in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with their errors."""
    checked = with_errors(df, rules)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def stated_sums(df: DataFrame, keys: Sequence[str], measures: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Sums that say what they leave out: per measure, a pair of its number and whether the cell is unreadable, the sum of the
    readable ones and the count of the others as ``<name>_left_out``."""
    sums = [F.sum(F.when(~bad, number)).alias(name) for name, (number, bad) in measures.items()]
    left_out = [F.count_if(bad).alias(f"{name}_left_out") for name, (_, bad) in measures.items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *sums, *left_out)


def not_blank(text: Column) -> Column:
    """Rule: text that is not empty or all blanks."""
    return F.length(F.trim(text)) > 0


def canonical_name(text: Column, names: Sequence[str]) -> Column:
    """Listed spelling of a name that may differ in case and outer blanks; null if not listed."""
    trimmed = F.trim(text)
    chain = F.when(trimmed.isin(list(names)), trimmed)
    for name in names:
        chain = chain.when(F.lower(trimmed) == name.lower(), F.lit(name))
    return chain


def require_name(text: Column, names: Sequence[str]) -> Column:
    """The value itself; the query fails on a value that is not listed. Null passes."""
    message = F.concat(F.lit("not a listed name: "), text)
    return F.when(text.isNull() | text.isin(list(names)), text).otherwise(F.raise_error(message))


def split_listed(
    df: DataFrame, column: str, listed: DataFrame, listed_column: str
) -> tuple[DataFrame, DataFrame]:
    """Rows whose value appears in a reference table, and the rows to quarantine."""
    known = listed.select(F.col(listed_column).alias("_known")).distinct()
    same = F.col(column) == F.col("_known")
    return df.join(known, same, "left_semi"), df.join(known, same, "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
