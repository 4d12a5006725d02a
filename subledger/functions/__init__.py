"""Column expressions. All are built-in Spark functions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger import fixed_values as fixed

_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$"


# ---- dates -----------------------------------------------------------------------------------

def parse_event_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` or ``yyyy-MM-dd``; anything else, fractional seconds included, is null."""
    return F.when(text.rlike(_TIME_SHAPE), text.try_cast("timestamp_ntz"))


def month_of(moment: Column) -> Column:
    """``yyyy-MM`` of a date or a zone-less timestamp, independent of the session's time zone."""
    return F.substring(F.to_date(moment).cast("string"), 1, 7)


def parse_day(text: Column) -> Column:
    """A ``yyyy-MM-dd`` text as a date, null where it is not one."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def days_between(start: Column, end: Column) -> Column:
    """Day boundaries crossed from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


# ---- numbers ---------------------------------------------------------------------------------

def round_half_up(value: Column, places: int) -> Column:
    """Half-away rounding of the decimal value, not of its binary neighbour."""
    return F.round(value.cast("decimal(28,6)"), places).cast("double")


def whole_number(text: Column) -> Column:
    """Numeric text truncated toward zero; null where it is not numeric."""
    return text.try_cast("double").try_cast("bigint")


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def percent_of(part: Column, total: Column) -> Column:
    return round_half_up(part.cast("double") * 100.0 / total, 2)


# ---- text ------------------------------------------------------------------------------------

def blank_to_null(text: Column, tokens: Iterable[str] = fixed.NULL_TOKENS) -> Column:
    return F.when(~text.isin(list(tokens)), text)


def tagged_value(text: Column, key: str, separator: str = ";") -> Column:
    """The value after ``key=`` up to the separator; an empty text where the key is absent."""
    return F.split_part(F.split_part(text, F.lit(f"{key}="), F.lit(2)), F.lit(separator), F.lit(1))


def with_country_code(phone: Column, code: str = fixed.COUNTRY_CODE) -> Column:
    return F.when(phone.startswith(code), phone).otherwise(F.concat(F.lit(code), phone))


def keyword_hit(name: Column, keywords: Iterable[str] = fixed.EXCLUDED_SERVICE_KEYWORDS) -> Column:
    """Does the name contain any keyword, case ignored?"""
    low = F.lower(name)
    hit = F.lit(False)
    for word in keywords:
        hit = hit | low.contains(word.lower())
    return hit


def grouped_category(name: Column, groups: Mapping[str, str] = fixed.CATEGORY_GROUPS) -> Column:
    """Merged category name; a category outside the groups keeps its own trimmed name."""
    trimmed = F.trim(name)
    return F.coalesce(lookup(F.lower(trimmed), groups), trimmed)


def lookup(key: Column, table: Mapping) -> Column:
    """Value of a small literal map, null where the key is absent."""
    if not table:
        return F.lit(None)
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


# ---- lists -----------------------------------------------------------------------------------

def list_text(values: Column, separator: str = ",") -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), separator)


def list_has_any(values: Column, codes: Iterable[int]) -> Column:
    """True where the list shares an element with the codes; false for null lists and null elements."""
    wanted = F.array(*[F.lit(int(c)).cast("bigint") for c in codes]) if codes else F.array().cast("array<bigint>")
    return F.coalesce(F.arrays_overlap(values, wanted), F.lit(False))


# ---- ordering --------------------------------------------------------------------------------
# A struct compares field by field and puts nulls first, so each key carries a flag that sends a
# missing date last in both directions.

def earliest(moment: Column, tie: Column, *payload: Column) -> Column:
    """Struct whose minimum is the earliest row; undated rows lose."""
    return F.struct(moment.isNull().alias("undated"), moment.alias("at"), tie.alias("tie"), *payload)


def latest(moment: Column, tie: Column, *payload: Column) -> Column:
    """Struct whose maximum is the latest row; undated rows lose."""
    return F.struct(moment.isNotNull().alias("dated"), moment.alias("at"), tie.alias("tie"), *payload)
