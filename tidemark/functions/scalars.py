"""Text, missing-value and number helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.servicetypes import parse_whole


def lower_text(text: Column) -> Column:
    return F.lower(text)


def joined_text(*parts: Column, sep: str = "_") -> Column:
    """Parts joined by ``sep``; a missing part prints as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def contains_pattern(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def to_text(value: Column) -> Column:
    return value.cast("string")


def to_whole_number(text: Column) -> Column:
    """Whole number in the text, null when there is none."""
    return parse_whole(text)


def either(condition: Column, yes: Column, no: Column) -> Column:
    """``yes`` or ``no``; a missing condition gives a missing result."""
    return F.when(condition, yes).when(~condition, no)


def is_missing(value: Column) -> Column:
    return value.isNull()


def is_present_text(text: Column) -> Column:
    """Neither missing nor empty."""
    return text.isNotNull() & (text != "")


def part_rows(rows: Column, kilobytes: Column, target_kb: float = 30000.0) -> Column:
    """Rows that fit in one upload part of ``target_kb`` kilobytes."""
    scaled = F.floor(rows * F.lit(float(target_kb)) / kilobytes).cast("bigint")
    return F.when(kilobytes > target_kb, scaled).otherwise(rows)
