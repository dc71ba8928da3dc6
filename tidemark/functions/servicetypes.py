"""The five column types of a dataset, and text parsing for each of them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The service's column type names and the Spark type of each.
SPARK_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "LONG": T.LongType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
}

# How dates and times are spelled in uploaded text.
DATETIME_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?\s*$"
DATE_TEXT = r"^\s*\d{4}[-/]\d{1,2}[-/]\d{1,2}\s*$"
SERVICE_DATETIME = r"^\s*(\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2})"
SERVICE_DATE = r"^\s*(\d{4}-\d{1,2}-\d{1,2})"
ANY_DATETIME = r"^\s*(\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6})?)"
ANY_DATE = r"^\s*(\d{4}[-/]\d{1,2}[-/]\d{1,2})"
OFFSET_PARTS = r"([+-])(\d{2}):?(\d{2})\s*$"
# A number written with zeros in front is a code, not a number.
PADDED_NUMBER = r"^\s*[+-]?0\d"
# Digits of a whole number that a DOUBLE may not hold exactly.
LONG_WHOLE = r"^\s*[+-]?\d{16,}\s*$"
LONG_TEXT = r"^\s*[+-]?\d{1,19}\s*$"
DOUBLE_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,5})?\s*$|^\s*[+-]?(?i:nan|inf|infinity)\s*$"
USER_TIME = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)\d*Z"


def service_type(data_type: T.DataType) -> str:
    """Service type of a Spark type; whatever has none is text."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "LONG"
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "DOUBLE"
    if isinstance(data_type, T.DateType):
        return "DATE"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "DATETIME"
    return "STRING"


def looks_like_datetime(text: Column) -> Column:
    return text.rlike(DATETIME_TEXT) & parse_datetime(text, any_format=True).isNotNull()


def looks_like_long(text: Column) -> Column:
    """A whole number of 64 bits, written without zeros in front."""
    return parse_whole(text).isNotNull() & ~text.rlike(PADDED_NUMBER)


def looks_like_double(text: Column) -> Column:
    """A number that a DOUBLE gives back: not one with zeros in front, nor a long whole number."""
    return parse_double(text).isNotNull() & ~text.rlike(PADDED_NUMBER) & ~text.rlike(LONG_WHOLE)


def looks_like_date(text: Column) -> Column:
    return text.rlike(DATE_TEXT) & parse_date(text, any_format=True).isNotNull()


def parse_datetime(text: Column, any_format: bool = False) -> Column:
    """Zone-less time at the start of the text, or null.

    The service writes ``2024-01-05T10:00:00``; ``any_format`` also takes a
    space for the ``T``, keeps a fraction, and turns a time with an offset into that of UTC.
    """
    found = F.regexp_extract(text, ANY_DATETIME if any_format else SERVICE_DATETIME, 1)
    clock = found.try_cast(T.TimestampNTZType())
    if not any_format:
        return clock
    sign, hours, minutes = (F.regexp_extract(text, OFFSET_PARTS, i) for i in (1, 2, 3))
    ahead = F.make_dt_interval(hours=hours.try_cast("int"), mins=minutes.try_cast("int"))
    timed = text.rlike(r"\d:\d{1,2}:\d")
    return F.when(timed & (sign == "+"), clock - ahead).when(timed & (sign == "-"), clock + ahead).otherwise(clock)


def parse_date(text: Column, any_format: bool = False) -> Column:
    """Date at the start of the text, or null; ``any_format`` also takes slashes."""
    found = F.regexp_extract(text, ANY_DATE if any_format else SERVICE_DATE, 1)
    return F.translate(found, "/", "-").try_cast(T.DateType())


def parse_double(text: Column) -> Column:
    """Number, or null. The pattern comes first because a failed cast is slow."""
    return F.when(text.rlike(DOUBLE_TEXT), text.try_cast("double"))


def parse_whole(text: Column) -> Column:
    """64-bit integer written without a fraction, or null."""
    return F.when(text.rlike(LONG_TEXT), text.try_cast("bigint"))


def parse_long(text: Column) -> Column:
    """64-bit integer; a fraction is cut off, other text gives null."""
    return F.coalesce(parse_whole(text), parse_double(text).try_cast("bigint"))


def parse_as(text: Column, kind: str, any_format: bool = False) -> Column:
    """Text read as one of the service types; unreadable values become null."""
    if kind == "DOUBLE":
        return parse_double(text)
    if kind == "LONG":
        return parse_long(text)
    if kind == "DATE":
        return parse_date(text, any_format)
    if kind == "DATETIME":
        return parse_datetime(text, any_format)
    return text


def parse_user_time(text: Column) -> Column:
    """UTC clock time of ``2024-01-05T10:00:00Z``, with or without a fraction.

    The result has no zone, so it does not move with the session's.
    """
    return F.regexp_extract(text, USER_TIME, 1).try_cast(T.TimestampNTZType())
