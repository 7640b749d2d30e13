"""Wire value -> typed column. Every decoder yields NULL, never an error, on a value it cannot read."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.spec import Col

# The wire forms a column may declare.
WIRE_FORMS = (
    "string",
    "int",
    "bool",
    "decimal",
    "connect_decimal",
    "json",
    "bytes",
    "array",
    "micro_timestamp",
    "zoned_timestamp",
    "micro_time",
    "zoned_time",
    "date",
)

_EPOCH_DAY = "1970-01-01"


def decimal_from_text(text: Column, type_: str) -> Column:
    """The number exactly as written; NULL where the type would have to round it or cannot hold it.

    Trailing zeros are no surplus digits. A number with an exponent is compared with a wider one.
    """
    found = re.search(r",\s*([0-9]+)", type_)
    scale = int(found.group(1)) if found else 0
    kept = text.try_cast(type_)
    surplus = F.length(F.regexp_extract(text, r"[.]([0-9]*?)0*\s*$", 1)) > scale
    wider = text.try_cast(f"decimal(38,{min(38, scale + 10)})")
    return F.when(F.regexp_like(text, F.lit("[eE]")), F.when(kept == wider, kept)).when(~surplus, kept)


def decimal_from_bytes(encoded: Column, type_: str, scale: int = 0) -> Column:
    """Two's-complement big-endian bytes in base64, as an exact decimal (up to 16 bytes).

    The digits are sign-extended to 32 hex characters and summed from four 32-bit words, so the
    work stays in generated JVM code for any width a Spark decimal can hold. Negative values are
    summed from their inverted words, which keeps every intermediate within 38 digits.
    """
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    negative = F.substring(digits, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F")
    wide = F.lpad(digits, 32, F.when(negative, F.lit("F")).otherwise(F.lit("0")))
    base = F.lit(2**32).cast("decimal(10,0)")

    def word(index: int) -> Column:
        plain = F.conv(F.substring(wide, 1 + 8 * index, 8), 16, 10).cast("decimal(38,0)")
        return F.when(negative, F.lit(2**32 - 1).cast("decimal(38,0)") - plain).otherwise(plain)

    total = word(0).cast("decimal(38,0)")
    for index in (1, 2, 3):
        total = F.try_add(F.try_multiply(total, base), word(index)).cast("decimal(38,0)")
    total = F.when(negative, F.try_subtract(F.lit(-1).cast("decimal(1,0)"), total)).otherwise(total).cast("decimal(38,0)")
    usable = (F.length(digits) > 0) & (F.length(digits) <= 32)
    return F.when(usable, _rescale(total, scale).try_cast(type_))


def _rescale(total: Column, scale: int) -> Column:
    """Move the decimal point in text: decimal division would round wide values."""
    if not scale:
        return total
    text = F.regexp_replace(total.cast("string"), "^-", "")
    padded = F.lpad(text, scale + 1, F.lit("0"))
    padded = F.when(F.length(text) > scale, text).otherwise(padded)
    cut = F.length(padded) - F.lit(scale)
    sign = F.when(total < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.substring(padded, F.lit(1), cut), F.lit("."), F.substring(padded, cut + 1, F.lit(scale)))


def bytes_from_text(text: Column) -> Column:
    return F.try_to_binary(text, F.lit("base64"))


def timestamp_from_micros(text: Column) -> Column:
    """Zone-less timestamp from epoch microseconds (session zone must be UTC)."""
    return F.timestamp_micros(text.try_cast("bigint")).cast("timestamp_ntz")


def timestamp_from_zoned(text: Column) -> Column:
    return text.try_cast("timestamp")


def micros_of_day(text: Column) -> Column:
    return text.try_cast("bigint")


def format_micros_of_day(micros: Column) -> Column:
    """``HH:mm:ss.ffffff`` from microseconds of the day."""
    return F.date_format(F.timestamp_micros(micros), "HH:mm:ss.SSSSSS")


def time_from_zoned(text: Column) -> Column:
    """An offset time of day, normalised to UTC text."""
    moment = F.concat(F.lit(_EPOCH_DAY + "T"), text).try_cast("timestamp")
    return F.concat(F.date_format(moment, "HH:mm:ss.SSSSSS"), F.lit("Z"))


def date_from_days(text: Column) -> Column:
    return F.date_from_unix_date(text.try_cast("int"))


def decode_column(value: Column, col: Col) -> Column:
    """Decode one text value the way ``col`` declares it."""
    if col.wire == "decimal":
        return decimal_from_text(value, col.type)
    if col.wire == "connect_decimal":
        return decimal_from_bytes(value, col.type, col.scale)
    if col.wire == "bytes":
        return bytes_from_text(value)
    if col.wire == "micro_timestamp":
        return timestamp_from_micros(value)
    if col.wire == "zoned_timestamp":
        return timestamp_from_zoned(value)
    if col.wire == "micro_time":
        return micros_of_day(value)
    if col.wire == "zoned_time":
        return time_from_zoned(value)
    if col.wire == "date":
        return date_from_days(value)
    if col.wire in ("string", "json"):
        return value
    if col.wire in ("int", "bool"):
        return value.try_cast(col.type)
    if col.wire == "array":
        return F.from_json(value, col.type)
    raise ValueError(f"unknown wire form {col.wire!r}, known are {', '.join(WIRE_FORMS)}")
