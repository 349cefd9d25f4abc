"""Epochs, timestamps and dates as text. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats of the report.
DAY_FIRST = "dd/MM/yyyy HH:mm:ss"
ISO_DATE = "yyyy-MM-dd"
# Epoch seconds of the first moment of year 1 and of year 10000.
_FIRST, _END = -62135596800, 253402300800


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds, as number or text, to a timestamp.

    Text that is no number and seconds outside the years 1 to 9999 give NULL.
    """
    number = seconds.try_cast("decimal(20,6)")
    return F.timestamp_seconds(F.when((number >= _FIRST) & (number < _END), number))


def epoch_to_text(seconds: Column) -> Column:
    """Epoch seconds to day-first text."""
    return F.date_format(epoch_to_timestamp(seconds), DAY_FIRST)


def local_time_to_text(moment: Column) -> Column:
    """ISO text without offset; six fraction digits, or none when zero."""
    whole = F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(moment, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)))


def timestamp_to_text(moment: Column) -> Column:
    """UTC timestamp to ISO text with offset; six fraction digits, or none when zero."""
    return F.concat(local_time_to_text(moment), F.lit("+00:00"))


def date_to_text(day: Column) -> Column:
    return F.date_format(day, ISO_DATE)
