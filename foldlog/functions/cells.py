"""Cells of CSV files and of worksheets exported to CSV."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that a CSV reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Cell texts that a CSV reader takes for a truth value.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

INTEGER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"
_DECIMAL = r"^\s*(?:\+|(-))?0*(\d*)\.(\d*?)0*\s*$"


def null_if_token(cell: Column) -> Column:
    """NULL for the texts that mean a missing value."""
    return F.when(~cell.isin(*NULL_TOKENS), cell)


def sheet_value_text(cell: Column) -> Column:
    """Text of a worksheet cell after number recognition: ``007`` is 7, ``1.50`` is 1.5.

    A missing cell is ``''``. Numbers with an exponent are left as they are written.
    """
    text = F.coalesce(cell, F.lit(""))
    whole = F.regexp_replace(text, r"^\s*(?:\+|(-))?0*(\d+)\s*$", "$1$2")
    sign, units, tenths = (F.regexp_extract(text, _DECIMAL, group) for group in (1, 2, 3))
    or_zero = lambda digits: F.when(digits == "", F.lit("0")).otherwise(digits)
    decimal = F.concat(sign, or_zero(units), F.lit("."), or_zero(tenths))
    return (
        F.when(text.rlike(INTEGER), F.when(whole == "-0", F.lit("0")).otherwise(whole))
        .when(text.rlike(r"^\s*[+-]?(?:\d+\.\d*|\.\d+)\s*$"), decimal)
        .otherwise(text)
    )
