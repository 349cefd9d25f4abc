"""Cell texts against Python's own number and missing-value rules."""

import pandas as pd
import pytest
from pandas._libs.parsers import STR_NA_VALUES
from pyspark.sql import functions as F

from foldlog.functions import cells, messages, times

PLAIN = [
    "7", "007", " 7 ", "+7", "-7", "-007", "0", "-0", "000", "123456789012345678901234567890",
    "1.5", "01.50", "1.0", "10.00", ".5", "-.5", "5.", "+2.50", "-0.0", "0.10", "1234567.25", " 3.0 ",
    "", "x", "1R-0750", "1_000", "12a", "1.2.3", "-", ".", "1,5", "05/01/2024", "2024-01-05",
]


def as_python(cell):
    """What number recognition makes of a cell, as text."""
    if "_" in cell:
        return cell
    for number in (int, float):
        try:
            return str(number(cell))
        except ValueError:
            pass
    return cell


def test_sheet_values_follow_python_numbers(spark):
    frame = spark.createDataFrame([(cell,) for cell in PLAIN], "cell string")
    texts = frame.select("cell", cells.sheet_value_text(F.col("cell")).alias("text")).collect()
    assert {row.cell: row.text for row in texts} == {cell: as_python(cell) for cell in PLAIN}


def test_missing_sheet_cell_is_empty(spark):
    frame = spark.createDataFrame([(None,)], "cell string")
    assert frame.select(cells.sheet_value_text(F.col("cell"))).first()[0] == ""


def test_null_tokens_are_those_of_the_csv_reader(spark):
    assert set(cells.NULL_TOKENS) == set(STR_NA_VALUES)
    frame = spark.createDataFrame([("NA",), ("na",), ("",), (" ",), (None,)], "cell string")
    got = [row[0] for row in frame.select(cells.null_if_token(F.col("cell"))).collect()]
    assert got == [None, "na", None, " ", None]


@pytest.mark.parametrize(
    "moment",
    ["2024-01-01 00:00:00", "2024-02-29 23:59:59.5", "1999-12-31 00:00:00.000001", "1969-12-31 23:59:59.25"],
)
def test_timestamp_text_is_that_of_pandas(spark, moment):
    text = spark.sql(f"SELECT timestamp'{moment}' AS t").select(times.timestamp_to_text(F.col("t"))).first()[0]
    assert text == pd.Series(pd.to_datetime([moment], utc=True)).astype(str)[0]


@pytest.mark.parametrize("seconds", ["1700000000", "0", "-1", "1.5", "", "abc", None, "60 ", "99999999999999", "253402300799", "253402300800", "-62135596800", "-62135596801"])
def test_epoch_text(spark, seconds):
    expected = {
        "1700000000": "14/11/2023 22:13:20",
        "0": "01/01/1970 00:00:00",
        "-1": "31/12/1969 23:59:59",
        "1.5": "01/01/1970 00:00:01",
        "60 ": "01/01/1970 00:01:00",
        "253402300799": "31/12/9999 23:59:59",
        "-62135596800": "01/01/0001 00:00:00",
    }
    frame = spark.createDataFrame([(seconds,)], "s string")
    assert frame.select(times.epoch_to_text(F.col("s"))).first()[0] == expected.get(seconds)


def test_date_text(spark):
    assert spark.sql("SELECT date'2024-03-09' AS d").select(times.date_to_text(F.col("d"))).first()[0] == "2024-03-09"


def test_message_body_round_trip(spark):
    text = "ñ " * 200
    frame = spark.createDataFrame([(text, None)], "a string, b int")
    body = messages.encoded(messages.record_json(F.col("a"), F.col("b")))
    row = frame.select(
        body.alias("body"), F.decode(F.unbase64(body), "UTF-8").alias("json")
    ).first()
    assert "\n" not in row.body and "\r" not in row.body
    assert row.json == '{"a":"' + text + '","b":null}'
