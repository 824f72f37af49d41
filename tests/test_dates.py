from datetime import datetime

import pytest
from pyspark.sql import functions as F

from regloom.functions.dates import (
    date_struct,
    normalise_date,
    normalise_timestamp,
    parse_format,
    to_lenient_date,
)

CASES = {
    "%m%d%Y": [
        "01022024", "132021", "1112021", "1122021", "12312021", "02302021", "02292024", "02292023", "2021", "202101",
        "21", "", "abc", "00012021", "1 12021", " 1012021", "010120211", "01012021 ", "111220211", "12345678",
        "13145678", "31122021", "0101 2021", "01010000", "10122021", "1012021", "01012021\n",
    ],
    "%d %b %Y": [
        "03 Oct 2024", "3 oct 2024", "3  OCT   2024", "31 Feb 2024", "3 October 2024", "03Oct2024", " 3 Oct 2024", "29 Feb 2024",
        "03\tOct 2024", "32 Jan 2024", "0 Jan 2024", "3 Oct 24",
    ],
    "%Y-%m-%d": ["2021-01-01", "2021-1-1", "2021-02-31", "2021-13-01", "2021-1-32", "21-1-1", "2021-01-01T"],
    "%m/%d/%Y": ["12/31/2021", "1/1/2021", "13/1/2021", "12/ 1/2021", "12-31-2021"],
    "%d %B %Y": ["3 May 2024", "03 september 2024", "3 Sep 2024"],
    "%d.%m.%y": ["1.2.68", "1.2.69", "01.12.99", "1x2x99"],
    "%Y-%m-%dT%H:%M:%S": ["2024-10-07T01:02:03", "2024-10-07t1:2:3", "2024-10-07T24:00:00", "2024-10-07T23:59:60"],
    "100%% %Y": ["100% 2024", "100%% 2024"],
    "%b": ["jan", "DEC", "xxx"],
}


def python_date(text, fmt):
    try:
        return datetime.strptime(text, fmt)
    except ValueError:
        return None


@pytest.mark.parametrize("fmt", CASES)
def test_equal_to_strptime(spark, fmt):
    df = spark.createDataFrame([(v,) for v in CASES[fmt]], "v string")
    got = df.select("v", to_lenient_date(F.col("v"), fmt).alias("d"), normalise_date(F.col("v"), fmt).alias("n")).collect()
    for r in got:
        expected = python_date(r.v, fmt)
        assert r.d == (expected.date() if expected else None), repr(r.v)
        assert r.n == (expected.strftime(fmt) if expected else r.v), repr(r.v)


def test_exhaustive_digit_strings(spark):
    values = [f"{n}{y}" for n in range(0, 10000, 7) for y in ("2021", "2024", "202", "20245")]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", to_lenient_date(F.col("v"), "%m%d%Y").alias("d")).collect():
        expected = python_date(r.v, "%m%d%Y")
        assert r.d == (expected.date() if expected else None), r.v


def test_date_struct(spark):
    got = spark.sql("select '132021' v").select(date_struct(F.col("v"), "MMDDYYYY", "%m%d%Y").alias("s")).head()[0]
    assert got.asDict() == {"value": "01032021", "format": "MMDDYYYY", "python_date_format": "%m%d%Y"}


def test_unsupported_formats_are_refused():
    for fmt in ("%j", "%Y %Y", "%Q"):
        with pytest.raises(ValueError):
            parse_format(fmt)


TIMES = [
    "2024-10-07T01:02:03.123456", "2024-10-07T01:02:03.1", "2024-10-07T01:02:03.123456+02:00", "2024-10-07T01:02:03.5Z",
    "2024-10-07T01:02:03.5-0330", "2024-10-07T01:02:03", "2024-10-07T01:02:03Z", "2024-10-07 01:02:03", "2024-1-7T1:2:3",
    "2024-10-07 01:02:03.5", "2024-10-07T01:02:03+02:00", "2024-02-30T00:00:00", "nope", "", "2024-10-07",
    "2024-10-07T01:02:60", "2024-10-07T25:02:03", "2024-10-07T01:02:03.1234567", "2024-10-07  01:02:03",
]


def python_time(text):
    for fmt in ("%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S"):
        found = python_date(text, fmt)
        if found:
            return found.strftime("%Y-%m-%dT%H:%M:%SZ")
    return text


def test_timestamps(spark):
    df = spark.createDataFrame([(v,) for v in TIMES], "v string")
    for r in df.select("v", normalise_timestamp(F.col("v")).alias("n")).collect():
        assert r.n == python_time(r.v), r.v
