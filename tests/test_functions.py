"""Text and date vectors (FIXTURES.md §C)."""

import datetime as dt

from pyspark.sql import functions as F

from quillprice.functions import dates, text


def test_item_code_parts(spark):
    df = spark.createDataFrame([("6250108  ",), ("625108  ",), ("625 108",), ("625A108",)], "c string")
    brand, base, valid = text.item_code_parts(F.col("c"))
    got = [tuple(r) for r in df.select(brand, base, valid).collect()]
    assert got == [("625", "108", True), ("625", "108", True), ("625", "108", True),
                   ("625", None, False)]


def test_clean_part_number(spark):
    df = spark.createDataFrame([("A-1 2/3.4\\5",), (None,)], "c string")
    assert [r[0] for r in df.select(text.clean_part_number(F.col("c"))).collect()] == ["A12345", None]


def test_padded_blank_comparison(spark):
    df = spark.createDataFrame([("  ",), ("",), ("x",), (None,)], "c string")
    assert df.filter(text.not_blank(F.col("c"))).count() == 1


def test_strip_prefix_ignores_trailing_blanks_in_length(spark):
    df = spark.createDataFrame([("BR1P12",), ("BR1",)], "c string")
    assert [r[0] for r in df.select(text.strip_prefix(F.col("c"), 3)).collect()] == ["P12", ""]


def test_dates(spark):
    df = spark.createDataFrame([("9/4/2017", dt.datetime(2017, 9, 4, 17, 50))],
                               "s string, t timestamp_ntz")
    r = df.select(dates.parse_us_date(F.col("s")), dates.yyyymmdd_int(F.col("t")),
                  dates.day_of(F.col("t"))).first()
    assert tuple(r) == (dt.date(2017, 9, 4), 20170904, dt.date(2017, 9, 4))


def test_tags_propagate_null(spark):
    df = spark.createDataFrame([("A",), (None,)], "m string")
    got = [tuple(r) for r in df.select(text.tag(True, F.col("m")), text.tag(False, F.col("m"))).collect()]
    assert got == [("<A>", "</A>"), (None, None)]
