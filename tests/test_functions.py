"""Column helpers, with the behaviour of pandas on the same cells as the yardstick."""

import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bazaarline import functions as fn
from bazaarline.functions.numbers import with_two_places


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, values, expr, kind="string"):
    out = column(spark, values, kind).select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in out]


def test_title_matches_python(spark):
    texts = ["O'neil mc-donald 3rd", "  john  smith ", "日本abc", "éCOLE ", "ab_cd", "", "x1y2 z", None, "ﬁx"]
    want = [t.strip().title() if t is not None else None for t in texts]
    assert apply(spark, texts, fn.title_trim) == want


def test_numbers_match_pandas(spark):
    texts = ["5", "5d", "NaN", " 3.9 ", "-3.9", "1e3", "abc", None, ".5", "+7", "0x10", "1_000", "7.", "--1"]
    series = pd.to_numeric(pd.Series(texts), errors="coerce").fillna(0)
    assert apply(spark, texts, fn.coerce_num) == list(series)
    assert apply(spark, texts, lambda c: fn.coerce_num(c, to_int=True)) == list(series.astype(int))


def test_long_ids_keep_every_digit(spark):
    assert apply(spark, ["9007199254740993"], lambda c: fn.coerce_num(c, True)) == [9007199254740993]


def test_nan_counts_as_missing(spark):
    from pyspark.sql.types import DoubleType
    assert apply(spark, [float("nan"), 2.5, None], lambda c: fn.coerce_num(c, dtype=DoubleType()), "double") == [0.0, 2.5, 0.0]


def test_keys_as_text(spark):
    assert apply(spark, ["007", "7", "7.0", None], lambda c: fn.as_id(c, StringType())) == [7, 7, 7, None]
    with pytest.raises(Exception, match="not a key"):
        apply(spark, ["A7"], lambda c: fn.as_id(c, StringType()))


def test_dates(spark):
    texts = ["2024-01-05", "2024-01-05 10:11:12.5", "01/02/2024", "1/2/2024 03:04:05", "20240105", "Jan 5 2024",
             "January 5, 2024", "bad", None, "2024-02-30"]
    want = [datetime(2024, 1, 5), datetime(2024, 1, 5, 10, 11, 12, 500000), datetime(2024, 1, 2),
            datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 5), datetime(2024, 1, 5), datetime(2024, 1, 5),
            None, None, None]
    assert apply(spark, texts, fn.parse_ts) == want
    with pytest.raises(Exception, match="not a date"):
        apply(spark, ["bad"], lambda c: fn.parse_ts(c, strict=True))


def test_date_parsing_ignores_the_session(spark):
    zone, ansi = spark.conf.get("spark.sql.session.timeZone"), spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        # 02:30 does not exist in that zone on this day; zone-less values do not care
        got = apply(spark, ["2024-03-10 02:30:00.7"], lambda c: fn.to_second(fn.parse_ts(c)))
        assert got == [datetime(2024, 3, 10, 2, 30)]
        span = apply(spark, ["2024-03-10"], lambda c: fn.whole_days(fn.parse_ts(c), fn.parse_ts(F.lit("2024-03-11"))))
        assert span == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_whole_days_counts_24_hours(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' a, timestamp_ntz'2024-01-03 09:00:00' b")
    assert df.select(fn.whole_days(F.col("a"), F.col("b"))).first()[0] == 1


def test_weekday_and_date_id(spark):
    got = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-07')) d").select(
        fn.iso_weekday(F.col("d")).alias("w"), fn.date_id(F.col("d")).alias("i")).collect()
    assert [r.w for r in got] == [1, 2, 3, 4, 5, 6, 7] and got[0].i == 20240101


def test_fill_all_zero(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a int, b string, c boolean, d date")
    assert tuple(fn.fill_all_zero(df).first()) == (0, "0", False, None)


def test_fill_all_casts(spark):
    df = spark.createDataFrame([(None, None), (1, "x")], "a int, b string")
    assert sorted(map(tuple, fn.fill_all(df).collect())) == [("1", "x"), ("Unknown", "Unknown")]


def test_null_tokens_and_slug(spark):
    assert apply(spark, ["NA", "N/A", "null", "", "None", "x"], fn.null_tokens) == [None] * 5 + ["x"]
    assert apply(spark, ["My File-1.csv"], fn.slug) == ["custom_my_file_1"]


def test_differs_three_valued(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, None), ("a", "a")], "o string, n string")
    got = df.select(fn.differs(F.col("o"), F.col("n")).alias("d"),
                    fn.differs(F.col("o"), F.col("n"), null_safe=True).alias("s")).collect()
    assert [(r.d, r.s) for r in got] == [(True, True), (False, True), (False, False), (False, False)]


def test_two_places_as_python(spark):
    rng = random.Random(7)
    values = [0.0, 3.315, 0.125, 0.375, 2.675, 100.0, 99.995, 0.005, 0.015, 1.005, 33.335]
    values += [rng.randint(0, 60000) / 60000 * 100 for _ in range(500)]
    got = with_two_places(column(spark, values, "double"), "x", "y").orderBy("i").collect()
    assert [r.y for r in got] == [f"{v:.2f}" for v in values]
