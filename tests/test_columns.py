import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import columns as c

col = F.col


def one(spark, expr):
    return spark.range(1).select(expr).first()[0]


def text(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(col("x"))).first()[0]


def test_names(spark):
    assert text(spark, "  BISHAL j   \n Rijal", c.clean_name) == "Bishal J Rijal"
    assert text(spark, "mary-jane o'neil", c.clean_name) == "Mary-Jane O'Neil"
    assert text(spark, "a  b", c.collapse_spaces) == "a b"
    assert text(spark, "bishal   rijal", lambda x: F.replace(x, F.lit("  "), F.lit(" "))) == "bishal  rijal"
    assert text(spark, "ßein 3rd", c.title_words) == "ßein 3rd"


def test_title_words_on_random_text(spark):
    import random
    import re

    rnd = random.Random(4)
    data = [("".join(rnd.choice("abÉéßŉﬁ9 _-'.\n\tZ") for _ in range(25)),) for _ in range(1000)]
    df = spark.createDataFrame(data, "x string")

    def word(m):
        w = m.group(0)
        return (w[0].upper() if len(w[0].upper()) == 1 else w[0]) + w[1:].lower()

    for value, got in df.select("x", c.title_words(col("x"))).collect():
        assert got == re.sub(r"[^\W_]+", word, value), repr(value)


def test_dates_golden_rows(spark):
    data = [
        (1, "2024-03-04 08:12:00", "2024-03-04 08:45:00"),
        (2, "2024-03-04 21:50:00", "2024-03-04 22:10:00"),
        (3, "2024-03-10 14:05:00", "2024-03-10 14:40:00"),
        (4, "2024-03-15 09:00:00", None),
        (5, "2024-04-03 19:30:00", "2024-04-03 19:52:00"),
    ]
    df = spark.createDataFrame(data, "i int, a string, b string").select(
        "i", col("a").cast("timestamp_ntz").alias("a"), col("b").cast("timestamp_ntz").alias("b")
    )
    got = df.select(
        F.hour("a"), c.day_of_week(col("a")), F.date_format("a", "MMM dd, yyyy hh:mm a"),
        c.minutes_between(col("a"), col("b"), 1).cast("double"), c.date_key(col("a")), c.quarter_hour_key(col("a")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (8, 1, "Mar 04, 2024 08:12 AM", 33.0, 20240304, 800),
        (21, 1, "Mar 04, 2024 09:50 PM", 20.0, 20240304, 2145),
        (14, 0, "Mar 10, 2024 02:05 PM", 35.0, 20240310, 1400),
        (9, 5, "Mar 15, 2024 09:00 AM", None, 20240315, 900),
        (19, 3, "Apr 03, 2024 07:30 PM", 22.0, 20240403, 1930),
    ]


def test_parsing_of_numbers_in_text(spark):
    assert text(spark, "148 min", c.minutes_text) == 148
    assert text(spark, "2,345,678", c.comma_number) == 2345678
    assert int(text(spark, "$28,341,469", c.dollars)) == 28341469
    assert text(spark, "87%", c.percent_text) == 87
    assert text(spark, "8.8", lambda x: c.plain_number(x, "double")) == 8.8
    for value in ("N/A", "2 h 28 min", "148 min.", "min", "", "-5 min"):
        assert text(spark, value, c.minutes_text) is None
    assert text(spark, "2,34,5678", c.comma_number) is None and text(spark, "12 votes", c.comma_number) is None
    assert text(spark, "$1.2M", c.dollars) is None and text(spark, "8/10", c.percent_text) is None
    assert text(spark, "a\u0002b c\u0001 d", c.title_words) == "A\u0002B C\u0001 D"
    assert text(spark, "USA, UK", c.first_listed) == "USA"


def test_predicates(spark):
    df = spark.createDataFrame([("cash",), ("Cash",), (None,)], "x string")
    assert df.where(c.differs_or_null(col("x"), "cash")).count() == 2
    assert df.where(c.equals_ignoring_case(col("x"), "CASH")).count() == 2
    assert df.where(c.equals_sql_null(col("x"))).count() == 0


def test_day_comparison_is_strictly_later(spark):
    df = spark.createDataFrame([("2024-06-01 23:59:59",), ("2024-06-02 00:00:01",)], "x string")
    df = df.select(col("x").cast("timestamp_ntz").alias("x"))
    assert df.where(c.later_than_day(col("x"), dt.date(2024, 6, 1))).count() == 1


def test_record_json_keeps_nulls(spark):
    df = spark.createDataFrame([("1", None)], "a string, b string")
    assert df.select(c.record_json("a", "b")).first()[0] == '{"a":"1","b":null}'


def test_percent_guards_zero(spark):
    assert one(spark, c.percent_of(F.lit(1), F.lit(0))) is None
    assert float(one(spark, c.percent_of(F.lit(1), F.lit(3)))) == 33.33


def test_now_takes_a_fixed_instant(spark):
    assert one(spark, c.now(dt.datetime(2020, 1, 2))) == dt.datetime(2020, 1, 2)
    assert one(spark, c.now()).year >= 2024
