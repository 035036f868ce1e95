import datetime

import pytest
from pyspark.sql import functions as F

from starledger.functions.dates import (
    clean_dates, clean_dates_lenient, make_full_date, parse_date_uniform, sale_instant,
)
from starledger.functions.gaps import format_gap, mean_gap, micros
from starledger.functions.goods import availability_to_bool, weight_class, weight_to_kg
from starledger.functions.numbers import percent_of_count, strip_symbol, try_double
from starledger.functions.text import concat_skip_null, digits_only


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", function(F.col("v")).alias("r")).orderBy("i")
    return [r["r"] for r in out.collect()]


def day(text):
    return text and datetime.date.fromisoformat(text)


DATES = {
    "2013-10-14": "2013-10-14",
    "2010-07-17": "2010-07-17",
    "2000-06-15": "2000-06-15",
    "2017-01-20": "2017-01-20",
    "2006 September 03": "2006-09-03",
    "2013-10-14T10:11:12": "2013-10-14",
    "2012/1/5": "2012-01-05",
    "September 2006 03": "2006-09-03",
    "July 1961 14": "1961-07-14",
    "JULY 1961 14": "1961-07-14",
    "05/10/2011": "2011-05-10",
    "25/10/2011": "2011-10-25",
    "14 July 1961": "1961-07-14",
    "July 14, 1961": "1961-07-14",
    "2006 Sep 3": "2006-09-03",
    "2006 Sep 03": None,
    "2001-13-45": None,
    "2013-10-14xyz": None,
    "2012/01/05 x": None,
    "NULL": None,
    "QX7JUNK": None,
    "": None,
    None: None,
}


def test_clean_dates(spark):
    assert apply(spark, clean_dates, list(DATES)) == [day(d) for d in DATES.values()]


def test_clean_dates_in_every_layout(spark):
    """Many days, each written in each layout, all read back as the same day."""
    days = [datetime.date(1950, 1, 1) + datetime.timedelta(days=97 * i) for i in range(250)]
    layouts = ["%Y-%m-%d", "%Y/%m/%d", "%Y %B %d", "%B %Y %d", "%m/%d/%Y", "%d %B %Y", "%B %d, %Y", "%Y%m%d"]
    written = [d.strftime(layout) for layout in layouts for d in days]
    assert apply(spark, clean_dates, written) == days * len(layouts)


def test_clean_dates_is_idempotent(spark):
    again = lambda c: clean_dates(clean_dates(c).cast("string"))
    assert apply(spark, again, list(DATES)) == [day(d) for d in DATES.values()]


def test_uniform_dates(spark):
    values = ["2012-01-05", "05/01/2012", "2012-1-5", None]
    assert apply(spark, parse_date_uniform, values) == [day("2012-01-05"), None, None, None]


def test_full_date(spark):
    df = spark.createDataFrame([(2001, 2, 3), (2001, 2, 30), (None, 1, 1)], "y int, m int, d int")
    full = df.select(make_full_date(F.col("y"), F.col("m"), F.col("d")).alias("r"))
    assert [r["r"] for r in full.collect()] == ["2001-02-03", None, None]


WEIGHTS = {
    "0.08kg": 0.08,
    "420g": 0.42,
    "1.68kg": 1.68,
    "0.718kg": 0.718,
    "600ml": 0.6,
    "0.504kg": 0.504,
    "480g": 0.48,
    "8 x 150g": 1200.0,
    "6oz": 0.17,
    "110lbs": None,
    "10 Gallons": None,
    "10ms": None,
    "77g .": 0.077,
    "0.5g": 0.005,
    "1.5ml": 0.015,
    "12 x 85ml": None,
    "12 x 1kg": None,
    "12fkg": None,
    None: None,
}


def test_weight_to_kg(spark):
    assert apply(spark, weight_to_kg, list(WEIGHTS)) == list(WEIGHTS.values())


def test_weight_class(spark):
    got = apply(spark, weight_class, [1.99, 2.0, 39.99, 40.0, 139.99, 140.0, None], "double")
    assert got == ["Light", "Mid_Sized", "Mid_Sized", "Heavy", "Heavy", "Truck_Required", "Unknown"]


def test_numbers(spark):
    values = ["12", " 1.5 ", "1e3", ".5", "12d", "NaN", "N/A", "", None]
    assert apply(spark, try_double, values) == [12.0, 1.5, 1000.0, 0.5, None, None, None, None, None]
    assert apply(spark, strip_symbol, ["£3.50", "3", "x"]) == [3.5, 3.0, None]


def test_text(spark):
    assert apply(spark, digits_only, ["?4971-8582", "x", None]) == ["49718582", "", ""]
    label = lambda c: concat_skip_null(F.lit("a"), c, F.lit("b"))
    assert apply(spark, label, ["-", None]) == ["a-b", "ab"]
    assert apply(spark, availability_to_bool, ["Removed", "Still_avaliable", "odd", None]) == [
        False, True, None, None,
    ]


def test_percent_rounds_ties_up(spark):
    df = spark.createDataFrame([(1, 8), (3, 60000), (1, 3), (2, 3)], "a long, b long")
    got = [r["r"] for r in df.select(percent_of_count(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [12.5, 0.01, 33.33, 66.67]


@pytest.mark.parametrize(
    "gap,text",
    [
        (8_233_295_000, '"Hours": 2, "minutes" :17, "seconds" :13, "milliseconds" :30'),
        (59_999_999, '"Hours": 0, "minutes" :0, "seconds" :60, "milliseconds" :100'),
        (None, '"Hours": , "minutes" :, "seconds" :, "milliseconds" :'),
    ],
)
def test_format_gap(spark, gap, text):
    assert apply(spark, format_gap, [gap], "long") == [text]


def test_mean_gap(spark):
    df = spark.createDataFrame([(7, 2), (5, 0), (6, 3)], "t long, n long")
    assert [r["r"] for r in df.select(mean_gap(F.col("t"), F.col("n")).alias("r")).collect()] == [4, None, 2]


def test_micros_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00.123456' AS t")
    expected = int(datetime.datetime(2024, 3, 31, 2, 30, tzinfo=datetime.timezone.utc).timestamp()) * 10**6 + 123456
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(micros(F.col("t")).alias("m")).first()["m"] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# Texts that no fixed layout reads, and the dates a lenient reader takes them for, two-digit years around 2025.
LENIENT = {
    "3rd March 2011": "2011-03-03", "2011.05.04": "2011-05-04", "05-Mar-2011": "2011-03-05", "Sunday, March 6, 2011": "2011-03-06",
    "5/4/11": "2011-05-04", "March 2011": "2011-03-01", "2011-07": "2011-07-01", "2011": "2011-01-01", "March 3": None, "3 March": None,
    "07/2011": "2011-07-01", "2011/07": "2011-07-01", "31-12-99": "1999-12-31", "5/4/74": "2074-05-04", "5/4/75": "1975-05-04",
    "99-Jan-01": "1999-01-01", "01-Jan-99": "1999-01-01", "Jan 01 99": "1999-01-01", "4 of July, 2011": "2011-07-04",
    "the 4th of July 2011": None, "110504": "2004-11-05", "20110504T101112": "2011-05-04", "March 6 2011 10:30 pm": "2011-03-06",
    "10:30 March 6 2011": "2011-03-06", "Mar. 6, 2011": "2011-03-06", "6.3.2011": "2011-06-03", "13.3.2011": "2011-03-13",
    "2011-Mar-06": "2011-03-06", "Mar-06-2011": "2011-03-06", "6-mar-11": "2011-03-06", "Sept 5 2011": "2011-09-05",
    "Sun 6 Mar 2011": "2011-03-06", "2011 13 45": None, "30 Feb 2011": None, "29 Feb 2012": "2012-02-29", "29 Feb 2011": None,
    "QX7123": None, "NULL": None, "  2011 July 4  ": "2011-07-04", "July 4 2011 UTC": None, "2011-05-04T23:00:00+02:00": "2011-05-04",
    "1/2/3": "2003-01-02", "10 11 12": "2012-10-11", "2011 5": "2011-05-01", "5 2011": "2011-05-01", "May 2011 3": "2011-05-03",
    "2011 3 May": "2011-05-03", "3 2011 May": "2011-05-03", "march 3rd, 2011 5pm": "2011-03-03", "3/March/2011": "2011-03-03",
    "2011;05;04": "2011-05-04", "2011, March 4": "2011-03-04", "4th 2011 March": "2011-03-04", "4 July '11": "2011-07-04", "July '11": None,
    "31/31/2011": None, "2011366": None, "1e5": None, "12": None, "1234567": None, "Tue 2011": None, "3 3 2011 March": None,
    "2011 2012": None, "Mar 3 Apr 2011": None, "44 March 2011": None, "0 March 2011": None, "12/2011/05": None, "25/2011/12": None,
    "32 May 2011": None, "1 January 70": "2070-01-01", "March 11": None, "March 74": "2074-03-01", "a 3 march 2011": None,
    "3 march 2011 ad": "2011-03-03", "2011 10 4 5": None, "2011-05-04 25:00": None, "": None,
}


def test_lenient_dates(spark):
    df = spark.createDataFrame([(t,) for t in [*LENIENT, None]], "t string")
    for read in (clean_dates, clean_dates_lenient):
        found = {r.t: r.d and str(r.d) for r in df.select("t", read(F.col("t"), 2025).alias("d")).collect()}
        assert found == LENIENT | {None: None}


def test_texts_of_a_layout_of_their_own_are_not_read_leniently(spark):
    df = spark.createDataFrame([(t,) for t in ("2011 Mar 05", "2011/05/04 10:00", "2011/13/45")], "t string")
    assert {r.d for r in df.select(clean_dates(F.col("t")).alias("d")).collect()} == {None}


def test_sale_instants(spark):
    cases = [
        (2011, 3, 4, "10:11:12", "2011-03-04 10:11:12"), (2011, 3, 4, "1:2", "2011-03-04 01:02:00"), (2011, 2, 30, "10:11:12", None),
        (2011, 3, 4, None, "2011-03-04 00:00:00"), (None, 3, 4, "10:11:12", None), (2011, 3, 4, "25:00:00", None),
        (2011, 3, 4, "noon", None), (2011, 3, 4, "10:11:12.5", "2011-03-04 10:11:12.500000"),
    ]
    df = spark.createDataFrame(cases, "y int, m int, d int, t string, expected string")
    instant = sale_instant(*(F.col(c) for c in "ymdt"))
    assert [r.i and str(r.i) for r in df.select(instant.alias("i")).collect()] == [c[-1] for c in cases]
