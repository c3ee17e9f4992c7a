import datetime as dt

from pyspark.sql import functions as F

from arrivo.functions.calendar import AS_BUILT, CORRECTED, calendar_frame
from arrivo.functions.holidays import add_proximity, date_key

CORR_2008 = ("01-29 07-04 08-27 10-31 12-31 12-25 11-11 06-19 04-04 02-03 04-13 04-21 11-27 "
             "09-01 10-13 01-21 02-18 09-01 02-17 05-26").split()
CORR_2013 = ("01-29 07-04 08-27 10-31 12-31 12-25 11-11 06-19 04-04 02-03 04-14 04-15 11-28 "
             "09-02 10-14 01-21 02-18 09-02 02-16 05-27").split()


def cal(spark, year, calendar=CORRECTED):
    years = spark.createDataFrame([(year,)], "y int")
    rows = calendar_frame(years, "y", calendar).orderBy("holiday_no").collect()
    return [r["holiday_date"] and r["holiday_date"].strftime("%m-%d") for r in rows]


def test_corrected_calendar(spark):
    assert cal(spark, 2008) == CORR_2008
    assert cal(spark, 2013) == CORR_2013


def test_as_built_errors(spark):
    got = dict(zip([r.name for r in AS_BUILT], cal(spark, 2008, AS_BUILT)))
    assert got["MLK Day"] == "01-14"             # one week early in 2008
    assert got["Boston Marathon"] == "04-14"
    y2009 = dict(zip([r.name for r in AS_BUILT], cal(spark, 2009, AS_BUILT)))
    assert y2009["Columbus Day"] == "09-07"      # "2nd Monday of September", one week early
    for year in (1996, 2013):                    # a first occurrence has no date there
        y = dict(zip([r.name for r in AS_BUILT], cal(spark, year, AS_BUILT)))
        assert y["Labor Day"] is None and y["Burning Man"] is None
        assert y["Thanksgiving"] == "11-21"


PROX = [("2008-01-01", 20, 20), ("2008-01-20", 1, 1), ("2008-01-22", -1, -1),
        ("2008-01-25", -4, 4), ("2008-01-29", 0, 0), ("2008-01-30", -1, -1),
        ("2008-05-26", 0, -118), ("2008-07-03", 1, -156), ("2008-07-04", 0, -157),
        ("2008-10-10", 3, -255), ("2008-12-28", -3, -334), ("2008-12-31", 0, -337)]


def dates(spark, items):
    rows = [(d.year, d.month, d.day) for d in (dt.date.fromisoformat(x) for x in items)]
    return spark.createDataFrame(rows, "Year int, Month int, DayofMonth int")


def test_proximity_modes(spark):
    df = dates(spark, [p[0] for p in PROX])
    near = add_proximity(df, "Year", "Month", "DayofMonth", "p", "nearest",
                         drop_single_year=False).collect()
    scan = add_proximity(df, "Year", "Month", "DayofMonth", "p", "scan",
                         drop_single_year=False).collect()
    assert [r["p"] for r in near] == [p[1] for p in PROX]
    assert [r["p"] for r in scan] == [p[2] for p in PROX]


def test_scan_year_order(spark):
    df = dates(spark, ["2008-07-03"])
    a = add_proximity(df, "Year", "Month", "DayofMonth", "p", "scan", AS_BUILT,
                      years=spark.createDataFrame([(2007,), (2008,)], "year int")).collect()[0]["p"]
    assert a == -521


def test_nearest_uses_neighbour_years(spark):
    df = dates(spark, ["2008-01-01", "2007-12-30"])
    out = add_proximity(df, "Year", "Month", "DayofMonth", "p").orderBy("Month").collect()
    # 1 Jan 2008 is one day after 31 Dec 2007 (present), 30 Dec is one day before it
    assert [r["p"] for r in out] == [-1, 1]


def test_single_year_dropped(spark):
    df = dates(spark, ["2008-01-01", "2008-02-01"])
    out = add_proximity(df, "Year", "Month", "DayofMonth", "p")
    assert "Year" not in out.columns and "p" in out.columns
    no_day = add_proximity(df.drop("DayofMonth"), "Year", "Month", "DayofMonth", "p")
    assert no_day.columns == ["Month"]


def test_date_key(spark):
    df = spark.createDataFrame([(2008, 1, 5), (2008, None, 5)], "y int, m int, d int")
    got = [r[0] for r in df.select(date_key(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == ["5-1-2008", None]


def test_dirty_years_and_impossible_dates(spark):
    rows = [(2008, 1, 29), (0, 1, 1), (-5, 1, 1), (123456, 1, 1), (None, 1, 1), (2008, 2, 31), (2008, 13, 1)]
    df = spark.createDataFrame(rows, "Year int, Month int, DayofMonth int")
    for mode in ("nearest", "scan"):
        out = add_proximity(df, "Year", "Month", "DayofMonth", "p", mode, drop_single_year=False).collect()
        assert len(out) == len(rows)
        assert [r["p"] for r in out if r["p"] is not None] == [0]
