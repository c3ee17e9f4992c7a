"""Date key and holiday proximity.

``nearest`` (default): signed days from the date to the nearest holiday of
the years present in the data; a tie goes to the past holiday (negative).
For a date in year Y only the holidays of Y-1, Y and Y+1 can be nearest (a
year's own holidays are always within 365 days, those two years away never
are), so each day is joined to those three years' holidays only.

``scan``: the reference's fold: start at 999 and walk every holiday of every
present year (years ascending, rules in calendar order); a holiday replaces
the running value when its absolute distance is below it. A negative value
therefore sticks (T11). The fold is a built-in ``aggregate`` over one array
that is gathered from the holiday table.

Years are a frame: the distinct values that can form a date (1 to 9999),
whatever else the column holds. Both modes are evaluated once per calendar
day of the present years (at most 366 rows per year) and reach the data rows
by an equi-join on (year, month, day), so no holiday logic runs per data row.

A row whose parts are no valid date (31-2, month 13, a null) has no proximity;
it gets null, and assembling skips rows with a null feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivo.functions.calendar import CORRECTED, calendar_frame
from arrivo.operators.joins import broadcast_bytes

FIRST_YEAR, LAST_YEAR = 1, 9999
#: Bytes of a row of the per-day table in a broadcast hash table.
DAY_BYTES = 64


def date_key(year: Column, month: Column, day: Column) -> Column:
    """``d-M-yyyy`` text, not zero-padded; null if a part is null."""
    return F.concat(day.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"),
                    year.cast("string"))


def row_date(year: Column, month: Column, day: Column) -> Column:
    """The row's date straight from the integer parts."""
    return F.make_date(year, month, day)


def distinct_years(df: DataFrame, year_col: str) -> DataFrame:
    """(year) rows: the distinct values that can form a date."""
    year = F.col(year_col).cast("int")
    return df.filter(year.between(FIRST_YEAR, LAST_YEAR)).select(year.alias("year")).distinct()


def _key(diff: Column) -> Column:
    # order by |diff|, then past before future
    return F.abs(diff) * 2 + F.when(diff > 0, 1).otherwise(0)


def proximity_table(years: DataFrame, mode: str = "nearest", calendar=CORRECTED) -> DataFrame:
    """(year, month, day, proximity) for every calendar day of every year of
    ``years``: at most 366 rows per year.

    nearest: each day is joined (equi-join on year) to the holidays of Y-1,
    Y and Y+1 -- absent years have no holidays -- and the grouped minimum of
    (distance key, signed days) is taken. scan: the ordered fold."""
    ys = years.select(F.col("year").alias("__y"))
    days = ys.select("__y", F.explode(F.sequence(F.make_date("__y", F.lit(1), F.lit(1)),
                                                 F.make_date("__y", F.lit(12), F.lit(31))))
                     .alias("__date"))
    holidays = calendar_frame(ys, "__y", calendar).filter(F.col("holiday_date").isNotNull())
    if mode == "nearest":
        hol = holidays.select(F.col("year").alias("__hy"), F.col("holiday_date").alias("__h"))
        cand = days.select("__y", "__date", F.explode(
            F.array(F.col("__y") - 1, F.col("__y"), F.col("__y") + 1)).alias("__hy"))
        diff = F.datediff("__h", "__date")
        # at most (rules x 9999) holidays
        days = (cand.join(F.broadcast(hol), "__hy")
                .groupBy("__y", "__date")
                .agg(F.min(F.struct(_key(diff).alias("k"), diff.alias("v"))).alias("__b")))
        near = F.col("__b.v")
    elif mode == "scan":
        order = F.struct("year", "holiday_no", "holiday_date")
        dates = holidays.agg(F.array_sort(F.collect_list(order)).alias("__all")).withColumn("__one", F.lit(1))
        # a single row of at most (rules x 9999) dates
        days = days.withColumn("__one", F.lit(1)).join(F.broadcast(dates), "__one")
        near = F.aggregate("__all", F.lit(999), lambda acc, h: F.when(
            F.abs(F.datediff(h["holiday_date"], F.col("__date"))) < acc,
            F.datediff(h["holiday_date"], F.col("__date"))).otherwise(acc))
    else:
        raise ValueError(f"unknown proximity mode {mode!r}")
    return days.select("__y", F.month("__date").alias("__m"), F.dayofmonth("__date").alias("__d"),
                       near.cast("int").alias("__p"))


def add_proximity(df: DataFrame, year: str, month: str, day: str, out: str,
                  mode: str = "nearest", calendar=CORRECTED, years: DataFrame | None = None,
                  drop_single_year: bool = True) -> DataFrame:
    """E6 + P6 (T14): add ``out`` when year, month and day exist; drop the
    year column when it holds a single value, even without a proximity.

    Rows get their value from the per-day table by an equi-join on (year,
    month, day). The table's size follows from the number of years, so it is
    broadcast when its bytes are within the session's threshold. A row whose
    parts are not a valid date gets null."""
    if year not in df.columns:
        return df
    if years is None:
        years = distinct_years(df, year)
    n = years.count()
    out_df = df
    if month in df.columns and day in df.columns:
        side = proximity_table(years, mode, calendar)
        if 366 * n * DAY_BYTES <= broadcast_bytes(df.sparkSession):
            side = F.broadcast(side)
        cond = ((df[year] == side["__y"]) & (df[month] == side["__m"])
                & (df[day] == side["__d"]))
        out_df = df.join(side, cond, "left").select(
            *[df[c] for c in df.columns], side["__p"].cast("int").alias(out))
    if drop_single_year and n == 1:
        out_df = out_df.drop(year)
    return out_df
