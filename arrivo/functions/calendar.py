"""Holiday calendar as Spark column expressions over a year column (E5,
X6, X9-X12).

A calendar is a list of rules; each rule becomes a date expression of the
year, so a whole year's holidays are one ``array<date>`` expression and the
calendar of many years is an ``explode`` of it (U2).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str            # fixed | nth | last | same | before
    month: int = 0
    day: int = 0         # day of month (fixed) or days before (before)
    weekday: str = ""    # MON .. SUN (nth, last)
    n: int = 0           # nth occurrence
    ref: str = ""        # rule name (same, before)


# The holiday rules in array order (20 entries, corrected:
# Labor Day in September, Columbus Day in October, Memorial Day added).
CORRECTED = (
    Rule("Sundance festival", "fixed", 1, 29),
    Rule("Independence Day", "fixed", 7, 4),
    Rule("US Open tennis", "fixed", 8, 27),
    Rule("Halloween", "fixed", 10, 31),
    Rule("New Year's Eve", "fixed", 12, 31),
    Rule("Christmas", "fixed", 12, 25),
    Rule("Veterans Day", "fixed", 11, 11),
    Rule("Juneteenth", "fixed", 6, 19),
    Rule("Easter (approximate)", "fixed", 4, 4),
    Rule("Super Bowl", "nth", 2, weekday="SUN", n=1),
    Rule("Masters golf", "nth", 4, weekday="SUN", n=2),
    Rule("Boston Marathon", "nth", 4, weekday="MON", n=3),
    Rule("Thanksgiving", "nth", 11, weekday="THU", n=4),
    Rule("Labor Day", "nth", 9, weekday="MON", n=1),
    Rule("Columbus Day", "nth", 10, weekday="MON", n=2),
    Rule("MLK Day", "nth", 1, weekday="MON", n=3),
    Rule("Presidents' Day", "nth", 2, weekday="MON", n=3),
    Rule("Burning Man", "same", ref="Labor Day"),
    Rule("Mardi Gras", "before", day=47, ref="Easter (approximate)"),
    Rule("Memorial Day", "last", 5, weekday="MON"),
)

# The as-built calendar (19 entries): Labor and Columbus months
# swapped, no Memorial Day, and the defect stated at ``nth_weekday_as_built``.
AS_BUILT = tuple(
    Rule(r.name, "nth_as_built", 10 if r.name == "Labor Day" else 9 if r.name == "Columbus Day"
         else r.month, weekday=r.weekday, n=r.n) if r.kind == "nth" else r
    for r in CORRECTED if r.name != "Memorial Day")

_ISO = {"MON": 1, "TUE": 2, "WED": 3, "THU": 4, "FRI": 5, "SAT": 6, "SUN": 7}


def nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    """The n-th given weekday of a month."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: str) -> Column:
    """Last given weekday of a month (X11 + next_day)."""
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(last, 7), weekday)


def nth_weekday_as_built(year: Column, month: int, weekday: str, n: int) -> Column:
    """The as-built defect (T12): where the first of the month falls on the
    day after the wanted weekday, the date is a week early, and a first
    occurrence there has no date (null)."""
    after = F.weekday(F.make_date(year, F.lit(month), F.lit(1))) == _ISO[weekday]  # weekday: Monday is 0
    right = nth_weekday(year, month, weekday, n)
    early = F.date_sub(right, 7) if n > 1 else F.lit(None).cast("date")
    return F.when(after, early).otherwise(right)


def rule_dates(year: Column, calendar=CORRECTED) -> list[Column]:
    """One date expression per rule, in calendar order."""
    built: dict[str, Column] = {}
    out = []
    for r in calendar:
        if r.kind == "fixed":
            e = F.make_date(year, F.lit(r.month), F.lit(r.day))
        elif r.kind == "nth":
            e = nth_weekday(year, r.month, r.weekday, r.n)
        elif r.kind == "nth_as_built":
            e = nth_weekday_as_built(year, r.month, r.weekday, r.n)
        elif r.kind == "last":
            e = last_weekday(year, r.month, r.weekday)
        elif r.kind == "same":
            e = built[r.ref]
        elif r.kind == "before":
            e = F.date_sub(built[r.ref], r.day)           # X12
        else:
            raise ValueError(f"unknown rule kind {r.kind}")
        built[r.name] = e
        out.append(e)
    return out


def calendar_frame(years: DataFrame, year_col: str, calendar=CORRECTED) -> DataFrame:
    """(year, holiday_no, holiday_name, holiday_date), one row per year
    and rule, from a frame of years."""
    entries = F.array(*[
        F.struct(F.lit(i + 1).alias("holiday_no"), F.lit(r.name).alias("holiday_name"),
                 d.alias("holiday_date"))
        for i, (r, d) in enumerate(zip(calendar, rule_dates(F.col(year_col), calendar)))])
    return (years.select(F.col(year_col).alias("year"), F.explode(entries).alias("h"))
            .select("year", "h.holiday_no", "h.holiday_name", "h.holiday_date"))
