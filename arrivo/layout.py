"""Column roles. Every operator takes names from a Layout, so the same code
runs on the flight contract and on the trips mapping of the driver tables."""

from __future__ import annotations

from dataclasses import dataclass, field


# Fixed values that must equal the reference's for the same results:
# the columns removed before cleaning (leaks, identifiers, local clock times)
FLIGHT_FIXED_DROPS = (
    "ArrTime", "ActualElapsedTime", "AirTime", "Diverted", "CarrierDelay",
    "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay", "TaxiIn",
    "TailNum", "CRSArrTime", "DepTime", "CRSDepTime", "Cancelled",
    "CancellationCode",
)

# Names of the four interaction features
INTERACTION_NAMES = (
    "depDelayTaxiOutInteraction", "origDestInteraction",
    "monthDayofMonthInteraction", "depDelayOrigInteraction",
)


@dataclass(frozen=True)
class Layout:
    # The default names are the flight contract's
    year: str = "Year"
    month: str = "Month"
    day: str = "DayofMonth"
    weekday: str = "DayOfWeek"
    carrier: str = "UniqueCarrier"
    route: str = "FlightNum"
    vehicle: str = "TailNum"
    origin: str = "Origin"
    dest: str = "Dest"
    label: str = "ArrDelay"
    dep_delay: str = "DepDelay"
    taxi_out: str = "TaxiOut"
    cancelled: str = "Cancelled"
    # text columns that are cast to int, in the reference's order
    text_to_int: tuple[str, ...] = ("ArrDelay", "TaxiOut", "DepDelay")
    fixed_drops: tuple[str, ...] = FLIGHT_FIXED_DROPS
    # dimension table: key and the two attributes that are kept
    dim_key: str = "tailnum"
    dim_model: str = "model"
    dim_engine: str = "engine_type"
    # column that keeps a row's split / fold; None = hash of the whole row
    split_key: str | None = None
    proximity: str = "proximityToHoliday"
    interactions: tuple[str, ...] = field(default=INTERACTION_NAMES)

    def protected(self) -> tuple[str, ...]:
        """Columns the missing-value policy must never drop."""
        return tuple(c for c in (self.label, self.split_key) if c)


FLIGHTS = Layout()

TRIPS = Layout(
    year="trip_year", month="trip_month", day="trip_day", weekday="trip_dow",
    carrier="carrier", route="route_num", vehicle="vehicle_id",
    origin="origin", dest="dest", label="arr_delay", dep_delay="dep_delay",
    taxi_out="taxi_out", cancelled="cancelled",
    text_to_int=("arr_delay", "taxi_out", "dep_delay"),
    fixed_drops=("vehicle_id", "cancelled"),
    split_key="o_orderkey",
)
