"""The whole program on a flight-contract CSV written from the driver tables."""

from pyspark.sql import functions as F

from arrivo.plans import flow
from arrivo.plans.model import Grid
from arrivo.session import scratch_path
from arrivo.sources.tables import DIMENSION_HEADER, trips, vehicle_dimension

from conftest import SF_SMALL

TO_FLIGHT = {
    "trip_year": "Year", "trip_month": "Month", "trip_day": "DayofMonth",
    "trip_dow": "DayOfWeek", "carrier": "UniqueCarrier", "route_num": "FlightNum",
    "vehicle_id": "TailNum", "sched_minutes": "CRSElapsedTime", "arr_delay": "ArrDelay",
    "dep_delay": "DepDelay", "cancel_code": "CancellationCode", "origin": "Origin",
    "dest": "Dest", "distance": "Distance", "taxi_out": "TaxiOut", "cancelled": "Cancelled",
    "o_orderkey": "Order-Key",
}

SMALL = Grid(lr_reg=(0.1,), lr_elastic=(0.5,), rf_depths=(3,), rf_trees=(3,))


def flight_csv(spark):
    path = scratch_path(spark, "flights") + ".csv"
    t = trips(spark, SF_SMALL)
    t.select(*[F.col(k).alias(v) for k, v in TO_FLIGHT.items()]) \
        .write.option("header", True).csv(path)
    return path


def test_program_forest_and_linear(spark):
    path = flight_csv(spark)
    rf = flow.run(spark, path, "", grid=SMALL)
    assert rf.unknown_columns == ("OrderKey",)
    m = rf.metrics.first()
    assert m["algorithm"] == "forest" and m["rmse"] > 0
    assert "TailNum" not in rf.prepared.frame.columns
    assert "CancellationCode" not in rf.prepared.frame.columns
    assert not any("Interaction" in c for c in rf.prepared.features)
    lr = flow.run(spark, path, "LR", grid=SMALL)
    assert lr.metrics.first()["algorithm"] == "linear"
    assert "origDestInteraction" in lr.prepared.features
    assert len(lr.scored.vector_names) > len(lr.prepared.features)


def test_program_with_dimension(spark):
    path = flight_csv(spark)
    dpath = scratch_path(spark, "vehicles") + ".csv"
    vehicle_dimension(spark, SF_SMALL).select(*DIMENSION_HEADER) \
        .write.option("header", True).csv(dpath)
    res = flow.run(spark, path, "rf", dimension_path=dpath, grid=SMALL)
    assert res.prepared.dimension_reason is None
    assert "model" in res.prepared.features and "engine_type" in res.prepared.features
    bad = flow.run(spark, path, "rf", dimension_path=dpath + ".missing.csv", grid=SMALL)
    assert bad.prepared.dimension_reason is not None
    assert "model" not in bad.prepared.features


def same_rows(a, b, cols):
    x, y = (sorted(tuple(r) for r in df.select(*cols).collect()) for df in (a, b))
    assert x == y and x


def test_apply_prepared_reuses_the_fit(spark):
    from arrivo.layout import TRIPS
    raw = trips(spark, SF_SMALL)
    prep = flow.prepare(raw, TRIPS, "lr")
    again = flow.apply_prepared(prep, raw)
    plan = again._jdf.queryExecution().executedPlan().toString()
    # four dictionary lookups and the per-day holiday table, all broadcast
    assert plan.count("BroadcastHashJoin") >= 5
    assert "PythonUDF" not in plan
    same_rows(prep.frame, again, prep.features + [TRIPS.label, TRIPS.split_key])
    # a carrier the fit never saw gets -1
    new = raw.limit(5).withColumn("carrier", F.lit("Unseen carrier"))
    got = {r["carrier"] for r in flow.apply_prepared(prep, new).collect()}
    assert got <= {-1}


def test_apply_prepared_with_dimension_scan_and_as_built(spark):
    from arrivo.functions.calendar import AS_BUILT
    from arrivo.layout import TRIPS
    raw = trips(spark, SF_SMALL)
    prep = flow.prepare(raw, TRIPS, "lr", dimension=vehicle_dimension(spark, SF_SMALL),
                        proximity_mode="scan", calendar=AS_BUILT)
    assert "model" in prep.features
    same_rows(prep.frame, flow.apply_prepared(prep, raw), prep.features + [TRIPS.label, TRIPS.split_key])
    near = flow.prepare(raw, TRIPS, "lr")
    sums = [p.frame.agg(F.sum("proximityToHoliday")).first()[0] for p in (prep, near)]
    assert sums[0] != sums[1]


def test_run_takes_mode_and_calendar(spark):
    from arrivo.functions.calendar import AS_BUILT
    res = flow.run(spark, flight_csv(spark), "rf", grid=SMALL, proximity_mode="scan", calendar=AS_BUILT)
    assert (res.prepared.proximity_mode, res.prepared.calendar) == ("scan", AS_BUILT)
    assert res.prepared.frame.agg(F.min("proximityToHoliday")).first()[0] < -366
