"""Registered queries: one per operator group of the inventory, each a
function ``(spark, sf_dir) -> DataFrame`` over the driver tables mapped to
the trip shape. Matching DuckDB SQL lives in :mod:`arrivo.plans.oracle`."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.functions.calendar import AS_BUILT, CORRECTED, calendar_frame
from arrivo.functions.holidays import add_proximity, date_key, distinct_years, row_date
from arrivo.layout import TRIPS
from arrivo.operators.clean import (cast_text_columns, dedup_rows, dedup_to, drop_and_filter,
                                    drop_constant, drop_strings, keep_not_cancelled)
from arrivo.operators.encode import DictSpec, fit_dictionaries
from arrivo.operators.enrich import enrich_from_csv, join_dimension, lookup
from arrivo.operators.features import (add_interactions, add_squared_columns, assemble,
                                       squared_feature_names)
from arrivo.operators.missing import fit_missing_policy, missing_profile
from arrivo.plans import flow, stored
from arrivo.plans.model import (LR_ELASTIC_NET, LR_REG_PARAMS, REFERENCE_GRID, Grid, grid_report,
                                is_holdout, rmse_expr, with_buckets)
from arrivo.session import cut_lineage, scratch_path
from arrivo.sources.contract import scan_contract, scan_rejects
from arrivo.sources.tables import (DIMENSION_HEADER, TRIPS_CONTRACT, place_lookup, trips,
                                   vehicle_dimension)

L = TRIPS


def q_contract_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Trips written as two CSV folders with different column orders
    (and one column outside the contract whose header needs normalising),
    read back through the contract."""
    t = trips(spark, sf).withColumn("extra-code", F.col("cancel_code"))
    halves = [t.filter(F.col("o_orderkey") % 2 == i) for i in (0, 1)]
    paths = []
    for half, columns in zip(halves, (t.columns, t.columns[::-1])):
        paths.append(scratch_path(spark, "trips") + ".csv")
        half.select(*[F.col(f"`{c}`") for c in columns]).write.option("header", True).csv(paths[-1])
    scan = scan_contract(spark, paths, TRIPS_CONTRACT, required=(L.cancelled, L.label))
    assert scan.unknown_columns == ("extracode",), scan.unknown_columns
    return scan.frame


def q_scan_rejects(spark, sf):
    """Lines that end early, have a surplus field or a text where a
    number belongs, in four CSV folders."""
    t, key = trips(spark, sf), F.col("o_orderkey")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in t.columns]
    fields[t.columns.index("distance")] = F.when(key % 83 == 2, "far").otherwise(F.col("distance").cast("string"))
    line = F.when(key % 97 == 0, F.concat_ws(",", *fields[:10])).when(
        key % 89 == 1, F.concat_ws(",", *fields, F.lit("surplus"))).otherwise(F.concat_ws(",", *fields))
    # one folder for each value of part: the header names the only column of
    # what is written, so every task's file begins with it and nothing is
    # shuffled; a separator that no line holds and no quotes leave lines as they are
    header = ",".join(t.columns)
    path = scratch_path(spark, "lines")
    part = F.concat(key % 4, F.lit(".csv")).alias("part")
    t.select(part, line.alias(header)).write.partitionBy("part").options(
        header=True, sep="\u0001", quote="\u0000", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False).csv(path)
    # a folder without rows has its header as well
    spark.range(4).select(F.concat("id", F.lit(".csv")).alias("part"), F.lit(header).alias("value")).write.mode(
        "append").partitionBy("part").text(path)
    return scan_rejects(spark, [f"{path}/part={i}.csv" for i in range(4)], TRIPS_CONTRACT, (L.cancelled, L.label))


def _repeated_trips(spark, sf):
    twice = F.when(F.col(L.taxi_out).isin("1", "4"), 2).otherwise(1)
    return trips(spark, sf).withColumn("__copy", F.explode(F.sequence(F.lit(1), twice))).drop("__copy")


def q_dedup_rows(spark, sf):
    """P1 over whole rows, some of which are repeated."""
    return dedup_rows(_repeated_trips(spark, sf))


def q_dedup_signature(spark, sf):
    """P1 by row signature, shuffling the kept columns only."""
    return dedup_to(_repeated_trips(spark, sf), ["trip_month", "carrier", "origin", "taxi_out"])


def q_drop_and_filter(spark, sf):
    """An unknown column goes as well."""
    return drop_and_filter(trips(spark, sf).withColumn("extracode", F.col("carrier")), L, ("extracode",))


def q_missing_profile(spark, sf):
    return missing_profile(trips(spark, sf))


def _cut_trips(spark, sf):
    """Trips as a written table, for queries that fit and then transform."""
    return cut_lineage(trips(spark, sf), "trips")


def _filtered(spark, sf):
    return cut_lineage(drop_and_filter(trips(spark, sf), L), "filtered")


def q_missing_decisions(spark, sf):
    df = _filtered(spark, sf)
    return fit_missing_policy(df, protected=L.protected()).decisions_frame(spark)


def q_missing_policy(spark, sf):
    df = _filtered(spark, sf)
    return fit_missing_policy(df, protected=L.protected()).transform(df)


def q_cast_text_to_int(spark, sf):
    return cast_text_columns(trips(spark, sf), L.text_to_int)


def q_date_key(spark, sf):
    t = trips(spark, sf)
    y, m, d = F.col(L.year), F.col(L.month), F.col(L.day)
    return t.select(y, m, d, date_key(y, m, d).alias("date_key"),
                    row_date(y, m, d).alias("trip_date"))


def _dimension_csv(spark, sf) -> str:
    path = scratch_path(spark, "vehicles") + ".csv"
    vehicle_dimension(spark, sf).select(*DIMENSION_HEADER).write.option("header", True).csv(path)
    return path


def q_dim_join(spark, sf):
    """Dimension CSV checked, scanned, joined."""
    enr = enrich_from_csv(trips(spark, sf), spark, _dimension_csv(spark, sf), L.vehicle,
                          L.dim_key, (L.dim_model, L.dim_engine))
    if enr.reason:
        raise RuntimeError(enr.reason)
    return enr.frame


def q_dim_join_salted(spark, sf):
    """J1 beyond the broadcast limit: hot keys are salted."""
    t = trips(spark, sf).select("o_orderkey", L.vehicle, L.taxi_out)
    return join_dimension(t, vehicle_dimension(spark, sf), L.vehicle, L.dim_key, (L.dim_model, L.dim_engine),
                          broadcast_limit=0, partitions=128).frame


def q_dim_lookup_salted(spark, sf):
    """S10 beyond the broadcast limit, and the last of repeated codes."""
    t = trips(spark, sf).select("o_orderkey", "dest")
    places = place_lookup(spark, sf)
    twice = places.select("code", "city", F.lit(1).alias("no")).unionByName(
        places.filter(F.col("city") == "ASIA").select("code", F.lit("later").alias("city"), F.lit(2).alias("no")))
    return lookup(t, "dest", twice, "dest_city", duplicates="last", order="no", broadcast_limit=0, partitions=128)


def q_dim_lookup_unmatched(spark, sf):
    """S10 beyond the broadcast limit; codes without a match give null."""
    t = trips(spark, sf).select("o_orderkey", "origin", "dest")
    places = place_lookup(spark, sf).filter(F.col("city").isin("ASIA", "EUROPE"))
    return lookup(t, "dest", places, "dest_city", broadcast_limit=0, partitions=128)


def q_dim_lookup(spark, sf):
    t = trips(spark, sf).select("o_orderkey", "trip_year", "origin", "dest")
    places = place_lookup(spark, sf)
    out = lookup(t, "origin", places, "origin_city")
    return lookup(out, "dest", places, "dest_city")


AIRPORT = DictSpec("airport", (L.origin, L.dest))


def q_category_keys(spark, sf):
    return fit_dictionaries(trips(spark, sf), [AIRPORT]).keys("airport")


def _encode(spark, sf, spec):
    t = _cut_trips(spark, sf)
    return fit_dictionaries(t, [spec]).transform(t)


def q_encode_shared(spark, sf):
    return _encode(spark, sf, AIRPORT)


def q_encode_single(spark, sf):
    return _encode(spark, sf, DictSpec("carrier", (L.carrier,)))


def q_encode_one_airport(spark, sf):
    """E1 where only one of the two airport columns is present."""
    t = _cut_trips(spark, sf).drop(L.origin)
    return fit_dictionaries(t, [AIRPORT]).transform(t).select("o_orderkey", L.dest, L.taxi_out)


def q_encode_salted(spark, sf):
    """J3 beyond the broadcast limit: hot carriers are salted."""
    t = _cut_trips(spark, sf).select("o_orderkey", L.carrier, L.origin, L.dest)
    return fit_dictionaries(t, [AIRPORT, DictSpec("carrier", (L.carrier,))], broadcast_limit=0,
                            partitions=128).transform(t)


def q_encode_unseen_salted(spark, sf):
    """J3, E1-E4 beyond the broadcast limit: all columns in one long join;
    keys that the fit never saw get -1."""
    t = _cut_trips(spark, sf).select("o_orderkey", L.carrier, L.origin, L.dest, L.route, "cancel_code", L.vehicle)
    specs = [AIRPORT, DictSpec("carrier", (L.carrier,)), DictSpec("route", (L.route,)),
             DictSpec("cancel", ("cancel_code",)), DictSpec("vehicle", (L.vehicle,))]
    fitted = fit_dictionaries(t.filter(F.col(L.dest) < "NATION_2"), specs, broadcast_limit=0, partitions=128)
    return fitted.transform(t)


def q_encode_int_key(spark, sf):
    return _encode(spark, sf, DictSpec("route", (L.route,)))


def q_encode_dim(spark, sf):
    df = cut_lineage(q_dim_join(spark, sf), "joined")
    return fit_dictionaries(df, [DictSpec("model", (L.dim_model,)),
                                 DictSpec("engine_type", (L.dim_engine,))]).transform(df)


def q_holiday_calendar(spark, sf):
    years = trips(spark, sf).select(L.year).distinct()
    return calendar_frame(years, L.year, CORRECTED)


def q_holiday_calendar_as_built(spark, sf):
    """The as-built rules; dates they cannot give are null."""
    years = distinct_years(trips(spark, sf), L.year)
    return calendar_frame(years, "year", AS_BUILT)


def _proximity(spark, sf, mode):
    t = cut_lineage(trips(spark, sf).select(L.year, L.month, L.day), "dates")
    return add_proximity(t, L.year, L.month, L.day, "proximity", mode=mode, drop_single_year=False)


def q_holiday_nearest(spark, sf):
    return _proximity(spark, sf, "nearest")


def q_holiday_scan(spark, sf):
    return _proximity(spark, sf, "scan")


def _interactions(spark, sf):
    t = cast_text_columns(_cut_trips(spark, sf), L.text_to_int)
    t = fit_dictionaries(t, [AIRPORT]).transform(t)
    return add_interactions(t, L).select(
        "o_orderkey", L.label, L.month, L.day, L.dep_delay, L.taxi_out, L.origin, L.dest,
        *L.interactions)


def q_interactions(spark, sf):
    return _interactions(spark, sf)


def q_squares_columns(spark, sf):
    return add_squared_columns(_interactions(spark, sf), L.label, exclude=("o_orderkey",))


def q_drop_strings(spark, sf):
    return drop_strings(cast_text_columns(trips(spark, sf), L.text_to_int))


def q_drop_constant(spark, sf):
    t = keep_not_cancelled(trips(spark, sf), L.cancelled)
    return drop_constant(t, [L.year, L.cancelled])


def _prepared(spark, sf, algorithm="lr"):
    return flow.prepare(trips(spark, sf), L, algorithm)


def q_assemble(spark, sf):
    prep = _prepared(spark, sf)
    data = flow.model_input(prep)
    arr = vector_to_array(F.col("features"))
    return data.select("o_orderkey", L.label,
                       *[arr[i].alias(f) for i, f in enumerate(prep.features)])


def q_assemble_skips(spark, sf):
    """rows with a null feature (a text that is no number, a missing
    schedule) are skipped."""
    t = cast_text_columns(trips(spark, sf), L.text_to_int)
    out = assemble(t, [L.dep_delay, "sched_minutes", "distance"])
    return out.select("o_orderkey", L.taxi_out, L.dep_delay, "sched_minutes", "distance")


APPLIED = ("o_orderkey", L.label, L.origin, L.dest, "distance", L.taxi_out, L.dim_model, L.proximity)


def _first_places(spark, sf, t):
    return flow.prepare(t.filter(F.col(L.dest) < "NATION_2"), L, "lr", dimension=vehicle_dimension(spark, sf))


def q_apply_fitted(spark, sf):
    """A preparation fitted on trips to the first places,
    with the dimension, applied to all trips; unseen keys get -1."""
    t = trips(spark, sf)
    return flow.apply_prepared(_first_places(spark, sf, t), t).select(*APPLIED)


def q_apply_stored(spark, sf):
    """The same fit, stored, dropped, loaded and applied."""
    t = trips(spark, sf)
    path = scratch_path(spark, "fit")
    prep = _first_places(spark, sf, t)
    stored.save_fit(prep, path)
    prep.close()
    return flow.apply_prepared(stored.load_fit(spark, path).prepared, t).select(*APPLIED)


def q_hash_split(spark, sf):
    orders = with_buckets(trips(spark, sf).select("o_orderkey").distinct(), "o_orderkey")
    return orders.select("o_orderkey", "bucket", F.when(is_holdout(), "test").otherwise("train").alias("split"))


def q_cv_folds(spark, sf):
    orders = with_buckets(trips(spark, sf).select("o_orderkey").distinct(), "o_orderkey")
    return orders.filter(~is_holdout()).select("o_orderkey", "fold")


def q_standard_scale(spark, sf):
    prep = _prepared(spark, sf)
    scaler, _, _ = flow.scaled_parts(prep, prep.features, squares=False)
    rows = [(i, f, float(m), float(s)) for i, (f, m, s) in
            enumerate(zip(prep.features, scaler.mean.toArray(), scaler.std.toArray()))]
    prep.close()
    df = spark.createDataFrame(rows, "position int, feature string, mean double, std double")
    return df.select("position", "feature", F.round("mean", 4).alias("mean"),
                     F.round("std", 4).alias("std"))


def q_scaled_squares(spark, sf):
    """E12 on the training rows."""
    prep = _prepared(spark, sf)
    _, train, _ = flow.scaled_parts(prep, prep.features, squares=True)
    names = squared_feature_names(prep.features)
    arr = vector_to_array(F.col("scaledFeatures"))
    sums = train.agg(*[F.sum(arr[i]).alias(f"s{i}") for i in range(len(names))])
    stack = ", ".join(f"{i}, '{n}', s{i}" for i, n in enumerate(names))
    return sums.selectExpr(f"stack({len(names)}, {stack}) AS (position, feature, total)") \
        .select("position", "feature", (F.round("total", 4) + F.lit(0.0)).alias("total"))


def q_rmse(spark, sf):
    """A6 with a mean predictor: the training mean of the label scored on
    the hold-out rows."""
    data = flow.model_input(_prepared(spark, sf))
    mean = data.filter(~is_holdout()).agg(F.avg(L.label)).first()[0]
    return data.filter(is_holdout()).withColumn("prediction", F.lit(mean)).agg(
        F.round(rmse_expr(L.label, "prediction"), 6).alias("rmse"), F.count(F.lit(1)).alias("test_rows"))


def _scored(spark, sf, algorithm, grid=REFERENCE_GRID, **options):
    prep = _prepared(spark, sf, algorithm)
    scored = flow.train_and_score(prep, algorithm, grid=grid, **options)
    prep.close()
    return scored


#: One linear feature, squares off, no penalty: plain least squares.
ONE = {"features": [L.taxi_out], "squares": False}
PLAIN = Grid(lr_reg=(0.0,), lr_elastic=(0.0,))


def q_lr_fit(spark, sf):
    """K5: slope and intercept of least squares on one scaled feature."""
    model = _scored(spark, sf, "lr", PLAIN, **ONE).cv_model.bestModel
    return spark.createDataFrame([(round(float(model.coefficients[0]), 6), round(float(model.intercept), 6))],
                                 "slope double, intercept double")


def q_lr_elastic(spark, sf):
    """K5, K6: the coefficient of one scaled feature at each grid point."""
    rows = []
    prep = _prepared(spark, sf)
    parts = flow.training_parts(prep, "lr", **ONE)
    for reg in LR_REG_PARAMS:
        for mix in LR_ELASTIC_NET:
            grid = Grid(lr_reg=(reg,), lr_elastic=(mix,))
            model = flow.train_and_score(prep, "lr", grid, parts=parts, **ONE).cv_model.bestModel
            rows.append((reg, mix, round(float(model.coefficients[0]), 3), round(float(model.intercept), 3)))
    parts.close()
    prep.close()
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, slope double, intercept double")


def q_cv_mean_rmse(spark, sf):
    """K9: a penalty so large that each fold predicts its training mean."""
    scored = _scored(spark, sf, "lr", Grid(lr_reg=(1e6,), lr_elastic=(1.0,)), **ONE)
    return grid_report(spark, scored.cv_model, "lr").select(F.round("avg_rmse", 5).alias("avg_rmse"))


def q_rf_stump(spark, sf):
    """K7: one tree of depth 1 on all rows of one feature is the best split."""
    prep = _prepared(spark, sf, "rf")
    grid = Grid(rf_depths=(1,), rf_trees=(1,), bootstrap=False)
    scored = flow.train_and_score(prep, "rf", grid, features=[L.dep_delay])
    values = flow.model_input(prep, [L.dep_delay]).select(L.dep_delay, "features").dropDuplicates([L.dep_delay])
    out = scored.cv_model.transform(scored.scaler.transform(values))
    return out.select(L.dep_delay, F.round("prediction", 6).alias("prediction"))


def q_rf_two_levels(spark, sf):
    """K7: one tree of depth 2 on all rows of two features is the best split
    and then the best split of each side."""
    prep = _prepared(spark, sf, "rf")
    grid = Grid(rf_depths=(2,), rf_trees=(1,), bootstrap=False)
    two = [L.dep_delay, L.taxi_out]
    scored = flow.train_and_score(prep, "rf", grid, features=two)
    values = flow.model_input(prep, two).select(*two, "features").dropDuplicates(two)
    out = scored.cv_model.transform(scored.scaler.transform(values))
    return out.select(*two, F.round("prediction", 6).alias("prediction"))


def q_scored_rows(spark, sf):
    """A stored model scores the hold-out rows; they are written
    under a run id, twice, and read back."""
    prep = _prepared(spark, sf)
    scored = flow.train_and_score(prep, "lr", PLAIN, **ONE)
    path = scratch_path(spark, "scored")
    for _ in range(2):
        stored.write_scored(stored.holdout_predictions(prep, scored), path, "first-run")
    prep.close()
    rows = stored.read_scored(spark, path)
    return rows.groupBy("run_id").agg(F.round(rmse_expr("label", "prediction"), 5).alias("rmse"),
                                      F.count(F.lit(1)).alias("test_rows"), F.min("row_key").alias("least_key"))


def q_score_one_feature(spark, sf):
    """Hold-out score of least squares on one feature."""
    m = _scored(spark, sf, "lr", PLAIN, **ONE).metrics(spark)
    return m.withColumn("rmse", F.round("rmse", 5))


def _grid(spark, sf, algorithm):
    return grid_report(spark, _scored(spark, sf, algorithm).cv_model, algorithm)


def q_lr_grid_cv(spark, sf):
    return _grid(spark, sf, "lr")


def q_rf_grid_cv(spark, sf):
    return _grid(spark, sf, "rf")


def q_score_holdout(spark, sf):
    """The whole program, linear algorithm."""
    return _scored(spark, sf, "lr").metrics(spark)


QUERIES = {
    "contract_scan": q_contract_scan,
    "scan_rejects": q_scan_rejects,
    "dedup_rows": q_dedup_rows,
    "dedup_signature": q_dedup_signature,
    "drop_and_filter": q_drop_and_filter,
    "missing_profile": q_missing_profile,
    "missing_decisions": q_missing_decisions,
    "missing_policy": q_missing_policy,
    "cast_text_to_int": q_cast_text_to_int,
    "date_key": q_date_key,
    "dim_join": q_dim_join,
    "dim_join_salted": q_dim_join_salted,
    "dim_lookup": q_dim_lookup,
    "dim_lookup_salted": q_dim_lookup_salted,
    "dim_lookup_unmatched": q_dim_lookup_unmatched,
    "category_keys": q_category_keys,
    "encode_shared": q_encode_shared,
    "encode_single": q_encode_single,
    "encode_one_airport": q_encode_one_airport,
    "encode_salted": q_encode_salted,
    "encode_unseen_salted": q_encode_unseen_salted,
    "encode_int_key": q_encode_int_key,
    "encode_dim": q_encode_dim,
    "holiday_calendar": q_holiday_calendar,
    "holiday_calendar_as_built": q_holiday_calendar_as_built,
    "holiday_nearest": q_holiday_nearest,
    "holiday_scan": q_holiday_scan,
    "interactions": q_interactions,
    "squares_columns": q_squares_columns,
    "drop_strings": q_drop_strings,
    "drop_constant": q_drop_constant,
    "assemble": q_assemble,
    "assemble_skips": q_assemble_skips,
    "apply_fitted": q_apply_fitted,
    "apply_stored": q_apply_stored,
    "hash_split": q_hash_split,
    "cv_folds": q_cv_folds,
    "standard_scale": q_standard_scale,
    "scaled_squares": q_scaled_squares,
    "rmse": q_rmse,
    "lr_fit": q_lr_fit,
    "lr_elastic": q_lr_elastic,
    "cv_mean_rmse": q_cv_mean_rmse,
    "rf_stump": q_rf_stump,
    "rf_two_levels": q_rf_two_levels,
    "score_one_feature": q_score_one_feature,
    "scored_rows": q_scored_rows,
    "lr_grid_cv": q_lr_grid_cv,
    "rf_grid_cv": q_rf_grid_cv,
    "score_holdout": q_score_holdout,
}
