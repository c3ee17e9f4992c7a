"""Fits stored and loaded in another session, and scored rows by run."""

import json

import pytest
from pyspark.sql import functions as F

from arrivo.layout import FLIGHTS, TRIPS
from arrivo.plans import flow, stored
from arrivo.plans.model import Grid
from arrivo.session import scratch_path, use_local_checkpoints
from arrivo.sources.tables import trips, vehicle_dimension

from conftest import SF_SMALL

SMALL = Grid(lr_reg=(0.1,), lr_elastic=(0.5,), rf_depths=(3,), rf_trees=(3,))


def rows_of(df, cols):
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def fit(spark):
    raw = trips(spark, SF_SMALL)
    prep = flow.prepare(raw, TRIPS, "lr", dimension=vehicle_dimension(spark, SF_SMALL), proximity_mode="scan")
    return raw, prep, flow.train_and_score(prep, "lr", grid=SMALL)


def test_load_in_another_session(spark, fit):
    raw, prep, scored = fit
    path = scratch_path(spark, "fit")
    stored.save_fit(prep, path, scored)
    want = rows_of(flow.apply_prepared(prep, raw), prep.features)
    other = spark.newSession()
    use_local_checkpoints(other)
    held = stored.load_fit(other, path)
    p = held.prepared
    assert (p.features, p.layout, p.policy, p.algorithm, p.proximity_mode, p.calendar) == (
        prep.features, prep.layout, prep.policy, prep.algorithm, prep.proximity_mode, prep.calendar)
    assert (p.dictionaries.sizes, p.dictionaries.totals, p.dictionaries.bytes) == (
        prep.dictionaries.sizes, prep.dictionaries.totals, prep.dictionaries.bytes)
    new = trips(other, SF_SMALL)
    assert rows_of(flow.apply_prepared(p, new), p.features) == want
    # the stored model scores the hold-out rows as the first session did
    again = held.score(new).join(stored.holdout_predictions(prep, scored).select("row_key").distinct(), "row_key")
    assert rows_of(again, ["row_key", "label", F.round("prediction", 9)]) == rows_of(
        stored.holdout_predictions(prep, scored), ["row_key", "label", F.round("prediction", 9)])
    with pytest.raises(Exception, match="exists"):
        stored.save_fit(prep, path)


def test_fit_without_model_and_other_version(spark, fit):
    raw, prep, _ = fit
    path = scratch_path(spark, "fit")
    stored.save_fit(prep, path)
    held = stored.load_fit(spark, path)
    with pytest.raises(stored.StoredFitError):
        held.score(raw)
    text = json.loads(spark.read.text(f"{path}/fit", wholetext=True).first()[0])
    text["version"] += 1
    spark.createDataFrame([(json.dumps(text),)], "value string").write.mode("overwrite").text(f"{path}/fit")
    with pytest.raises(stored.StoredFitError):
        stored.load_fit(spark, path)


def test_scored_rows_by_run(spark, fit):
    _, prep, scored = fit
    path = scratch_path(spark, "scored")
    rows = stored.holdout_predictions(prep, scored)
    for run in ("a", "b", "a"):
        stored.write_scored(rows, path, run)
    kept = stored.read_scored(spark, path)
    assert {r.run_id: r["count"] for r in kept.groupBy("run_id").count().collect()} == {
        "a": scored.test_rows, "b": scored.test_rows}
    got = stored.read_scored(spark, path, "a").agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0]
    assert got == pytest.approx(scored.rmse, rel=1e-12)
    with pytest.raises(ValueError):
        stored.write_scored(rows, path, "../a")


def test_flight_program_is_stored(spark):
    """No split key, dedup by signature: rows are keyed by their hash."""
    from test_program import flight_csv
    res = flow.run(spark, flight_csv(spark), "rf", grid=SMALL)
    assert res.prepared.layout == FLIGHTS
    path = scratch_path(spark, "fit")
    stored.save_fit(res.prepared, path, res.scored)
    rows = stored.holdout_predictions(res.prepared, res.scored)
    assert rows.count() == res.scored.test_rows
    assert rows.agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0] == pytest.approx(
        res.scored.rmse, rel=1e-9)
    assert stored.load_fit(spark, path).cv_model.bestModel.getNumTrees == 3
