"""Model search and hold-out score, checked by brute force on sf0.001."""

import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from arrivo.layout import TRIPS
from arrivo.plans import flow
from arrivo.plans.model import LR_ELASTIC_NET, LR_REG_PARAMS, Grid, grid_report, is_holdout
from arrivo.sources.tables import trips

from conftest import SF_SMALL


def test_linear_search_and_holdout(spark):
    prep = flow.prepare(trips(spark, SF_SMALL), TRIPS, "lr")
    res = flow.train_and_score(prep, "lr")
    report = grid_report(spark, res.cv_model, "lr").collect()
    assert len(report) == 9
    assert sorted((r["reg_param"], r["elastic_net"]) for r in report) == sorted(
        (a, b) for a in LR_REG_PARAMS for b in LR_ELASTIC_NET)
    best = min(report, key=lambda r: r["avg_rmse"])
    lr = res.cv_model.bestModel
    assert (lr.getRegParam(), lr.getElasticNetParam()) == (best["reg_param"], best["elastic_net"])

    # recompute the hold-out RMSE by hand from the scaled test vectors
    data = flow.model_input(prep)
    test = data.filter(is_holdout())
    scaled = flow.append_scaled_squares(res.scaler.transform(test), prep.features)
    rows = scaled.select(vector_to_array("scaledFeatures").alias("x"), TRIPS.label).collect()
    x = np.array([r["x"] for r in rows])
    y = np.array([r[TRIPS.label] for r in rows], dtype=float)
    pred = x @ lr.coefficients.toArray() + lr.intercept
    assert math.isclose(res.rmse, float(np.sqrt(np.mean((y - pred) ** 2))), rel_tol=1e-9)
    assert res.test_rows == len(rows) and res.train_rows > 50 * res.test_rows

    # the features explain the label: far better than the training mean
    mean = data.filter(~is_holdout()).agg(F.avg(TRIPS.label)).first()[0]
    assert res.rmse < 0.6 * float(np.sqrt(np.mean((y - mean) ** 2)))

    # the scaler's statistics come from the training rows only
    train = np.array([r[0] for r in data.filter(~is_holdout())
                      .select(vector_to_array("features")).collect()])
    assert np.allclose(res.scaler.mean.toArray(), train.mean(axis=0))
    assert np.allclose(res.scaler.std.toArray(), train.std(axis=0, ddof=1))


def test_forest_search_small_grid(spark):
    prep = flow.prepare(trips(spark, SF_SMALL), TRIPS, "rf")
    assert not any("Interaction" in f for f in prep.features)
    res = flow.train_and_score(prep, "rf", grid=Grid(rf_depths=(2, 4), rf_trees=(3,)))
    report = grid_report(spark, res.cv_model, "rf").collect()
    assert sorted((r["max_depth"], r["num_trees"]) for r in report) == [(2, 3), (4, 3)]
    best = min(report, key=lambda r: r["avg_rmse"])
    assert res.cv_model.bestModel.getMaxDepth() == best["max_depth"]
    assert res.vector_names == prep.features and res.rmse > 0


def test_grid_points_are_different_fits(spark):
    """Nine points, nine models: depth and number of trees reach the
    estimator, and the best one is fitted again on all training rows."""
    prep = flow.prepare(trips(spark, SF_SMALL), TRIPS, "rf")
    grid = Grid(rf_depths=(1, 2, 3), rf_trees=(1, 2, 3))
    res = flow.train_and_score(prep, "rf", grid=grid)
    report = grid_report(spark, res.cv_model, "rf").collect()
    assert len({round(r["avg_rmse"], 9) for r in report}) == 9
    by_depth = {d: sum(r["avg_rmse"] for r in report if r["max_depth"] == d) for d in (1, 2, 3)}
    assert by_depth[1] > by_depth[2] > by_depth[3]
    _, train, _ = flow.scaled_parts(prep, prep.features, squares=False)
    est = res.cv_model.getEstimator()
    seen = []
    for pm in res.cv_model.getEstimatorParamMaps():
        named = {p.name: v for p, v in pm.items()}
        model = est.copy(pm).fit(train)
        assert model.getNumTrees == named["numTrees"] and max(t.depth for t in model.trees) == named["maxDepth"]
        seen.append(model.toDebugString.split("\n", 1)[1])
    assert len(set(seen)) == 9
    best = min(range(9), key=lambda i: report[i]["avg_rmse"])
    assert res.cv_model.bestModel.toDebugString.split("\n", 1)[1] == seen[best]
