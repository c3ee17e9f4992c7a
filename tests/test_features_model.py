import math

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from arrivo.layout import FLIGHTS
from arrivo.operators.features import (add_interactions, add_squared_columns,
                                       append_scaled_squares, assemble)
from arrivo.plans.model import fit_scaler, hash_bucket, is_linear, rmse_expr


def test_scaled_squares_by_name(spark):
    df = spark.createDataFrame([(Vectors.dense([2.0, 3.0, 5.0]),)], ["scaledFeatures"])
    out = append_scaled_squares(df, ["x", "y", "depDelayTaxiOutInteraction"])
    assert list(out.first()["scaledFeatures"]) == [2, 3, 5, 4, 9]
    # without a proximity column the interaction is still not squared
    out2 = append_scaled_squares(df, ["depDelayTaxiOutInteraction", "x", "y"])
    assert list(out2.first()["scaledFeatures"]) == [2, 3, 5, 9, 25]


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "a double, b double")
    v = assemble(df, ["a", "b"])
    m = fit_scaler(v)
    got = [list(r[0]) for r in m.transform(v).select(vector_to_array("scaledFeatures")).collect()]
    assert got == [[-1.0, 0.0], [0.0, 0.0], [1.0, 0.0]]


def test_assemble_skips_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 3)], "a int, b int")
    assert assemble(df, ["a", "b"]).count() == 1


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "l double, p double")
    assert math.isclose(df.agg(rmse_expr("l", "p")).first()[0], 0.816497, abs_tol=1e-6)


def test_hash_bucket_matches_duckdb(spark):
    df = spark.createDataFrame([(42,)], "k long")
    assert df.select(hash_bucket(F.col("k"), 10000)).first()[0] == 4184


def test_algorithm_choice():
    assert is_linear("lr") and is_linear("LR")
    assert not is_linear("") and not is_linear("rf") and not is_linear(None)


def test_interactions_widen(spark):
    df = spark.createDataFrame([(2_000_000_000, 3, 1, 2, 5, 6)],
                               "DepDelay int, TaxiOut int, Origin int, Dest int, Month int, "
                               "DayofMonth int")
    r = add_interactions(df, FLIGHTS).first()
    assert r["depDelayTaxiOutInteraction"] == 6_000_000_000
    assert r["origDestInteraction"] == 2 and r["monthDayofMonthInteraction"] == 30
    assert r["depDelayOrigInteraction"] == 2_000_000_000
    only = add_interactions(df.drop("TaxiOut"), FLIGHTS)
    assert "depDelayTaxiOutInteraction" not in only.columns


def test_squared_columns(spark):
    df = spark.createDataFrame([(3, 4, 5)], "ArrDelay int, a int, fooInteraction int")
    out = add_squared_columns(df, "ArrDelay")
    assert out.columns == ["ArrDelay", "a", "fooInteraction", "aSquared"]
    assert out.first()["aSquared"] == 16
