from pyspark.sql import functions as F

from arrivo.functions.casts import text_to_int
from arrivo.layout import FLIGHTS
from arrivo.operators.clean import (dedup_rows, dedup_to, drop_and_filter, drop_constant, drop_strings,
                                    row_signature, signature_groups, single_valued)

from conftest import exchanges


def test_text_to_int(spark):
    df = spark.createDataFrame([("NA",), (None,), ("12",), ("12.5",), (" 7 ",), ("",),
                                ("-3.9",)], "s string")
    got = [r[0] for r in df.select(text_to_int(F.col("s"))).collect()]
    assert got == [None, None, 12, 12, 7, None, -3]


def test_drop_and_filter(spark):
    df = spark.createDataFrame([(0, "a", "t", "u"), (1, "b", "t", "u"), (None, "c", "t", "u")],
                               "Cancelled int, Origin string, TailNum string, Bogus string")
    out = drop_and_filter(df, FLIGHTS, unknown=("Bogus",))
    assert out.columns == ["Origin"]
    assert [r[0] for r in out.collect()] == ["a"]


def test_drop_strings_and_constant(spark):
    df = spark.createDataFrame([(2008, 1, "x"), (2008, 2, "y")], "Year int, Month int, s string")
    assert drop_strings(df).columns == ["Year", "Month"]
    assert single_valued(df, ["Year", "Month", "Absent"]) == ["Year"]
    assert drop_constant(df, ["Year"]).columns == ["Month", "s"]


def repeated(spark):
    rows = [(i % 40, None if i % 3 else "x", float(i % 2) * -0.0, "NA" if i % 5 else None) for i in range(400)]
    rows += [(1, None, 0.0, "a")] * 300 + [(1, "a", 0.0, None), (1, None, -0.0, "a")]
    return spark.createDataFrame(rows, "a int, b string, c double, d string").repartition(4)


def test_dedup_by_signature_is_whole_row_distinct(spark):
    """Nulls in different columns, both zeros and a hot row."""
    df = repeated(spark)
    for kept in (["a"], ["d", "b"], df.columns):
        got, want = dedup_to(df, kept), dedup_rows(df).select(*kept)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert dedup_to(df.limit(0), ["a"]).count() == 0


def test_dedup_survives_colliding_signatures(spark):
    """Every row has the same signature, or one of two."""
    df = repeated(spark)
    for sign in (lambda d: [F.lit(1), F.lit(2)], lambda d: [F.col("a") % 2, F.lit(0)]):
        got, want = dedup_to(df, ["b"], sign), dedup_rows(df).select("b")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_dedup_by_signature_moves_kept_columns_only(spark):
    df = repeated(spark)
    signed = [c.alias(n) for c, n in zip(row_signature(df), ("__s1", "__s2"))]
    moved = exchanges(signature_groups(df, ["a"], signed))[-1]  # the grouping's is the last one
    assert "[a#" in moved.replace("__s1#", "").replace(" a#", "[a#") and not any(f" {c}#" in moved for c in "bcd")
