from pyspark.sql import functions as F

from arrivo.operators.encode import DictSpec, fit_dictionaries

from conftest import exchanges


def codes(model, name):
    return {r["key"]: r["code"] for r in model.keys(name).collect()}


def test_shared_and_single(spark):
    df = spark.createDataFrame([("B", "C"), ("A", "A")], "Origin string, Dest string")
    m = fit_dictionaries(df, [DictSpec("ap", ("Origin", "Dest"))])
    assert codes(m, "ap") == {"A": 0, "B": 1, "C": 2}
    only = fit_dictionaries(df.select("Dest"), [DictSpec("ap", ("Origin", "Dest"))])
    assert codes(only, "ap") == {"A": 0, "C": 1}


def test_int_keys_sorted_as_text(spark):
    df = spark.createDataFrame([(9,), (10,), (100,)], "FlightNum int")
    m = fit_dictionaries(df, [DictSpec("f", ("FlightNum",))])
    assert codes(m, "f") == {"10": 0, "100": 1, "9": 2}
    out = m.transform(df)
    assert sorted(tuple(r) for r in out.collect()) == [(0,), (1,), (2,)]


def test_unseen_and_null_get_minus_one(spark):
    train = spark.createDataFrame([("A",), ("B",)], "c string")
    new = spark.createDataFrame([("B",), ("Q",), (None,)], "c string")
    m = fit_dictionaries(train, [DictSpec("d", ("c",))])
    assert [r[0] for r in m.transform(new).collect()] == [1, -1, -1]


def test_numbering_many_partitions(spark):
    keys = [f"k{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(k, k[::-1]) for k in keys], "a string, b string")
    m = fit_dictionaries(df, [DictSpec("x", ("a",)), DictSpec("y", ("b",))])
    cx, cy = codes(m, "x"), codes(m, "y")
    assert cx == {k: i for i, k in enumerate(sorted(keys))}
    assert cy == {k: i for i, k in enumerate(sorted(k[::-1] for k in keys))}


def test_large_dictionary_salted_path(spark):
    # one hot key holds a third of the rows; the dictionary is forced off broadcast
    rows = [("hot",)] * 300 + [(f"c{i}",) for i in range(600)]
    df = spark.createDataFrame(rows, "c string")
    small = fit_dictionaries(df, [DictSpec("d", ("c",))])
    big = fit_dictionaries(df, [DictSpec("d", ("c",))], broadcast_limit=0, partitions=8)
    a = sorted(r[0] for r in small.transform(df).collect())
    b = sorted(r[0] for r in big.transform(df).collect())
    assert a == b and len(b) == 900
    plan = big.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan


def six_columns(spark):
    rows = [(i, f"pay{i}", "hot" if i % 3 else f"a{i}", f"a{i % 7}", None if i % 5 == 0 else f"b{i % 11}", i % 13,
             f"c{i % 2}", f"c{i % 3}") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, payload string, a1 string, a2 string, b string, n int, c1 string, c2 string")
    return df, [DictSpec("a", ("a1", "a2")), DictSpec("b", ("b",)), DictSpec("n", ("n",)), DictSpec("c", ("c1", "c2"))]


def test_long_form_equals_broadcast(spark):
    df, specs = six_columns(spark)
    fit = df.filter("id % 4 = 0")
    want = fit_dictionaries(fit, specs).transform(df, skip=("n",))
    big = fit_dictionaries(fit, specs, broadcast_limit=0, partitions=8)
    got = big.transform(df, skip=("n",))
    assert got.schema == want.schema
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.filter("a1 = -1").count() > 0 and got.filter("b = -1").count() > 0
    big.close()


def test_long_form_moves_wide_rows_once(spark):
    df, specs = six_columns(spark)
    big = fit_dictionaries(df, specs, broadcast_limit=0, partitions=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = exchanges(big.transform(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        big.close()
    assert sum("payload" in cols for cols in moved) == 1 and len(moved) >= 3


def test_codes_survive_reading_again(spark):
    """Codes are numbered from written rows, so every read gives the same."""
    df = spark.createDataFrame([(f"k{i % 500:03d}",) for i in range(5000)], "c string").repartition(7)
    m = fit_dictionaries(df, [DictSpec("d", ("c",))])
    first, again = codes(m, "d"), codes(m, "d")
    assert first == again == {f"k{i:03d}": i for i in range(500)}
    assert (m.sizes, m.totals) == ({"d": 500}, {"d": 5000})
    assert m.codes.agg(F.sum("freq")).first()[0] == 5000
