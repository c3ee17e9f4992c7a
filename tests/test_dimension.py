from pyspark.sql import functions as F

from arrivo.operators.enrich import enrich_from_csv, join_dimension, lookup
from arrivo.sources.tables import DIMENSION_HEADER

HEADER = ",".join(DIMENSION_HEADER)


def fact(spark):
    return spark.createDataFrame([("N1", 1), ("N2", 2), ("N3", 3), ("NA", 4)],
                                 "TailNum string, v int")


def dim_csv(tmp_path, header=HEADER, rows=None, name="dim.csv"):
    rows = rows if rows is not None else [
        "N1,t,m,d,A,s,a,T,y", "N2,t,m,d,,s,a,T,y", "N3,t,m,d,B,s,a,U,y", "N3,t,m,d,B2,s,a,U,y"]
    p = tmp_path / name
    p.write_text("\n".join([header] + rows) + "\n")
    return str(p)


def test_join_semantics(spark, tmp_path):
    res = enrich_from_csv(fact(spark), spark, dim_csv(tmp_path), "TailNum")
    assert res.reason is None
    assert sorted(res.frame.columns) == ["engine_type", "model", "v"]
    got = sorted(tuple(r) for r in res.frame.collect())
    assert got == [(1, "A", "T"), (3, "B", "U"), (3, "B2", "U")]


def test_trailing_name_passes(spark, tmp_path):
    rows = ["N1,t,m,d,A,s,a,T,y,extra"]
    res = enrich_from_csv(fact(spark), spark, dim_csv(tmp_path, HEADER + ",tenth", rows),
                          "TailNum")
    assert res.reason is None and res.frame.count() == 1


def test_fallbacks(spark, tmp_path):
    f = fact(spark)
    cases = [
        dim_csv(tmp_path, HEADER.replace("model", "modle"), name="a.csv"),
        dim_csv(tmp_path, ",".join(DIMENSION_HEADER[:8]), name="b.csv"),
        dim_csv(tmp_path, rows=["N1,t,m,d,,s,a,T,y"], name="c.csv"),
        str(tmp_path / "dim.txt"),
        str(tmp_path / "missing.csv"),
    ]
    for path in cases:
        res = enrich_from_csv(f, spark, path, "TailNum")
        assert res.reason is not None, path
        assert res.frame is f
    res = enrich_from_csv(f.withColumnRenamed("TailNum", "x"), spark, dim_csv(tmp_path), "TailNum")
    assert res.reason is not None


def test_join_dimension_shuffle_path(spark):
    d = spark.createDataFrame([("N1", "A", "T"), ("N3", "B", "U")],
                              "tailnum string, model string, engine_type string")
    res = join_dimension(fact(spark), d, "TailNum", broadcast_limit=0)
    assert sorted(tuple(r) for r in res.frame.collect()) == [(1, "A", "T"), (3, "B", "U")]


def test_lookup_policies(spark):
    f = spark.createDataFrame([("A",), ("B",), ("Z",)], "code_col string")
    d = spark.createDataFrame([("A", "x"), ("B", "y"), ("B", "w")], "code string, city string")
    import pytest

    from arrivo.operators.enrich import DuplicateKeyError
    with pytest.raises(DuplicateKeyError):
        lookup(f, "code_col", d, "city_out")
    first = sorted(tuple(r) for r in lookup(f, "code_col", d, "c", duplicates="smallest").collect())
    assert first == [("A", "x"), ("B", "w"), ("Z", None)]
    assert lookup(f, "code_col", d, "c", duplicates="all").count() == 4
    numbered = d.withColumn("no", (d.city == "w").cast("int"))
    for limit in (None, 0):
        last = lookup(f, "code_col", numbered, "c", duplicates="last", order="no", broadcast_limit=limit)
        assert sorted(tuple(r) for r in last.collect()) == [("A", "x"), ("B", "w"), ("Z", None)]


def test_join_dimension_salted_hot_key(spark):
    # N1 holds 60 % of the fact rows, all equal; the dimension is forced off
    # broadcast, so the hot key is salted. Repeated dimension keys still multiply.
    rows = [("N1", 1)] * 300 + [(f"K{i}", i) for i in range(200)]
    f = spark.createDataFrame(rows, "TailNum string, v int")
    d = spark.createDataFrame([("N1", "A", "T"), ("N1", "A2", "T"), ("K7", "B", "U")],
                              "tailnum string, model string, engine_type string")
    res = join_dimension(f.repartition(6), d, "TailNum", broadcast_limit=0, partitions=16)
    assert sorted(res.frame.columns) == ["engine_type", "model", "v"]
    got = res.frame.groupBy("model").count().collect()
    assert {r["model"]: r["count"] for r in got} == {"A": 300, "A2": 300, "B": 1}
    plan = res.frame._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


def test_key_of_three_percent_is_salted(spark):
    from pyspark.sql import functions as F

    from arrivo.operators.joins import hot_keys, salted_join
    big = spark.range(10_000).select(F.when(F.col("id") < 300, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), F.lit(1).alias("v"))
    freq = big.groupBy("k").count()
    assert hot_keys(freq, "k", "count", 10_000, 200) == ["hot"]
    assert hot_keys(freq, "k", "count", 10_000, 20) == []
    small = big.select(F.col("k").alias("key")).distinct()
    out = salted_join(big, F.col("k"), small, "key", ["hot"], 200, "left")
    assert out.count() == 10_000 and out.columns == ["k", "v", "key"]
    dealt = big.repartition(8).withColumn("s", F.pmod(F.xxhash64("k", "v") + F.spark_partition_id(), F.lit(200)))
    per = [r["count"] for r in dealt.filter("k = 'hot'").groupBy("s").count().collect()]
    assert len(per) == 8 and max(per) <= 80  # equal rows are spread over the partitions they come from


def test_rows_without_a_match_are_not_shuffled(spark):
    """One fact row in ten has its key in a dimension beyond the limit."""
    from arrivo.operators.joins import may_match, measured
    dim = spark.createDataFrame([(f"k{i}", f"m{i}", "e") for i in range(0, 20_000, 10)] + [(None, "m", "e")],
                                "tailnum string, model string, engine_type string")
    fact = spark.createDataFrame([(f"k{i}", i) for i in range(20_000)] + [(None, 1)], "v string, n int")
    some = may_match(fact, F.col("v"), dim, "tailnum", measured(dim)[0])
    hits = [int(r.v[1:]) for r in some.collect()]
    assert set(range(0, 20_000, 10)) <= set(hits) and len(hits) < 2000 + 2 * 18_000 / 16
    enr = join_dimension(fact, dim, "v", broadcast_limit=0, partitions=8)
    want = sorted((i, f"m{i}", "e") for i in range(0, 20_000, 10))
    assert sorted(map(tuple, enr.frame.select("n", "model", "engine_type").collect())) == want
    plan = enr.frame._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "bitmap_construct_agg" in plan
    # a filter beyond the threshold is left out, with the same result
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        enr = join_dimension(fact, dim, "v", broadcast_limit=0, partitions=8)
        assert "LeftSemi" not in enr.frame._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, enr.frame.select("n", "model", "engine_type").collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
