"""Plan tests: the properties that matter at scale."""

from arrivo.layout import TRIPS
from arrivo.operators.encode import DictSpec, fit_dictionaries
from arrivo.plans import flow
from arrivo.sources.tables import trips

from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    t = trips(spark, SF_SMALL).filter("trip_year = 1996").select("carrier", "origin")
    txt = plan_of(t)
    assert "PushedFilters" in txt
    li = [ln for ln in txt.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln]
    assert li and "l_comment" not in li[0] and "l_receiptdate" not in li[0]


def test_encode_is_broadcast_hash_join(spark):
    t = trips(spark, SF_SMALL)
    m = fit_dictionaries(t, [DictSpec("ap", ("origin", "dest"))])
    p = plan_of(m.transform(t))
    assert "BroadcastHashJoin" in p
    assert "PythonUDF" not in p and "BatchEvalPython" not in p


def test_prepared_plan_has_no_python(spark):
    prep = flow.prepare(trips(spark, SF_SMALL), TRIPS, "lr")
    p = prep.frame._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in p and "BatchEvalPython" not in p
    assert prep.frame.count() > 0
    assert TRIPS.label not in prep.features and "o_orderkey" not in prep.features


def test_prepared_frame_is_a_pruned_scan_and_is_deleted(spark):
    import os
    prep = flow.prepare(trips(spark, SF_SMALL), TRIPS, "lr")
    txt = plan_of(prep.frame.filter("distance > 5").select("distance"))
    assert "ReadSchema: struct<distance:int>" in txt and "PushedFilters: [IsNotNull(distance)" in txt
    paths = [f.removeprefix("file://") for df in [*prep.written, prep.dictionaries.codes] for f in df.inputFiles()]
    assert paths and all(os.path.exists(p) for p in paths)
    prep.close()
    assert not any(os.path.exists(os.path.dirname(p)) for p in paths)


def test_search_reads_three_columns(spark):
    prep = flow.prepare(trips(spark, SF_SMALL), TRIPS, "lr")
    _, train, test = flow.scaled_parts(prep, prep.features, True)
    assert train.columns == test.columns == [TRIPS.label, "fold", "scaledFeatures"]


def test_trips_shuffles_lineitem_side_twice_at_scale(spark):
    # emulate large tables: no size-based broadcast, no runtime re-plan
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan_of(trips(spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert p.count("hashpartitioning(l_") == 2
    small = plan_of(trips(spark, SF_SMALL))
    # with the default threshold the 25-row nation table is broadcast
    assert "hashpartitioning(n_nationkey" not in small and "hashpartitioning(c_nationkey" not in small


def test_dedup_of_a_hot_row_is_exact_and_pre_aggregated(spark):
    from arrivo.operators.clean import dedup_rows
    hot = [(1, "hot", "NA")] * 3000
    rest = [(i, f"k{i}", "x") for i in range(2, 6002)]
    df = spark.createDataFrame(hot + rest, "a int, b string, c string").repartition(4)
    out = dedup_rows(df)
    assert out.count() == 6001
    p = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in p
    phys = plan_of(out)
    # partial aggregation on the map side, then the final one after the shuffle
    assert phys.count("HashAggregate") >= 2
