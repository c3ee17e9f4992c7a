"""What keeps shuffled and written bytes in step with the input."""

import glob

from pyspark.sql import functions as F

from arrivo.layout import TRIPS
from arrivo.operators.clean import dedup_in_order, dedup_rows
from arrivo.operators.encode import DictSpec, fit_dictionaries
from arrivo.operators.joins import BITMAP_BITS, filter_maps
from arrivo.plans import flow, queries
from arrivo.session import checkpoint_root, use_local_checkpoints
from arrivo.sources.tables import trips

from conftest import SF_SMALL, exchanges


def _large(spark, run, limit="20000"):
    """``run()`` where only suppliers and nations are small."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return run()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_trips_move_line_items_once_and_distinct_moves_nothing(spark):
    moved = _large(spark, lambda: exchanges(trips(spark, SF_SMALL)))
    assert sum("l_orderkey" in m for m in moved) == 1
    assert not any("l_suppkey" in m and "l_orderkey" not in m or "l_extendedprice" in m or "n_name" in m for m in moved)
    assert len(_large(spark, lambda: exchanges(dedup_rows(trips(spark, SF_SMALL))))) == len(moved)


def test_repeated_trips_read_line_items_once(spark):
    t = queries._repeated_trips(spark, SF_SMALL)
    text = t._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("l_shipdate") and sum("l_orderkey" in ln and "Relation" in ln for ln in text.splitlines()) == 1
    twice = trips(spark, SF_SMALL).filter(F.col("taxi_out").isin("1", "4")).count()
    assert t.count() == trips(spark, SF_SMALL).count() + twice


def test_one_large_dictionary_is_joined_without_long_form(spark):
    rows = [(i, "ab"[i % 2], f"key{i % 300}" if i % 7 else None, "hot") for i in range(1200)]
    df = spark.createDataFrame(rows, "id int, small string, large string, other string")
    specs = [DictSpec("small", ("small",)), DictSpec("large", ("large",)), DictSpec("other", ("other",))]
    fitted = fit_dictionaries(df.filter("id < 1000"), specs, broadcast_limit=200, partitions=4)
    assert fitted.bytes > 200 and fitted.sized["small"] + fitted.sized["other"] <= 200
    out = fitted.transform(df)
    assert not fitted.written       # no frame written with row numbers
    codes = {k: i for i, k in enumerate(sorted({r[2] for r in rows[:1000] if r[2]}))}
    assert sorted(map(tuple, out.collect())) == sorted((i, "ab".index(s), codes.get(k, -1), 0) for i, s, k, _ in rows)
    # one key holds nearly all rows: salted, with the same codes
    hot = df.withColumn("large", F.when(F.col("id") % 10 == 0, F.col("large")).otherwise("hot"))
    fitted = fit_dictionaries(hot, [DictSpec("large", ("large",))], broadcast_limit=0, partitions=4)
    want = {k: i for i, k in enumerate(sorted(r[0] for r in hot.select("large").distinct().collect() if r[0]))}
    got = fitted.transform(hot).join(hot.select("id", F.col("large").alias("was")), "id").collect()
    assert len(got) == 1200 and all(r["large"] == want.get(r["was"], -1) for r in got)


def test_key_filter_takes_fewer_bits_before_it_is_given_up():
    full = 10 * BITMAP_BITS // 16
    size = BITMAP_BITS // 8
    assert [filter_maps(full, n * size) for n in (10, 9, 5, 4, 3, 2)] == [10, 5, 5, 3, 3, 0]
    assert filter_maps(1, -1) == 0


def test_lines_to_scan_are_written_by_all_tasks(spark):
    use_local_checkpoints(spark)
    root = checkpoint_root(spark) + "/arrivo-scratch/lines-*"
    before = set(glob.glob(root))
    out = queries.q_scan_rejects(spark, SF_SMALL)
    new, = set(glob.glob(root)) - before
    files = glob.glob(new + "/part=0.csv/part-*")
    # a file of rows by each task and the header of a folder without rows
    assert len(files) >= 2
    header = ",".join(trips(spark, SF_SMALL).columns)
    assert all(open(f).readline().rstrip("\n") == header for f in files)
    assert sum(len(open(f).readlines()) - 1 for f in files) == trips(spark, SF_SMALL).filter("o_orderkey % 4 = 0").count()
    assert out.count()


def test_applied_rows_are_read_from_a_written_table(spark):
    out = queries.q_apply_fitted(spark, SF_SMALL)
    assert out.inputFiles() and all("/arrivo-scratch/" in f for f in out.inputFiles())
    assert TRIPS.label in out.columns


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaned_trips_hold_no_whole_rows_in_hash_tables(spark):
    t = trips(spark, SF_SMALL)
    held = _large(spark, lambda: _plan(flow.clean(t, TRIPS)[0]))
    assert "HashAggregate" not in held and "Window" in held
    moved = _large(spark, lambda: len(exchanges(flow.clean(t, TRIPS)[0])))
    assert moved == _large(spark, lambda: len(exchanges(t)))


def test_dedup_in_order_is_distinct(spark):
    rows = [(i % 40 if i % 9 else None, None if i % 4 else "a", i % 3) for i in range(600)] + [(7, "hot", 1)] * 900
    df = spark.createDataFrame(rows, "k int, t string, n int").repartition(5)
    assert sorted(map(str, dedup_in_order(df, "k").collect())) == sorted(map(str, df.distinct().collect()))
    zeros = spark.createDataFrame([(1, 0.0), (1, -0.0), (1, None), (1, None)], "k int, d double")
    assert dedup_in_order(zeros, "k").count() == zeros.distinct().count() == 2


def test_two_large_dictionaries_are_joined_in_turn(spark):
    rows = [(i, f"pay{i}", None if i % 3 == 0 else f"t{i % 90}", None if i % 4 == 0 else i % 70) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, payload string, t string, n int")
    specs = [DictSpec("t", ("t",)), DictSpec("n", ("n",))]
    want = fit_dictionaries(df.filter("id < 60"), specs).transform(df)
    fitted = fit_dictionaries(df.filter("id < 60"), specs, broadcast_limit=0, partitions=4)
    got = fitted.transform(df)
    assert not fitted.written and got.schema == want.schema     # no frame written with row numbers
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # the frame moves once for each, without a second copy of its key
    moved = [m for m in _large(spark, lambda: exchanges(fitted.transform(df)), "-1") if "payload" in m]
    assert len(moved) == 2 and not any("__key" in m for m in moved)


def test_rows_without_a_key_are_spread(spark):
    df = spark.createDataFrame([(i, None if i % 10 else i) for i in range(1000)], "id int, n int").repartition(3)
    fitted = fit_dictionaries(df, [DictSpec("n", ("n",))], broadcast_limit=0, partitions=4)
    held = _large(spark, lambda: fitted.transform(df).filter("n = -1").groupBy(F.spark_partition_id()).count().collect(), "-1")
    assert len(held) == 4 and sum(r["count"] for r in held) == 900 and max(r["count"] for r in held) < 350


def test_whole_numbers_meet_only_the_texts_they_are_cast_to(spark):
    df = spark.createDataFrame([("01", 1), ("x", 2), ("2", None), ("-0", 0), ("99999999999999999999", -5), (None, 7)],
                               "t string, n long")
    spec = [DictSpec("d", ("t", "n"))]
    new = spark.createDataFrame([(i,) for i in (0, 1, 2, -5, 7, 99, None)], "n long")
    fit = df.withColumn("n", F.when(F.col("n") < 0, F.col("n")))
    want = fit_dictionaries(fit, spec).transform(new)
    got = fit_dictionaries(fit, spec, broadcast_limit=0, partitions=4).transform(new)
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())
    assert got.filter("n >= 0").count() == 2
