import random

import pytest
from pyspark.sql import functions as F

from arrivo.operators.missing import (DROP_COLUMN, DROP_ROWS, PolicyError,
                                      fit_missing_policy, missing_profile)


def frame(spark, a, b=None):
    if b is None:
        return spark.createDataFrame([(x,) for x in a], "a string")
    return spark.createDataFrame(list(zip(a, b)), "a string, b int")


def test_m1_limit_inclusive(spark):
    df = frame(spark, ["NA"] * 3 + ["x"] * 7)
    pol = fit_missing_policy(df)
    assert pol.decisions[0].action == DROP_COLUMN
    out = pol.transform(df)
    assert out.columns == [] or "a" not in out.columns
    assert out.count() == 10


def test_m2_order(spark):
    a = ["NA", "NA"] + ["x"] * 8
    b = [None, None, None] + [1] * 7
    df = frame(spark, a, b)
    pol = fit_missing_policy(df)
    assert [(d.rows_seen, d.missing, d.action) for d in pol.decisions] == [
        (10, 2, DROP_ROWS), (8, 1, DROP_ROWS)]
    assert pol.transform(df).count() == 7


def test_m2r_reversed_order(spark):
    a = ["NA", "NA"] + ["x"] * 8
    b = [None, None, None] + [1] * 7
    df = frame(spark, a, b).select("b", "a")
    pol = fit_missing_policy(df)
    assert [(d.rows_seen, d.missing, d.action) for d in pol.decisions] == [
        (10, 3, DROP_COLUMN), (10, 2, DROP_ROWS)]
    out = pol.transform(df)
    assert out.columns == ["a"] and out.count() == 8


def test_m3_nulls_in_string_column(spark):
    df = frame(spark, [None] * 4 + ["x"] * 6)
    pol = fit_missing_policy(df)
    assert pol.decisions[0].missing == 0 and pol.decisions[0].action == DROP_ROWS
    assert pol.transform(df).count() == 6


def test_m4_all_null_string_raises(spark):
    df = spark.createDataFrame([(None,)] * 10, "a string")
    with pytest.raises(PolicyError):
        fit_missing_policy(df)


def test_m5_label_never_dropped(spark):
    df = spark.createDataFrame([("NA",)] * 3 + [("1",)] * 7, "lbl string")
    with pytest.raises(PolicyError):
        fit_missing_policy(df, protected=("lbl",))


def sequential(df, strings):
    """The ordered rule on the data itself, one column after another."""
    decisions = []
    for i, c in enumerate(df.columns):
        bad = (F.col(c) == "NA") if c in strings else F.col(c).isNull()
        seen, missing = df.count(), df.filter(bad).count()
        drop = seen > 0 and 10 * missing >= 3 * seen
        if not drop:
            df = df.filter((F.col(c) != "NA") if c in strings else F.col(c).isNotNull())
        decisions.append((i, c, seen, missing, DROP_COLUMN if drop else DROP_ROWS))
    return decisions, df.count()


def test_histogram_equals_sequential(spark):
    rnd = random.Random(7)
    for case in range(4):
        n = rnd.randint(5, 40)
        rows = []
        for _ in range(n):
            rows.append((rnd.choice(["NA", None, "x", "y"]), rnd.choice([None, 1, 2]),
                         rnd.choice(["NA", "z", "z", None])))
        df = spark.createDataFrame(rows, "a string, b int, c string")
        want, left = sequential(df, {"a", "c"})
        if left == 0:
            with pytest.raises(PolicyError):
                fit_missing_policy(df)
            continue
        hist = fit_missing_policy(df)
        assert [(d.position, d.column_name, d.rows_seen, d.missing, d.action) for d in hist.decisions] == want
        assert hist.transform(df).count() == left == hist.rows_left


def test_distinct_pattern_per_row(spark):
    # every row has its own status pattern, so the histogram is as long as the data
    names = [f"c{i}" for i in range(7)]
    rows = [tuple(None if n >> i & 1 else n for i in range(7)) for n in range(128)] + [(1,) * 7] * 300
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    want, left = sequential(df, set())
    got = fit_missing_policy(df)
    assert [(d.position, d.column_name, d.rows_seen, d.missing, d.action) for d in got.decisions] == want
    assert got.rows_left == left


def test_profile(spark):
    df = frame(spark, ["NA", None, "x"], [None, 1, 2])
    rows = {r["column_name"]: r for r in missing_profile(df).collect()}
    assert (rows["a"]["na_count"], rows["a"]["null_count"], rows["a"]["row_count"]) == (1, 1, 3)
    assert (rows["b"]["na_count"], rows["b"]["null_count"]) == (0, 1)


def test_profile_is_one_job(spark):
    df = frame(spark, ["NA", None, "x"], [None, 1, 2])
    plan = missing_profile(df.withColumn("c", F.lit("NA")))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("HashAggregate") <= 2 and "Exchange" in plan


def test_fused_fit_equals_separate_fits(spark):
    from arrivo.layout import FLIGHTS
    from arrivo.operators.clean import cast_text_columns, drop_null_label
    from arrivo.operators.encode import fit_dictionaries
    from arrivo.plans.flow import dictionary_specs, fit_clean_steps

    rnd = random.Random(3)
    rows = []
    for i in range(60):
        rows.append((rnd.choice(["AA", "NA", "UA", "NA", "DL"]),           # carrier: >= 30 % NA
                     rnd.choice(["JFK", "LAX", "SFO", None]),
                     rnd.choice(["JFK", "ORD", "NA"]),
                     rnd.choice(["5", "12.5", "x", "NA", "-3"]),            # label, some casts fail
                     rnd.choice([2007, 2008, None])))
    df = spark.createDataFrame(rows, "UniqueCarrier string, Origin string, Dest string, "
                                     "ArrDelay string, Year int")
    policy, dicts = fit_clean_steps(df, FLIGHTS)
    ref_policy = fit_missing_policy(df, protected=FLIGHTS.protected())
    assert policy.decisions == ref_policy.decisions
    assert "UniqueCarrier" in policy.dropped
    cleaned = drop_null_label(cast_text_columns(ref_policy.transform(df), FLIGHTS.text_to_int),
                              "ArrDelay")
    ref = fit_dictionaries(cleaned, dictionary_specs(FLIGHTS))
    got = sorted(tuple(r) for r in dicts.codes.select("dict", "key", "freq", "code").collect())
    want = sorted(tuple(r) for r in ref.codes.select("dict", "key", "freq", "code").collect())
    assert got == want
    assert [s.columns for s in dicts.specs] == [s.columns for s in ref.specs]


def random_frame(spark, rnd, columns, rows, shares):
    """Columns with about the given shares of NA and null, some of them
    missing together."""
    out = []
    for _ in range(rows):
        luck = rnd.random()
        out.append(tuple(
            (rnd.choice([None, "NA", "NA"]) if i % 2 else None)
            if (luck if i % 3 == 0 else rnd.random()) < shares[i] else ("x" if i % 2 else i)
            for i in range(columns)))
    return spark.createDataFrame(out, ", ".join(f"c{i} {'string' if i % 2 else 'int'}" for i in range(columns)))


def test_open_columns_equal_sequential(spark, monkeypatch):
    """Ratios near the limit, which the profile leaves open, in one round
    and in as many as there are open columns."""
    from arrivo.operators import missing
    rnd, opened = random.Random(12), 0
    for case in range(6):
        monkeypatch.setattr(missing, "MAX_OPEN", 5 if case % 2 else 1)
        shares = [rnd.choice([0, 0.1, 0.25, 0.3, 0.33, 0.5]) for _ in range(9)]
        df = random_frame(spark, rnd, 9, 150, shares).coalesce(1).cache()
        strings = {f"c{i}" for i in range(1, 9, 2)}
        opened += missing.settled(missing_profile(df).collect(), strings).count(None)
        want, left = sequential(df, strings)
        if left == 0:
            with pytest.raises(PolicyError):
                fit_missing_policy(df)
            continue
        got = fit_missing_policy(df)
        assert [(d.position, d.column_name, d.rows_seen, d.missing, d.action) for d in got.decisions] == want
        assert got.rows_left == left == got.transform(df).count()
    assert opened > 6


def test_settled_columns_hold_for_every_removal():
    """What the profile settles is what the rule decides whichever rows went
    before, by trying every number of removed rows and missing ones."""
    from collections import namedtuple
    from arrivo.operators.missing import settled
    line = namedtuple("line", "column_name na_count null_count row_count")
    for rows in (10, 13):
        for gone in range(rows + 1):
            for missing in range(rows + 1):
                profile = [line("a", 0, gone, rows)._asdict(), line("b", 0, missing, rows)._asdict()]
                first, second = settled(profile, set())
                most = 0 if first == DROP_COLUMN else gone
                possible = {DROP_COLUMN if rows > r and 10 * left >= 3 * (rows - r) else DROP_ROWS
                            for r in ({gone} if most else {0}) for left in range(max(0, missing - r), min(missing, rows - r) + 1)}
                assert second is None or possible == {second}, (rows, gone, missing)


def test_jobs_do_not_grow_with_columns(spark):
    def jobs(columns):
        df = random_frame(spark, random.Random(1), columns, 60, [0.02] * columns).coalesce(1).cache()
        df.count()
        group = f"policy-{columns}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            fit_missing_policy(df)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert 0 < jobs(4) == jobs(16) <= 6
