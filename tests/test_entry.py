import __spark_entry__ as E


def test_registry_consistent():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    # training-data queries (opN_*, pipeline) are there only with their subpackage
    rest = {x for x in set(q) - set(sql) if not x.startswith("op") and x != "pipeline"}
    assert rest == {"lr_grid_cv", "rf_grid_cv", "score_holdout"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["algorithm", "rmse", "train_rows", "test_rows"]
    assert rows[0]["rmse"] > 0 and rows[0]["train_rows"] > rows[0]["test_rows"] > 0
