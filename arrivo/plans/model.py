"""Model layer (K3-K12, A5, A6, S9): repeatable hash split and folds,
standardisation, the algorithm factory with the reference grids,
cross-validated search and the hold-out score."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.session import scratch_path, storage_bytes

# Search grids and settings of the reference
LR_REG_PARAMS = (0.1, 0.2, 0.3)
LR_ELASTIC_NET = (0.5, 0.8, 1.0)
LR_MAX_ITER = 1000
RF_MAX_DEPTHS = (7, 9, 11)
RF_NUM_TREES = (7, 9, 11)
RF_MAX_BINS = 100
NUM_FOLDS = 3
PARALLELISM = 2
TEST_PERCENT = 1          # 99 % / 1 % split
RF_SEED = 42


def hash_bucket(key: Column, n: int) -> Column:
    """Repeatable bucket of a key: first 32 bits of md5 of its text, mod n.
    DuckDB: ``('0x'||substr(md5(key::varchar),1,8))::BIGINT % n``."""
    h = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(n)).cast("int")


def split_key_column(df: DataFrame, key: str | None) -> Column:
    """The split key, or (no key column) a hash of the whole row. Rows that
    are equal in the prepared frame then share a bucket, so none of them is
    in both parts."""
    if key:
        return F.col(key)
    return F.xxhash64(*[F.col(c) for c in df.columns])


def with_buckets(df: DataFrame, key: str | None) -> DataFrame:
    """K3, K9 (T17): ``bucket`` (0 to 99) and ``fold``, repeatable from the
    key alone."""
    k = split_key_column(df, key)
    return df.withColumns({"bucket": hash_bucket(k, 100), "fold": hash_bucket(k, NUM_FOLDS)})


def is_holdout(test_percent: int = TEST_PERCENT) -> Column:
    """Whether a row of ``with_buckets`` is kept for the final score."""
    return F.col("bucket") < test_percent


def fit_scaler(train: DataFrame, col: str = "features", out: str = "scaledFeatures"):
    """K4/A5: mean and sample standard deviation from training only."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=True, withStd=True).fit(train)


def is_linear(algorithm: str) -> bool:
    """K10 (T15): ``lr`` in any case is linear, everything else a forest."""
    return (algorithm or "").lower() == "lr"


@dataclass(frozen=True)
class Grid:
    lr_reg: tuple = LR_REG_PARAMS
    lr_elastic: tuple = LR_ELASTIC_NET
    rf_depths: tuple = RF_MAX_DEPTHS
    rf_trees: tuple = RF_NUM_TREES
    bootstrap: bool = True


REFERENCE_GRID = Grid()


def build_search(algorithm: str, label: str, features: str = "scaledFeatures",
                 grid: Grid = REFERENCE_GRID, fold_col: str | None = "fold",
                 parallelism: int = PARALLELISM, seed: int = RF_SEED,
                 weight: str | None = None) -> CrossValidator:
    """Estimator + grid + 3-fold cross-validation on RMSE. ``weight``
    names the column of weights of a linear search, if its rows have any."""
    if is_linear(algorithm):
        est = LinearRegression(featuresCol=features, labelCol=label, maxIter=LR_MAX_ITER,
                               fitIntercept=True, loss="squaredError", solver="auto",
                               standardization=False)
        maps = (ParamGridBuilder().addGrid(est.regParam, list(grid.lr_reg))
                .addGrid(est.elasticNetParam, list(grid.lr_elastic)).build())
    else:
        est = RandomForestRegressor(featuresCol=features, labelCol=label,
                                    featureSubsetStrategy="auto", impurity="variance",
                                    maxBins=RF_MAX_BINS, seed=seed, bootstrap=grid.bootstrap)
        maps = (ParamGridBuilder().addGrid(est.maxDepth, list(grid.rf_depths))
                .addGrid(est.numTrees, list(grid.rf_trees)).build())
    evaluator = RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol="prediction")
    if weight:
        est, evaluator = est.setWeightCol(weight), evaluator.setWeightCol(weight)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=NUM_FOLDS, parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv


def _forest_trees(spark: SparkSession, model) -> list[tuple]:
    """Each tree as arrays by node, numbered as MLlib stores them (0 is the
    root): feature, threshold, left and right child, value, and the left
    categories of nodes that split a nominal feature. A leaf is its own child,
    so a walk may go on from it."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    nodes: dict[int, list] = {}
    for r in (spark.read.parquet(f"{path}/data")
              .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
                      "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold",
                      "nodeData.split.numCategories").collect()):
        nodes.setdefault(r["treeID"], []).append(r)
    trees = []
    for _, rows in sorted(nodes.items()):
        rows.sort(key=lambda r: r["id"])
        leaf = [r["leftChild"] < 0 for r in rows]
        plain = [not end and r["numCategories"] < 0 for end, r in zip(leaf, rows)]
        trees.append((
            np.array([0 if end else r["featureIndex"] for end, r in zip(leaf, rows)]),
            np.array([r["leftCategoriesOrThreshold"][0] if p else 0.0 for p, r in zip(plain, rows)]),
            np.array([r["id"] if end else r["leftChild"] for end, r in zip(leaf, rows)]),
            np.array([r["id"] if end else r["rightChild"] for end, r in zip(leaf, rows)]),
            np.array([r["prediction"] for r in rows]),
            {r["id"]: r["leftCategoriesOrThreshold"] for end, p, r in zip(leaf, plain, rows) if not (end or p)}))
    return trees


def _walk(trees: list[tuple], depths: list[int]):
    """Function from rows to the predictions of a forest if its trees end at
    each of ``depths`` (ascending): the mean value of the nodes that the rows
    have reached. It reaches the workers by value; they need no library."""
    def predict(x):
        cells, first = x.ravel(), np.arange(len(x)) * x.shape[1]
        sums = {d: np.zeros(len(x)) for d in depths}
        for feature, threshold, left, right, value, nominal in trees:
            at = np.zeros(len(x), dtype=left.dtype)
            for step in range(depths[-1] + 1):
                if step in sums:
                    sums[step] += value[at]
                if step < depths[-1]:
                    v = cells[first + feature[at]]
                    go = v <= threshold[at]
                    for node, categories in nominal.items():
                        here = at == node
                        go[here] = np.isin(v[here], categories)
                    at = np.where(go, left[at], right[at])
        return [sums[d] / len(trees) for d in depths]
    return predict


def _scores_by_depth(spark, model, rows: DataFrame, label: str, features: str, depths: list[int]) -> dict[int, float]:
    """RMSE of a forest on ``rows`` if its trees end at each of ``depths``
    (ascending), in one pass. The trees are walked a batch of rows at a
    time."""
    predict = _walk(_forest_trees(spark, model), depths)

    def squares(batches):
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column(0).to_numpy(zero_copy_only=False)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int64()), *[
                pa.array([float(np.square(y - c).sum())]) for c in predict(x)]],
                names=["n", *[f"d{d}" for d in depths]])

    vectors = rows.select(F.col(label).cast("double").alias("label"), vector_to_array(features).alias("x"))
    sums = vectors.mapInArrow(squares, "n long, " + ", ".join(f"d{d} double" for d in depths))
    r = sums.agg(*[F.sqrt(F.sum(f"d{d}") / F.sum("n")).alias(f"d{d}") for d in depths]).first()
    return {d: r[f"d{d}"] for d in depths}


def _point_bytes(features: int, trees: int) -> int:
    """Bytes of a row that MLlib keeps in memory during a fit: four objects,
    a bin for each feature and a count for each tree."""
    return 96 + 4 * (features + trees)


def fits_at_once(storage: int, fit_bytes: int, most: int) -> int:
    """Fits that run together: as many as ``storage`` holds the rows of, at
    most ``most``. What it doesn't hold is read back from disk and built anew
    at every level, by each of them."""
    return max(1, min(most, storage // max(1, fit_bytes)))


def fit_forests(cv: CrossValidator, train: DataFrame, label: str, rows: int | None = None) -> CrossValidatorModel:
    """K7-K9: ``cv.fit`` for a grid of depths and numbers of trees, with a
    fit for each number of trees and fold instead of one for each depth as
    well: a tree of MLlib grows level by level, so the first levels of the
    deepest are the shallower tree (test). The best point is fitted again on
    all rows. ``rows``: how many ``train`` has, if that is known."""
    spark, est, maps = train.sparkSession, cv.getEstimator(), cv.getEstimatorParamMaps()
    points = [(int(pm[est.maxDepth]), int(pm[est.numTrees])) for pm in maps]
    depths, sizes = sorted({d for d, _ in points}), sorted({n for _, n in points}, reverse=True)
    fold = F.col(cv.getFoldCol())

    def score(task):
        i, trees = task
        model = est.copy({est.maxDepth: depths[-1], est.numTrees: trees}).fit(train.filter(fold != i))
        held = train.filter(fold == i)
        return i, trees, _scores_by_depth(spark, model, held, label, est.getFeaturesCol(), depths)

    found = {}
    tasks = [(i, n) for i in range(cv.getNumFolds()) for n in sizes]
    rows = train.count() if rows is None else rows
    head = train.select(est.getFeaturesCol()).first()
    share = (cv.getNumFolds() - 1) / cv.getNumFolds()
    one = int(rows * share) * _point_bytes(head[0].size if head else 0, sizes[0])
    with ThreadPool(fits_at_once(storage_bytes(spark), one, cv.getParallelism())) as pool:
        for i, n, by_depth in pool.imap_unordered(inheritable_thread_target(spark)(score), tasks):
            found |= {(i, d, n): v for d, v in by_depth.items()}
    folds = [[found[i, d, n] for d, n in points] for i in range(cv.getNumFolds())]
    mean, spread = np.mean(folds, axis=0), np.std(folds, axis=0)
    best = est.fit(train, maps[int(np.argmin(mean))])
    return cv._copyValues(CrossValidatorModel(best, [float(m) for m in mean], None, [float(s) for s in spread]))


def grid_report(spark: SparkSession, cv_model: CrossValidatorModel, algorithm: str) -> DataFrame:
    """One row per grid point: its parameters and mean validation RMSE."""
    rows = []
    for pm, metric in zip(cv_model.getEstimatorParamMaps(), cv_model.avgMetrics):
        named = {p.name: v for p, v in pm.items()}
        if is_linear(algorithm):
            rows.append((float(named["regParam"]), float(named["elasticNetParam"]), None, None,
                         float(metric)))
        else:
            rows.append((None, None, int(named["maxDepth"]), int(named["numTrees"]),
                         float(metric)))
    return spark.createDataFrame(
        rows, "reg_param double, elastic_net double, max_depth int, num_trees int, "
              "avg_rmse double")


def rmse_expr(label: str, prediction: str) -> Column:
    """A6 as one aggregate expression."""
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))
