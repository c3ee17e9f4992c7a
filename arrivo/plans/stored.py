"""Fits kept for later sessions (K1, T10) and scored rows as a table.

A stored fit is a folder that any Spark path can name: the decisions,
features, layout, calendar and dictionary sizes as one JSON text with a
version, dictionary codes, years and the dimension as Parquet, scaler and
search model by MLlib's own writers. The JSON text is written last, so a
folder without it is no fit. Scored rows are written by run id; writing a run
again replaces its rows.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.functions.calendar import Rule
from arrivo.layout import Layout
from arrivo.operators.encode import DictionaryModel, DictSpec
from arrivo.operators.features import append_scaled_squares, assemble
from arrivo.operators.missing import Decision, MissingPolicy
from arrivo.plans import flow
from arrivo.plans.model import is_holdout, split_key_column, with_buckets

VERSION = 1


class StoredFitError(ValueError):
    pass


@dataclass
class StoredFit:
    """A preparation (without its training frame) and, if it was stored, the
    scaler and the search model."""
    prepared: flow.Prepared
    scaler: StandardScalerModel | None
    cv_model: CrossValidatorModel | None
    features: list[str]
    squares: bool

    def score(self, raw: DataFrame, unknown=()) -> DataFrame:
        """(row_key, label, prediction) of new rows; rows with a null feature
        are skipped (F7)."""
        if self.cv_model is None:
            raise StoredFitError("the fit was stored without a model")
        rows = flow.apply_prepared(self.prepared, raw, unknown)
        return predictions(rows, self.prepared.layout, self.features, self.squares, self.scaler, self.cv_model)


def predictions(rows: DataFrame, layout: Layout, features: list[str], squares: bool, scaler, cv_model) -> DataFrame:
    """(row_key, label, prediction): the row's split key, or a hash of the
    row where the layout has none."""
    keyed = rows.withColumn("row_key", split_key_column(rows, layout.split_key))
    scaled = scaler.transform(assemble(keyed, features))
    if squares:
        scaled = append_scaled_squares(scaled, features)
    label = F.col(layout.label).cast("double") if layout.label in rows.columns else F.lit(None).cast("double")
    return cv_model.transform(scaled).select("row_key", label.alias("label"), "prediction")


def holdout_predictions(prep: flow.Prepared, scored: flow.Scored) -> DataFrame:
    """The rows behind ``Scored.rmse``."""
    rows = with_buckets(prep.frame, prep.layout.split_key).filter(is_holdout(scored.test_percent)).select(prep.frame.columns)
    return predictions(rows, prep.layout, scored.features, scored.squares, scored.scaler, scored.cv_model)


def write_scored(rows: DataFrame, path: str, run_id: str) -> None:
    """Keep the rows of a run; a rerun replaces them, other runs stay."""
    if not run_id or not run_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a run id holds letters, digits, - and _: {run_id!r}")
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def read_scored(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """(row_key, label, prediction, run_id) of all runs or of one."""
    if run_id is not None:
        return spark.read.parquet(f"{path.rstrip('/')}/run_id={run_id}").withColumn("run_id", F.lit(run_id))
    return spark.read.parquet(path).withColumn("run_id", F.col("run_id").cast("string"))


def save_fit(prep: flow.Prepared, path: str, scored: flow.Scored | None = None) -> None:
    """Store ``prep`` and, if given, the model trained on it. The folder must
    not hold a fit yet."""
    spark = prep.dictionaries.codes.sparkSession
    path = path.rstrip("/")
    prep.dictionaries.codes.write.parquet(f"{path}/codes")
    for frame, name in ((prep.years, "years"), (prep.dimension, "dimension")):
        if frame is not None:
            frame.write.parquet(f"{path}/{name}")
    if scored is not None:
        scored.scaler.write().save(f"{path}/scaler")
        scored.cv_model.write().save(f"{path}/search")
    d = prep.dictionaries
    held = {
        "version": VERSION, "algorithm": prep.algorithm, "features": prep.features,
        "layout": asdict(prep.layout), "proximity_mode": prep.proximity_mode,
        "calendar": [asdict(r) for r in prep.calendar],
        "dimension_reason": prep.dimension_reason, "dimension": prep.dimension is not None,
        "years": prep.years is not None, "rows_left": prep.policy.rows_left,
        "decisions": [asdict(x) for x in prep.policy.decisions],
        "string_columns": sorted(prep.policy.string_columns),
        "dictionaries": {"specs": [asdict(s) for s in d.specs], "sizes": d.sizes, "totals": d.totals,
                         "bytes": d.bytes, "sized": d.sized, "broadcast_limit": d.broadcast_limit, "partitions": d.partitions},
        "model": scored is not None,
        "model_features": scored.features if scored else prep.features,
        "squares": scored.squares if scored else False,
    }
    spark.createDataFrame([(json.dumps(held),)], "value string").coalesce(1).write.text(f"{path}/fit")


def load_fit(spark: SparkSession, path: str) -> StoredFit:
    path = path.rstrip("/")
    held = json.loads(spark.read.text(f"{path}/fit", wholetext=True).first()[0])
    if held["version"] != VERSION:
        raise StoredFitError(f"the fit has version {held['version']}, this library reads version {VERSION}")
    d = held["dictionaries"]
    dictionaries = DictionaryModel(
        tuple(DictSpec(s["name"], tuple(s["columns"])) for s in d["specs"]), spark.read.parquet(f"{path}/codes"),
        d["sizes"], d["totals"], d["bytes"], d["broadcast_limit"], d["partitions"], sized=d.get("sized", {}))
    policy = MissingPolicy(tuple(Decision(**x) for x in held["decisions"]), frozenset(held["string_columns"]),
                           held["rows_left"])
    layout = Layout(**{k: tuple(v) if isinstance(v, list) else v for k, v in held["layout"].items()})
    prep = flow.Prepared(
        None, held["features"], layout, held["algorithm"], policy, dictionaries,
        spark.read.parquet(f"{path}/years") if held["years"] else None, held["proximity_mode"],
        tuple(Rule(**r) for r in held["calendar"]),
        spark.read.parquet(f"{path}/dimension") if held["dimension"] else None, held["dimension_reason"])
    scaler = StandardScalerModel.load(f"{path}/scaler") if held["model"] else None
    cv_model = CrossValidatorModel.load(f"{path}/search") if held["model"] else None
    return StoredFit(prep, scaler, cv_model, held["model_features"], held["squares"])
