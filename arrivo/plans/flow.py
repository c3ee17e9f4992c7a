"""End-to-end composition (K1): load -> clean (fitted policy) -> encode
(fitted dictionaries) -> derive -> assemble -> split -> scale -> search ->
score.

Passes over the data before training: the dedup shuffle, written to the
shared checkpoint folder; three aggregations over that table, two for the
missing-value policy and one for all dictionaries (and the year list)
together; and the prepared frame, written because the model search reads it
many times. Lost executors read these tables again instead of the raw input.
``Prepared.close`` deletes them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.functions.calendar import CORRECTED
from arrivo.functions.holidays import FIRST_YEAR, LAST_YEAR, add_proximity, distinct_years
from arrivo.layout import Layout
from arrivo.operators.clean import (cast_text_columns, dedup_in_order, dedup_rows, dedup_to, drop_names,
                                    drop_null_label, drop_strings, keep_not_cancelled)
from arrivo.functions.casts import text_to_int
from arrivo.operators.encode import DictionaryModel, DictSpec, fit_dictionaries
from arrivo.operators.enrich import join_dimension
from arrivo.operators.features import (add_interactions, append_scaled_squares, assemble,
                                       feature_columns, squared_feature_names)
from arrivo.operators.missing import MissingPolicy, fit_missing_policy
from arrivo.plans.model import (REFERENCE_GRID, TEST_PERCENT, Grid, build_search, fit_forests, fit_scaler,
                                is_holdout, is_linear, rmse_expr, with_buckets)
from arrivo.plans.moments import moment_rows
from arrivo.session import cut_lineage, drop_cut

YEAR_DICT = "__year__"


def dictionary_specs(layout: Layout) -> list[DictSpec]:
    """E4 (model, engine type), E1 (shared airports), E2 (carrier), E3
    (route number), plus the year list for the proximity step."""
    return [
        DictSpec("model", (layout.dim_model,)),
        DictSpec("engine_type", (layout.dim_engine,)),
        DictSpec("airport", (layout.origin, layout.dest)),
        DictSpec("carrier", (layout.carrier,)),
        DictSpec("route", (layout.route,)),
        DictSpec(YEAR_DICT, (layout.year,)),
    ]


def years_from(model: DictionaryModel) -> DataFrame:
    """(year): the fitted years that can form a date."""
    year = F.col("key").cast("int")
    return model.keys(YEAR_DICT).filter(year.between(FIRST_YEAR, LAST_YEAR)).select(year.alias("year"))


def fit_clean_steps(base: DataFrame, layout: Layout):
    """Missing-value policy and every dictionary of a cleaned frame. The
    policy takes two aggregations; then one pass over the rows and columns
    that it leaves (those whose label survives the cast) counts the keys of
    all dictionaries together."""
    policy = fit_missing_policy(base, protected=layout.protected())
    kept = policy.transform(base)
    label = F.col(layout.label)
    cast = text_to_int(label) if layout.label in layout.text_to_int else label
    return policy, fit_dictionaries(kept.filter(cast.isNotNull()), dictionary_specs(layout))


@dataclass
class Prepared:
    """A fitted preparation and its frame. The algorithm, proximity mode,
    calendar and dimension of the fit are kept, so that ``apply_prepared``
    treats new rows alike."""
    frame: DataFrame | None     # None in a stored fit
    features: list[str]
    layout: Layout
    algorithm: str
    policy: MissingPolicy
    dictionaries: DictionaryModel
    years: DataFrame
    proximity_mode: str
    calendar: tuple
    dimension: DataFrame | None = None
    dimension_reason: str | None = None
    written: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        """Delete the tables that this preparation wrote."""
        for df in self.written:
            drop_cut(df)
        self.written.clear()
        self.dictionaries.close()


#: From this share of dropped columns on, dedup groups by row signature.
SIGNATURE_SHARE = 1 / 3


def clean(raw: DataFrame, layout: Layout, unknown=(), dimension: DataFrame | None = None):
    """Dedup, optional dimension join, drops, cancelled filter; returns the
    frame, the dimension outcome and the tables written on the way."""
    written = []
    kept = drop_names(raw, (*unknown, *layout.fixed_drops)).columns
    if dimension is not None and layout.vehicle in raw.columns and layout.vehicle not in kept:
        kept = [c for c in raw.columns if c in kept or c == layout.vehicle]
    # equal rows are cancelled together, so the filter may come first
    if len(raw.columns) - len(kept) >= SIGNATURE_SHARE * len(raw.columns):
        df = dedup_to(keep_not_cancelled(raw, layout.cancelled), kept)
        written.append(df)
    elif layout.split_key in raw.columns:
        df = dedup_in_order(keep_not_cancelled(raw, layout.cancelled), layout.split_key)
    else:
        df = keep_not_cancelled(dedup_rows(raw), layout.cancelled)
    reason = "no dimension given"
    if dimension is not None:
        enr = join_dimension(df, dimension, layout.vehicle, layout.dim_key,
                             (layout.dim_model, layout.dim_engine))
        df, reason = enr.frame, enr.reason
    return drop_names(df, (*unknown, *layout.fixed_drops)), reason, written


def prepare(raw: DataFrame, layout: Layout, algorithm: str = "lr", unknown=(),
            dimension: DataFrame | None = None, proximity_mode: str = "nearest",
            calendar=CORRECTED) -> Prepared:
    base, reason, written = clean(raw, layout, unknown, dimension)
    if not written or reason is None:
        # read by the fits and by the final cut
        base = cut_lineage(base, "cleaned")
        written.append(base)
    policy, dicts = fit_clean_steps(base, layout)
    years = years_from(dicts) if layout.year in base.columns else None
    df = _derived(base, layout, algorithm, policy, dicts, years, proximity_mode, calendar,
                  drop_single_year=True)
    df = cut_lineage(drop_strings(df), "prepared")
    exclude = (layout.split_key,) if layout.split_key else ()
    features = feature_columns(df, layout.label, exclude)
    return Prepared(df, features, layout, algorithm, policy, dicts, years, proximity_mode, tuple(calendar),
                    dimension if reason is None else None, reason, [*written, df])


def _derived(df: DataFrame, layout: Layout, algorithm: str, policy: MissingPolicy,
             dicts: DictionaryModel, years: DataFrame | None, mode: str, calendar,
             drop_single_year: bool) -> DataFrame:
    """The fitted steps after cleaning, in the reference's order."""
    df = policy.transform(df)
    df = cast_text_columns(df, layout.text_to_int)
    if layout.label in df.columns:
        df = drop_null_label(df, layout.label)
    df = dicts.transform(df, skip=(YEAR_DICT,))
    if years is not None:
        df = add_proximity(df, layout.year, layout.month, layout.day, layout.proximity, mode=mode,
                           calendar=calendar, years=years, drop_single_year=drop_single_year)
    return add_interactions(df, layout) if is_linear(algorithm) else df


def apply_prepared(prep: Prepared, raw: DataFrame, unknown=()) -> DataFrame:
    """The fitted steps applied to new rows. The dimension, missing-value
    decisions, dictionary codes (unseen keys -> -1), proximity mode, calendar
    and feature list come from the fit; only the years of the calendar follow
    the new rows as well, because it is a calendar, not a learned value.
    Columns come out in the fitted feature order, plus the label and split
    key when present."""
    layout = prep.layout
    df, _, written = clean(raw, layout, unknown, prep.dimension)
    if not written or prep.dimension is not None:
        # read by the list of years and by the result
        df = cut_lineage(df, "applied")
        written.append(df)
    prep.written += written
    years = prep.years
    if years is not None and layout.year in df.columns:
        years = cut_lineage(years.unionByName(distinct_years(df, layout.year)).distinct(), "years")
    df = _derived(df, layout, prep.algorithm, prep.policy, prep.dictionaries, years, prep.proximity_mode,
                  prep.calendar, drop_single_year=False)
    keep = [c for c in (layout.label, layout.split_key) if c and c in df.columns]
    return df.select(*prep.features, *keep)


def model_input(prep: Prepared, features: list[str] | None = None) -> DataFrame:
    """Assembled rows with the split bucket (0..99) and fold id."""
    return assemble(with_buckets(prep.frame, prep.layout.split_key), features or prep.features)


def scaled_parts(prep: Prepared, features: list[str], squares: bool, test_percent: int = TEST_PERCENT):
    """(scaler, training rows, hold-out rows): only label, fold and scaled
    vector, with the scaler fitted on the training rows."""
    data = model_input(prep, features).select(prep.layout.label, "fold", "bucket", "features")
    scaler = fit_scaler(data.filter(~is_holdout(test_percent)))
    scaled = scaler.transform(data)
    if squares:
        scaled = append_scaled_squares(scaled, features)
    train, test = (scaled.filter(c).select(prep.layout.label, "fold", "scaledFeatures")
                   for c in (~is_holdout(test_percent), is_holdout(test_percent)))
    return scaler, train, test


@dataclass
class Scored:
    algorithm: str
    cv_model: object
    scaler: object
    rmse: float
    train_rows: int
    test_rows: int
    vector_names: list[str]
    features: list[str]
    squares: bool
    test_percent: int = TEST_PERCENT

    def metrics(self, spark: SparkSession) -> DataFrame:
        """The report as a frame instead of a printed line."""
        return spark.createDataFrame(
            [("linear" if is_linear(self.algorithm) else "forest", float(self.rmse),
              int(self.train_rows), int(self.test_rows))],
            "algorithm string, rmse double, train_rows long, test_rows long")


@dataclass
class TrainingParts:
    """What a search reads, written once for any number of searches: rows by
    their moments (linear) or all of them (forest), and the hold-out rows."""
    scaler: object
    train: DataFrame
    test: DataFrame
    train_rows: int
    weight: str | None

    def close(self) -> None:
        for df in (self.test,) if self.weight else (self.test, self.train):
            drop_cut(df)


def training_parts(prep: Prepared, algorithm: str = "lr", test_percent: int = TEST_PERCENT,
                   features: list[str] | None = None, squares: bool | None = None) -> TrainingParts:
    squares = is_linear(algorithm) if squares is None else squares
    scaler, train, test = scaled_parts(prep, list(features or prep.features), squares, test_percent)
    weight = None
    if is_linear(algorithm):
        weight = "weight"
        train, n_train = moment_rows(train, prep.layout.label, weight=weight)
    else:
        # every fit reads the training rows, which are three columns
        train = cut_lineage(train, "train")
        n_train = train.count()
    return TrainingParts(scaler, train, cut_lineage(test, "holdout"), n_train, weight)


def train_and_score(prep: Prepared, algorithm: str = "lr", grid: Grid = REFERENCE_GRID,
                    test_percent: int = TEST_PERCENT, parallelism: int = 2,
                    features: list[str] | None = None, squares: bool | None = None,
                    parts: TrainingParts | None = None) -> Scored:
    """Search, refit and hold-out score. ``features`` and ``squares`` restrict
    the model; by default it takes all features, and squares when linear.
    ``parts``: those of ``training_parts`` with the same arguments, for
    several searches over the same rows."""
    features = list(features or prep.features)
    squares = is_linear(algorithm) if squares is None else squares
    own = parts is None
    parts = parts or training_parts(prep, algorithm, test_percent, features, squares)
    cv = build_search(algorithm, prep.layout.label, grid=grid, parallelism=parallelism, weight=parts.weight)
    if parts.weight:
        cv_model = cv.fit(parts.train)
    else:
        cv_model = fit_forests(cv, parts.train, prep.layout.label, parts.train_rows)
    scored = cv_model.transform(parts.test)
    r = scored.agg(rmse_expr(prep.layout.label, "prediction").alias("rmse"),
                   F.count(F.lit(1)).alias("n")).first()
    if own:
        parts.close()
    return Scored(algorithm, cv_model, parts.scaler, r["rmse"], parts.train_rows, r["n"],
                  squared_feature_names(features) if squares else features, features, squares, test_percent)


@dataclass
class RunResult:
    metrics: DataFrame
    scored: Scored
    prepared: Prepared
    unknown_columns: tuple[str, ...]


def run(spark: SparkSession, path: str, algorithm: str = "", dimension_path: str | None = None,
        layout: Layout | None = None, contract=None, grid: Grid = REFERENCE_GRID,
        proximity_mode: str = "nearest", calendar=CORRECTED) -> RunResult:
    """The reference program's three forms in one call: ``(csv)``,
    ``(csv, algorithm)`` and ``(csv, algorithm, dimension csv)``. An empty
    or unknown algorithm means the forest; a failed dimension check leaves
    the data unchanged and records the reason. ``proximity_mode="scan"`` with
    ``calendar=AS_BUILT`` gives the reference's own holiday feature."""
    from arrivo.layout import FLIGHTS
    from arrivo.sources.contract import FLIGHT_CONTRACT, scan_contract
    from arrivo.sources.dimension import read_dimension_csv

    layout = layout or FLIGHTS
    contract = contract or FLIGHT_CONTRACT
    scan = scan_contract(spark, path, contract, required=(layout.cancelled, layout.label))
    dim, reason = None, None
    if dimension_path:
        read = read_dimension_csv(spark, dimension_path)
        dim, reason = read.frame, read.reason
    prep = prepare(scan.frame, layout, algorithm, unknown=scan.unknown_columns, dimension=dim,
                   proximity_mode=proximity_mode, calendar=calendar)
    if reason:
        prep.dimension_reason = reason
    scored = train_and_score(prep, algorithm, grid=grid)
    return RunResult(scored.metrics(spark), scored, prep, scan.unknown_columns)
