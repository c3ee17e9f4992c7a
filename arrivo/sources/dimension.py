"""Dimension CSV (S5, S7, S8): header must start with the nine expected
names in order; only key, model and engine type are kept.

Failures are not swallowed wholesale: each check returns the input frame
unchanged together with a reason, so the caller can log or raise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from arrivo.sources.contract import ContractError, check_extension, checked_csv, normalise_name, raw_header
from arrivo.sources.tables import DIMENSION_HEADER


@dataclass(frozen=True)
class DimensionRead:
    frame: DataFrame | None
    reason: str | None


def read_dimension_csv(spark: SparkSession, path: str,
                       header: tuple[str, ...] = DIMENSION_HEADER) -> DimensionRead:
    """Scan the dimension CSV, all columns text, schema by position."""
    try:
        check_extension(path)
    except ContractError as e:
        return DimensionRead(None, str(e))
    try:
        raw = raw_header(spark, path)
        names = tuple(normalise_name(n) for n in raw)
    except ContractError as e:
        return DimensionRead(None, str(e))
    except AnalysisException as e:                      # missing or unreadable path
        return DimensionRead(None, f"cannot read dimension file {path}: {e.getCondition()}")
    if len(names) < len(header) or tuple(names[: len(header)]) != tuple(header):
        return DimensionRead(None, f"dimension header differs from {list(header)}: {list(names)}")
    schema = T.StructType(
        [T.StructField(n, T.StringType(), True) for n in header]
        + [T.StructField(n, T.StringType(), True) for n in names[len(header):]])
    frame = checked_csv(spark, path, raw, schema)
    return DimensionRead(frame.select(*header), None)
