"""Typed CSV scan driven by a column contract (name -> type).

The header is read through Spark (so any Spark path works), split with a
quote-aware CSV parser, and each name is stripped of non-word characters.
Known names get their contract type, unknown names become strings and are
flagged for removal. The schema is applied by position, and every file's own
header is compared with it where the file is read: a file of a folder whose
header differs fails the scan instead of being read wrongly. Inputs with
different column orders are given as several paths, which are aligned by
name.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 29-column flight contract (name -> type), in header order
FLIGHT_CONTRACT: dict[str, T.DataType] = {
    "Year": T.IntegerType(),
    "Month": T.IntegerType(),
    "DayofMonth": T.IntegerType(),
    "DayOfWeek": T.IntegerType(),
    "DepTime": T.StringType(),
    "CRSDepTime": T.StringType(),
    "ArrTime": T.StringType(),
    "CRSArrTime": T.StringType(),
    "UniqueCarrier": T.StringType(),
    "FlightNum": T.IntegerType(),
    "TailNum": T.StringType(),
    "ActualElapsedTime": T.StringType(),
    "CRSElapsedTime": T.IntegerType(),
    "AirTime": T.StringType(),
    "ArrDelay": T.StringType(),
    "DepDelay": T.StringType(),
    "Origin": T.StringType(),
    "Dest": T.StringType(),
    "Distance": T.IntegerType(),
    "TaxiIn": T.StringType(),
    "TaxiOut": T.StringType(),
    "Cancelled": T.IntegerType(),
    "CancellationCode": T.StringType(),
    "Diverted": T.IntegerType(),
    "CarrierDelay": T.StringType(),
    "WeatherDelay": T.StringType(),
    "NASDelay": T.StringType(),
    "SecurityDelay": T.StringType(),
    "LateAircraftDelay": T.StringType(),
}

# Columns the flight program cannot run without
FLIGHT_REQUIRED = ("Cancelled", "ArrDelay")

_NON_WORD = re.compile(r"\W")


class ContractError(ValueError):
    """The input does not satisfy the column contract."""


@dataclass(frozen=True)
class ScanResult:
    frame: DataFrame
    unknown_columns: tuple[str, ...]
    header: tuple[str, ...]


def normalise_name(name: str) -> str:
    """Strip every non-word character."""
    return _NON_WORD.sub("", name)


def check_extension(path: str) -> None:
    """The path must end in ``.csv`` (case-sensitive)."""
    if path[-4:] != ".csv":
        raise ContractError(f"file format is not supported, use .csv: {path}")


def raw_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Names of the first line of the input, split quote-aware, as
    written. One tiny job: the first line of the first split of the largest
    file, which always starts at offset 0 and therefore is a header line."""
    first = spark.read.text(path).limit(1).collect()
    if not first or not first[0][0] or not first[0][0].strip():
        raise ContractError(f"input has no header line: {path}")
    return tuple(next(csv.reader([first[0][0]])))


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The header's names, normalised."""
    return tuple(normalise_name(n) for n in raw_header(spark, path))


def contract_schema(header: tuple[str, ...], contract: dict[str, T.DataType]
                    ) -> tuple[T.StructType, tuple[str, ...]]:
    """S3: schema by position; unknown names -> string, flagged.

    Names equal ignoring case are rejected (T19): drops and existence tests
    are case-insensitive in Spark, so they could not be told apart."""
    seen: dict[str, str] = {}
    for n in header:
        if n.lower() in seen:
            raise ContractError(f"header names equal ignoring case: {seen[n.lower()]}, {n}")
        seen[n.lower()] = n
    fields, unknown = [], []
    for n in header:
        if n in contract:
            fields.append(T.StructField(n, contract[n], True))
        else:
            fields.append(T.StructField(n, T.StringType(), True))
            unknown.append(n)
    return T.StructType(fields), tuple(unknown)


def column_exists(df: DataFrame, name: str) -> bool:
    """Case-insensitive existence test; false when ambiguous."""
    hits = [c for c in df.columns if c.lower() == name.lower()]
    return len(hits) == 1


def checked_csv(spark: SparkSession, path: str, raw: tuple[str, ...], schema: T.StructType) -> DataFrame:
    """CSV file or folder read by position with ``schema``; every file must
    have the header ``raw``.

    PERMISSIVE mode: a bad integer becomes null, short rows are padded with
    null, long rows are cut."""
    as_written = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(raw, schema)])
    return _reader(spark, as_written).csv(path).toDF(*schema.names)


def _reader(spark: SparkSession, schema: T.StructType):
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE"))


#: Column that holds the text of a line that doesn't fit the schema; the
#: name can't be one of the contract's, which have word characters only.
CORRUPT = "~corrupt"
#: A field put behind each such line, to find where the line really ends.
END = "\u0003end\u0003"


def scan_rejects(spark: SparkSession, path: str | list[str], contract: dict[str, T.DataType] = FLIGHT_CONTRACT,
                 required: tuple[str, ...] = FLIGHT_REQUIRED) -> DataFrame:
    """What ``scan_contract`` reads as null or leaves out, counted: one row
    for each column and kind of reject.

    ``bad_value``: the field's text is no value of the column's type (read as
    null). ``missing_field``: the line ends before the column (read as null).
    ``extra_field``: the line has more fields than the header (column null;
    the fields are left out). One pass: Spark's reader keeps the text of lines
    that don't fit, and only these are split again."""
    counted = []
    for p in [path] if isinstance(path, str) else path:
        raw, schema = _checked_header(spark, p, contract, required)[:2]
        with_text = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(raw, schema)]
                                 + [T.StructField(CORRUPT, T.StringType(), True)])
        typed = _reader(spark, with_text).option("columnNameOfCorruptRecord", CORRUPT).csv(p).toDF(*schema.names, CORRUPT)
        places = [f"_{i}" for i in range(len(schema) + 1)]
        fields = F.from_csv(F.concat(F.col(CORRUPT), F.lit("," + END)), ", ".join(f"{n} string" for n in places))
        text = typed.filter(F.col(CORRUPT).isNotNull()).withColumn("__fields", fields)
        # place of the end mark: the number of fields, or null if it is beyond the header's
        end = F.coalesce(*[F.when(F.col(f"__fields.{n}") == END, i) for i, n in enumerate(places)])
        rows = text.withColumn("__end", end)
        rejects = [F.when(F.col("__end").isNull(), F.struct(F.lit(None).cast("string").alias("column_name"),
                                                              F.lit("extra_field").alias("reject")))]
        for i, f in enumerate(schema):
            named = F.lit(f.name).alias("column_name")
            there = F.coalesce(F.col("__end") > i, F.lit(True))
            rejects.append(F.when(~there, F.struct(named, F.lit("missing_field").alias("reject"))).when(
                F.col(f"`{f.name}`").isNull() & F.col(f"__fields._{i}").isNotNull(),
                F.struct(named, F.lit("bad_value").alias("reject"))))
        counted.append(rows.select(F.explode(F.array_compact(F.array(*rejects))).alias("r")).select("r.*"))
    every = counted[0]
    for more in counted[1:]:
        every = every.unionByName(more)
    return every.groupBy("column_name", "reject").agg(F.count(F.lit(1)).alias("lines"))


def _checked_header(spark, path, contract, required):
    check_extension(path)
    raw = raw_header(spark, path)
    header = tuple(normalise_name(n) for n in raw)
    schema, unknown = contract_schema(header, contract)
    probe = spark.createDataFrame([], schema)
    missing = [r for r in required if not column_exists(probe, r)]
    if missing:
        raise ContractError(f"required columns missing: {missing}")
    return raw, schema, unknown, header


def _scan_one(spark, path, contract, required) -> ScanResult:
    raw, schema, unknown, header = _checked_header(spark, path, contract, required)
    return ScanResult(checked_csv(spark, path, raw, schema), unknown, header)


def scan_contract(spark: SparkSession, path: str | list[str],
                  contract: dict[str, T.DataType] = FLIGHT_CONTRACT,
                  required: tuple[str, ...] = FLIGHT_REQUIRED,
                  check_empty: bool = True) -> ScanResult:
    """Typed scan of a CSV file or folder, or of several
    whose columns are the same in any order."""
    first, *more = [_scan_one(spark, p, contract, required) for p in ([path] if isinstance(path, str) else path)]
    frame = first.frame
    for other in more:
        if sorted(other.header) != sorted(first.header):
            raise ContractError(f"inputs differ in their columns: {first.header}, {other.header}")
        frame = frame.unionByName(other.frame)
    if check_empty and frame.isEmpty():
        raise ContractError(f"input holds no rows: {path}")
    return ScanResult(frame, first.unknown_columns, first.header)
