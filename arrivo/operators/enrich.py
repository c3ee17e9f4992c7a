"""Dimension enrichment (J1, J2, P4, F2, S7, S8) and the code lookup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.operators.joins import broadcast_bytes, may_match, measured, shuffled_lookup
from arrivo.session import cut_lineage
from arrivo.sources.dimension import read_dimension_csv


@dataclass(frozen=True)
class Enriched:
    frame: DataFrame
    reason: str | None      # None when the dimension was joined


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str = "tailnum",
                   attrs=("model", "engine_type"), broadcast_limit: int | None = None,
                   partitions: int | None = None) -> Enriched:
    """Inner join on fact_key = dim_key keeping ``attrs``; rows of the fact
    without a match are lost and repeated dimension keys multiply rows, as in
    the reference. Both key columns are dropped (J2).

    One pass over the dimension gives its rows (S7) and bytes. It is
    broadcast when the bytes are within ``broadcast_limit`` (the session's
    threshold by default); otherwise the fact is written, rows whose key cannot
    match are left out by a bit filter and the join shuffles the rest with hot
    keys salted."""
    if fact_key not in fact.columns:
        return Enriched(fact, f"fact has no key column {fact_key!r}")
    missing = [c for c in (dim_key, *attrs) if c not in dim.columns]
    if missing:
        return Enriched(fact, f"dimension lacks columns {missing}")
    usable = dim.select(F.col(dim_key).alias("__dim_key"), *attrs).dropna(subset=list(attrs))   # P4, F2
    rows, size = measured(usable)
    if rows == 0:
        return Enriched(fact, "dimension holds no usable row")
    limit = broadcast_bytes(fact.sparkSession) if broadcast_limit is None else broadcast_limit
    if size <= limit:
        joined = fact.join(F.broadcast(usable), F.col(fact_key) == F.col("__dim_key"), "inner")
    else:
        # read by the count of its keys and by the join
        fact = cut_lineage(fact, "fact")
        some = may_match(fact, F.col(fact_key), usable, "__dim_key", rows)
        joined = shuffled_lookup(some, fact_key, usable, "__dim_key", "inner", partitions)
    return Enriched(joined.drop(fact_key, "__dim_key"), None)


def enrich_from_csv(fact: DataFrame, spark: SparkSession, path: str, fact_key: str,
                    dim_key: str = "tailnum", attrs=("model", "engine_type")) -> Enriched:
    """On any failed check the fact comes back unchanged with a reason."""
    read = read_dimension_csv(spark, path)
    if read.frame is None:
        return Enriched(fact, read.reason)
    return join_dimension(fact, read.frame, fact_key, dim_key, attrs)


class DuplicateKeyError(ValueError):
    pass


def lookup(fact: DataFrame, column: str, dim: DataFrame, out: str, code: str = "code",
           value: str = "city", duplicates: str = "error", order: str | None = None,
           broadcast_limit: int | None = None, partitions: int | None = None) -> DataFrame:
    """Left-join a (code, value) table and add ``out``; unmatched -> null.

    Duplicate codes: ``error`` raises, ``smallest`` keeps the smallest value,
    ``last`` the value of the largest ``order`` (a map literal's rule),
    ``all`` keeps every match (rows multiply)."""
    table = dim.select(F.col(code).alias("__code"), F.col(value).alias("__value"),
                       *([F.col(order).alias("__order")] if order else []))
    if duplicates == "smallest":
        table = table.groupBy("__code").agg(F.min("__value").alias("__value"))
    elif duplicates == "last":
        if order is None:
            raise ValueError("duplicates='last' needs an order column")
        table = table.groupBy("__code").agg(F.max_by("__value", "__order").alias("__value"))
    elif duplicates == "error":
        dup = table.groupBy("__code").count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"code {dup[0]['__code']!r} appears more than once")
    elif duplicates != "all":
        raise ValueError(f"unknown duplicate policy {duplicates!r}")
    table = table.select("__code", "__value")
    limit = broadcast_bytes(fact.sparkSession) if broadcast_limit is None else broadcast_limit
    if measured(table)[1] <= limit:
        joined = fact.join(F.broadcast(table), F.col(column) == F.col("__code"), "left")
    else:
        joined = shuffled_lookup(fact, column, table, "__code", "left", partitions)
    return joined.select(*fact.columns, F.col("__value").alias(out))
