"""Shared helpers of the training-data operators: tables, words, two-level running sums."""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed by the data contract: a word is a run of anything but these bytes.
WORD_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ids of a rank file, which each task reads from its own
    installation of the vocabularies."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows per Arrow batch, so that a batch of whole texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Rows per Arrow batch for the jobs that run inside; the session's own
    number comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words: separators inside the trimmed text, plus one."""
    return F.size(words(text)).cast("long")


def uniform(*cols: Column) -> Column:
    """A repeatable number in [0, 1) from the hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0 ** -53)


def bucket_rows(rows: int) -> int:
    """Rows of a bucket for two-level sums: as many as there are buckets,
    once there are many rows."""
    return max(2_000, math.isqrt(rows))


def hex_buckets(rows: int, per_bucket: int) -> int:
    """Hex digits of an even hash that make groups of about ``per_bucket``."""
    digits = 1
    while rows > per_bucket * 16 ** digits and digits < 8:
        digits += 1
    return digits


def running_sums(df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[Column],
                 values: dict[str, str]) -> DataFrame:
    """Inclusive running sums of ``values`` (column -> new column) within
    ``by``, in the order of ``bucket`` and then ``order``.

    Two levels: bucket totals are summed first, so no task holds more than
    one bucket however large the group is. ``by`` and ``bucket`` hold no
    nulls. ``df`` is read twice and must be repeatable."""
    # dealt by bucket as well, or an earlier exchange by ``by`` alone would be kept
    df = df.repartition(*by, bucket)
    totals = df.groupBy(*by, bucket).agg(
        *[F.sum(v).alias(f"__sum_{n}") for v, n in values.items()])
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, bucket, *[
        F.coalesce(F.sum(f"__sum_{n}").over(earlier), F.lit(0)).alias(f"__off_{n}")
        for n in values.values()])
    inside = (Window.partitionBy(*by, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = df.withColumns({n: F.sum(v).over(inside) for v, n in values.items()})
    out = out.join(offsets, [*by, bucket])
    return out.withColumns({n: F.col(n) + F.col(f"__off_{n}") for n in values.values()}).drop(
        *[f"__off_{n}" for n in values.values()])
