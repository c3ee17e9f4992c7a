"""Lookup joins with a measured size and hot-key salting.

A lookup table is broadcast only if its measured bytes fit the session's
broadcast threshold. Beyond it the join shuffles, and keys that would
overfill a reducer are salted: their rows on the big side are spread over
``salt`` buckets, the matching small-side rows are repeated once per bucket.
A key is hot when its rows exceed ``HOT_PARTITIONS`` mean shuffle partitions,
so the limit follows the partition size and at most
``partitions / HOT_PARTITIONS`` keys are hot.

An inner join beyond the threshold first leaves out rows of the big side that
cannot match: one bit for the hash of every key of the small side, in bitmaps
that an aggregate builds. They take ``BITS_PER_KEY`` bits a key, a small part
of the table itself, and are broadcast if that is within the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.session import cut_lineage, default_parallelism, drop_cut

HOT_PARTITIONS = 2
#: Buckets of rows without a key.
NULL_BUCKETS = 1 << 30
#: Bits of the key filter for each key: of the rows without a match, one in
#: that many stays for the join to remove.
BITS_PER_KEY = 16
#: Bits of one row of the filter, as the bitmap functions have it.
BITMAP_BITS = 32_768
#: Bytes of a row beside its text, as an in-memory hash table holds it.
ROW_OVERHEAD = 32


def broadcast_bytes(spark: SparkSession) -> int:
    """The session's broadcast threshold; -1 if broadcasts are off."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a small table, in one pass."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(ROW_OVERHEAD))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows, size


def filter_maps(rows: int, limit: int) -> int:
    """Bitmaps for ``rows`` keys: BITS_PER_KEY bits a key, or half or a
    quarter of that if ``limit`` bytes hold no more; 0 if even that is beyond
    it."""
    for bits in (BITS_PER_KEY, BITS_PER_KEY // 2, BITS_PER_KEY // 4):
        maps = max(1, -(-rows * bits // BITMAP_BITS))
        if maps * BITMAP_BITS // 8 <= limit:
            return maps
    return 0


def _place(key: Column, maps: int) -> tuple[Column, Column]:
    """Bitmap and bit of a key among ``maps`` bitmaps."""
    bit = F.pmod(F.xxhash64(key.cast("string")), F.lit(maps * BITMAP_BITS))
    return F.floor(bit / BITMAP_BITS), (bit % BITMAP_BITS).cast("int")


def key_filter(keys: DataFrame, key: str, rows: int, maps: int | None = None) -> tuple[DataFrame, int]:
    """(map, bits) of the non-null keys of a table of ``rows`` rows, and the
    number of bitmaps."""
    maps = maps or max(1, -(-rows * BITS_PER_KEY // BITMAP_BITS))
    no, bit = _place(F.col(key), maps)
    held = keys.filter(F.col(key).isNotNull()).select(no.alias("__map"), bit.cast("long").alias("__bit"))
    return held.groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__bits")), maps


def may_match(big: DataFrame, big_key: Column, keys: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows of ``big`` whose key may be one of the ``rows`` keys; all rows if
    the filter would be too large to broadcast."""
    maps = filter_maps(rows, broadcast_bytes(big.sparkSession))
    if not maps:
        return big
    held, maps = key_filter(keys, key, rows, maps)
    no, bit = _place(big_key, maps)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return big.join(F.broadcast(held), (no == F.col("__map")) & (F.getbit(byte, bit % 8) == 1), "left_semi")


def hot_keys(freq: DataFrame, key: str, count: str, total: int, partitions: int) -> list:
    """Keys of ``freq`` that would overfill a reducer."""
    limit = HOT_PARTITIONS * total / max(partitions, 1)
    return [r[0] for r in freq.filter(F.col(count) > limit).select(key).collect()]


def salted_join(big: DataFrame, big_key: Column, small: DataFrame, small_key: str,
                hot: list, salt: int, how: str, spread_nulls: bool = False) -> DataFrame:
    """Equi-join ``big`` to ``small`` on ``big_key == small[small_key]``. In a
    left join, ``spread_nulls`` deals rows without a key to many buckets, for
    which nothing is repeated.

    The bucket comes from the row and its partition, so equal rows are
    spread as well and a task that runs again deals its rows alike. The salt
    column names are private and dropped from the result."""
    if salt <= 1 or not (hot or spread_nulls):
        return big.join(small, big_key == F.col(small_key), how)
    spread = F.xxhash64(*[F.col(c) for c in big.columns]) + F.spark_partition_id()
    bucket = F.when(big_key.isin(hot), F.pmod(spread, F.lit(salt)))
    if spread_nulls:
        bucket = bucket.when(big_key.isNull(), F.pmod(spread, F.lit(NULL_BUCKETS)))
    big_s = big.withColumn("__salt", bucket.otherwise(F.lit(0)).cast("int"))
    small_s = small.withColumn(
        "__salt_s",
        F.explode(F.when(F.col(small_key).isin(hot), F.sequence(F.lit(0), F.lit(salt - 1)))
                  .otherwise(F.array(F.lit(0)))))
    cond = (big_key == F.col(small_key)) & (F.col("__salt") == F.col("__salt_s"))
    return big_s.join(small_s, cond, how).drop("__salt", "__salt_s")


def shuffled_lookup(fact: DataFrame, fact_key: str, side: DataFrame, side_key: str, how: str,
                    partitions: int | None = None) -> DataFrame:
    """Join without broadcast: the fact's keys are counted once (partial
    aggregation) and those hot for ``partitions`` (the session's shuffle
    partitions by default) are salted."""
    parts = partitions or default_parallelism(fact.sparkSession)
    freq = cut_lineage(fact.groupBy(F.col(fact_key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")), "keys")
    total = freq.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    hot = hot_keys(freq.filter(F.col("__key").isNotNull()), "__key", "__n", total, parts)
    drop_cut(freq)
    return salted_join(fact, F.col(fact_key), side, side_key, hot, parts, how)
