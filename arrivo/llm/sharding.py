"""Operator 9, sharding by sampled splitters.

Rows are ordered by (md5 of the text, doc_id), so equal texts are
neighbours. A size-weighted sample of bounded size gives quantile splitters;
every row finds its range by binary search in them, ranges that hold too
many bytes are given more splitters, and running sums inside the ranges give
each row its exact place in the whole order. Shards are equal stretches of
bytes of that order. A cut that falls into a group of equal texts moves to
the nearer end of the group unless the group is large, so small groups stay
in one shard and a hot group is spread over as many as it needs.

The places are exact, so the sample affects only how evenly the work is
spread, never the result. Null texts count as empty; null doc_ids come
first; repeated rows are interchangeable; an empty table gives no rows.
Built-in expressions only.
"""

from __future__ import annotations

import bisect
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm.common import table, uniform
from arrivo.session import cut_lineage

SHARDS = 24
#: Every row counts this much more than its text; fixed by the data contract.
ROW_BYTES = 8
#: Rows that one window task should hold, and sample rows for each range.
ROWS_PER_RANGE, SAMPLES_PER_RANGE, MIN_RANGES = 500_000, 16, 192
#: A range is overfull above this many times the mean range, and above this
#: many rows.
OVERFULL, OVERFULL_ROWS = 3, 2000
#: Groups of equal texts up to this share of a shard are kept whole.
WHOLE_GROUP = 0.05

KEY = "struct<h:string,doc_id:bigint,rid:bigint>"


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """One narrow row for each document; ``rid`` tells repeated rows apart."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.md5(t).alias("h"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"), F.monotonically_increasing_id().alias("rid"))


def _sample(rows: DataFrame, total: int, wanted: int) -> list:
    """About ``wanted`` keys, each row drawn with a chance that grows with
    its size; sorted."""
    chance = F.col("size") * (float(wanted) / max(total, 1))
    hit = rows.filter(uniform(F.col("h"), F.col("rid"), F.lit("splitters")) < chance)
    return sorted((tuple(r) for r in hit.select("h", "doc_id", "rid").collect()), key=_order)


def _order(key: tuple) -> tuple:
    """Sort key with nulls first, as Spark compares structs."""
    h, doc_id, rid = key
    return (h, doc_id is not None, doc_id or 0, rid is not None, rid or 0)


def _range_of(splitters: list):
    """Number of splitters at or below a row's key: a binary search."""
    if not splitters:
        return F.lit(0)
    # one constant, folded into an array when the plan is made
    bounds = F.from_json(F.lit(json.dumps([dict(zip(("h", "doc_id", "rid"), s)) for s in splitters])),
                         f"array<{KEY}>")
    key = F.struct("h", "doc_id", "rid")
    steps = [1 << k for k in range(len(splitters).bit_length() - 1, -1, -1)]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(bounds, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at))


def splitters_of(rows: DataFrame, total: int, count: int) -> list:
    """Splitters that leave no range overfull. A first sample cuts between
    texts; overfull ranges are sampled again and cut inside a text as well."""
    ranges = max(MIN_RANGES, -(-count // ROWS_PER_RANGE))
    sample = _sample(rows, total, ranges * SAMPLES_PER_RANGE)
    step = max(1, len(sample) // ranges)
    splitters = sorted({(h, None, None) for h, _, _ in sample[step::step]}, key=_order)
    limit = max(OVERFULL * count / ranges, OVERFULL_ROWS)
    for _ in range(6):
        full = [r for r in rows.groupBy(_range_of(splitters).alias("range"))
                .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
                if r["rows"] > limit]
        if not full:
            break
        inside = rows.withColumn("range", _range_of(splitters)).filter(
            F.col("range").isin([r["range"] for r in full]))
        wanted = SAMPLES_PER_RANGE * sum(int(-(-r["bytes"] * ranges // total)) for r in full)
        more = _sample(inside, sum(r["bytes"] for r in full), wanted)
        at = [_order(s) for s in splitters]
        by_range: dict[int, list] = {}
        for key in more:
            by_range.setdefault(bisect.bisect_right(at, _order(key)), []).append(key)
        new = {k for keys in by_range.values() for k in keys[SAMPLES_PER_RANGE // 2::SAMPLES_PER_RANGE // 2]}
        new |= {(h, None, None) for h, _, _ in new}
        if not new - set(splitters):
            break
        splitters = sorted(new | set(splitters), key=_order)
    return splitters


def placed(rows: DataFrame, splitters: list) -> DataFrame:
    """Rows with ``place`` (number of rows before) and ``start`` (bytes
    before) in the order of the keys."""
    ranged = rows.withColumn("range", _range_of(splitters))
    totals = ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("range").orderBy("h", "doc_id", "rid")
    summed = ranged.select(
        "*", (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("b1"),
        (F.row_number().over(inside) - 1).alias("n1"))
    # one row for each splitter, whose number is bounded above
    return summed.join(F.broadcast(offsets), "range").select(
        "h", "doc_id", "size", "text_crc32", (F.col("b0") + F.col("b1")).alias("start"),
        (F.col("n0") + F.col("n1")).cast("long").alias("place"))


def cut_points(rows: DataFrame, total: int, shards: int) -> list[int]:
    """Byte positions at which shards 1, 2, ... begin. At most one group for
    each cut is looked at."""
    cuts = [-(-k * total // shards) for k in range(1, shards)]
    spans = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    hit = rows.filter(F.exists(spans, lambda c: (c > F.col("start")) & (c < F.col("start") + F.col("size")))
                      | F.col("start").isin(cuts))
    hashes = [r["h"] for r in hit.select("h").distinct().collect()]
    groups = rows.filter(F.col("h").isin(hashes)).groupBy("h").agg(
        F.min("start").alias("lo"), F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    out = []
    for c in cuts:
        for g in groups:
            lo, hi = g["lo"], g["lo"] + g["bytes"]
            if lo < c < hi and g["n"] > 1 and g["bytes"] <= WHOLE_GROUP * total / shards:
                c = lo if c - lo <= hi - c else hi
        out.append(c)
    return out


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (place in the shard from 0)
    of every row; shards hold nearly equal bytes."""
    rows = cut_lineage(keyed(docs, text), "shard-keys")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    whole = cut_lineage(placed(rows, splitters_of(rows, total, count)), "shard-places")
    cuts = cut_points(whole, total, shards) if count else []
    shard = sum((F.when(F.col("start") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    out = whole.withColumn("shard", shard.cast("int"))
    first = out.groupBy("shard").agg(F.min("place").alias("first"))  # one row for each shard
    return out.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))

