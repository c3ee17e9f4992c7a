"""Operator 5, mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a repeatable shuffled order, up to
three times over. An entry's virtual finish time is the number of words its
source has queued up to and including it, divided by the source's target.
All entries are then ordered by finish time over all sources, and the order
is cut where the words reach the budget, the size of the whole input.

Targets share the budget by weight; a target stops at three times its
source's size and the excess is shared again by weight, which is the level
of one water-filling sum over the sources ordered by cap over weight.

Rows with equal doc_id, source and size are counted first and then queued one
by one, each with a place of its own in the shuffled order, so the cut can
fall between them and a group of repeated rows, however large, is spread over
the buckets of the running sums. How often two of them are taken differs by
one at most. Where such rows differ in other columns, any of them may be the
ones taken once more. Null sources form a source of their own, the
last one; null texts and blank texts have size 0 and are never taken; an
empty table gives no rows. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm.common import bucket_rows, hex_buckets, running_sums, table, unused, word_count
from arrivo.session import cut_lineage

WEIGHTS = (5, 2, 1)  # fixed by the data contract, repeated over the sources
MAX_TIMES = 3
SEED = "mix-1"
#: Repeated rows that one task writes out, in a group of more.
COPY_CHUNK = 1024


def source_targets(entries: DataFrame, weights=WEIGHTS, max_times: int = MAX_TIMES) -> DataFrame:
    """source, source_size, target: one row for each source."""
    sizes = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (rank % len(weights)).cast("int"))
    caps = sizes.withColumn("rank", rank).withColumn("w", weight).withColumn(
        "cap", F.col("source_size") * max_times)
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("cap") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
             .cast("double")
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), F.lit(0))))
    levels = caps.withColumn("level", level).withColumn(
        "capped", F.col("cap") <= F.col("level") * F.col("w"))
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), "rank", "level")))
    return levels.withColumn("free", free.over(everything)["level"]).select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("free") * F.col("w"))
        .alias("target"))


def _each_copy(entries: DataFrame, most: int) -> DataFrame:
    """One row for each copy that an entry stands for, with its number from 0
    under ``copy``. ``most`` is the largest number of copies; large groups are
    dealt out in chunks."""
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPY_CHUNK).cast("long")))
    chunks = entries.withColumn("chunk", chunk)
    if most > COPY_CHUNK:
        chunks = chunks.repartition("doc_id", "size", "chunk")
    first = F.col("chunk") * COPY_CHUNK
    last = F.least(first + COPY_CHUNK, F.col("copies")) - 1
    return chunks.withColumn("copy", F.explode(F.sequence(first, last))).drop("chunk")


def mix(docs: DataFrame, weights=WEIGHTS, max_times: int = MAX_TIMES, seed: str = SEED,
        text: str = "text") -> DataFrame:
    """One row for each doc_id, source and size: copies (rows that it stands
    for), source_size, target, times (how often the mix takes them, all copies
    together)."""
    sized = docs.select("doc_id", "source", word_count(F.col(text)).alias("size"))
    entries = cut_lineage(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")),
                      "mix-entries")
    count, budget, most = entries.agg(
        F.coalesce(F.sum("copies"), F.lit(0)), F.coalesce(F.sum(F.col("size") * F.col("copies")), F.lit(0)),
        F.coalesce(F.max("copies"), F.lit(0))).first()
    # one row for each source, written so that its size is known: a small table
    # is broadcast and no exchange brings the rows of a source together
    targets = cut_lineage(source_targets(entries, weights, max_times).withColumn("sid", F.coalesce(
        F.concat(F.lit("s"), "source"), F.lit("null"))), "mix-targets")
    order = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                              F.when(F.col("copy") > 0, F.col("copy").cast("string"))))
    queued = _each_copy(entries, most).withColumn("sid", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))).join(
        targets.drop("source"), "sid").withColumn("u", order).withColumn(
        "bucket", F.substring("u", 1, hex_buckets(count, bucket_rows(count))))
    summed = running_sums(queued, ["sid"], "bucket", [F.col("u"), F.col("doc_id"), F.col("size")],
                          {"size": "queued"})
    rounds = F.when((F.col("size") > 0) & (F.col("target") > 0), F.least(
        F.lit(max_times - 1), F.floor(F.col("target") / F.col("source_size")).cast("int"))).otherwise(F.lit(0))
    finish = (F.col("round") * F.col("source_size") + F.col("queued")).cast("double") / F.col("target")
    slices = max(1, -(-count // bucket_rows(count)))
    timed = summed.withColumn("round", F.explode(F.sequence(F.lit(0), rounds))).withColumn(
        "finish", F.when((F.col("size") > 0) & (F.col("target") > 0), finish)).withColumn(
        "slice", F.coalesce(F.floor(F.col("finish") * slices), F.lit(-1)))
    timed = cut_lineage(timed.select("doc_id", "source", "sid", "size", "copies", "source_size", "target",
                                 "u", "round", "finish", "slice"), "mix-times")
    live = running_sums(timed.filter("slice >= 0"), [], "slice",
                        [F.col("finish"), F.col("sid"), F.col("u"), F.col("doc_id"), F.col("size")],
                        {"size": "mixed"})
    key = ["doc_id", "source", "size", "copies", "source_size", "target"]
    taken = live.select(*key, F.when(F.col("mixed") <= budget, 1).otherwise(0).alias("took")).unionByName(
        timed.filter("slice < 0").select(*key, F.lit(0).alias("took")))
    return taken.groupBy(*key).agg(F.sum("took").alias("times"))


def _times(nth: Column) -> Column:
    """How often the ``nth`` (from 1) of equal rows is taken."""
    return F.floor(F.col("times") / F.col("copies")).cast("long") + (nth <= F.col("times") % F.col("copies")).cast("int")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` with all their columns, each as often as the mix
    takes it."""
    by_id, source, size, often, n, more, key, part, place, one, nth = (
        unused(docs, f"__{c}") for c in ("id", "source", "size", "times", "n", "more", "key", "part", "place", "one", "nth"))
    taken = mix(docs, **options).filter("times > 0")
    times = cut_lineage(taken.select(
        F.col("doc_id").alias(by_id), F.col("source").alias(source), F.col("size").alias(size),
        F.floor(F.col("times") / F.col("copies")).cast("int").alias(often),
        (F.col("times") % F.col("copies")).alias(more)), "mix-taken")
    on = (F.col("doc_id").eqNullSafe(F.col(by_id)) & F.col("source").eqNullSafe(F.col(source))
          & (word_count(F.col(options.get("text", "text"))) == F.col(size)))

    def repeated(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(often) > 0).withColumn(
            n, F.explode(F.sequence(F.lit(1), F.col(often)))).select(*docs.columns)

    uneven = times.filter(F.col(more) > 0)
    out = repeated(docs.join(times.filter(F.col(more) == 0), on))
    if uneven.isEmpty():
        return out
    # repeated rows of which some are taken once more: numbered in two levels
    rows = cut_lineage(docs.join(uneven, on).withColumn(key, F.md5(F.concat_ws(
        "|", F.coalesce(F.col(by_id).cast("string"), F.lit("")), F.col(size).cast("string"),
        F.concat(F.lit("s"), F.col(source))))).withColumns(
        {part: F.spark_partition_id(), place: F.monotonically_increasing_id(), one: F.lit(1)}), "mix-uneven")
    numbered = running_sums(rows, [key], part, [F.col(place)], {one: nth})
    return out.unionByName(repeated(numbered.withColumn(
        often, F.col(often) + (F.col(nth) <= F.col(more)).cast("int"))))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = mix(table(spark, sf_dir, "documents"))
    return _each_copy(entries, 1).select(
        "doc_id", "size", "source_size", "target", (_times(F.col("copy") + 1) * F.col("size")).alias("taken"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, source,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
           FROM documents),
e AS (SELECT *, md5('mix-1|' || coalesce(doc_id::VARCHAR, '')
                    || CASE WHEN copy > 0 THEN '|' || copy ELSE '' END) AS u
      FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS copy FROM d)),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM e GROUP BY source),
c AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS w, 3 * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
                / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
      FROM c WINDOW b AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             CASE WHEN cap <= level * w THEN cap::DOUBLE
                  ELSE (SELECT arg_min(level, cap / w + rank * 1e-9) FROM l WHERE cap > level * w) * w END
             AS target FROM l),
q AS (SELECT e.*, source_size, target, coalesce('s' || e.source, 'null') AS sid,
             sum(size) OVER (PARTITION BY e.source ORDER BY u, doc_id NULLS FIRST, size
                              ROWS UNBOUNDED PRECEDING) AS queued
      FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, (round * source_size + queued)::DOUBLE / target AS finish
      FROM q, range(3) r(round)
      WHERE size > 0 AND target > 0 AND round <= floor(target / source_size)),
m AS (SELECT doc_id, source, size, copy, count(*) AS times FROM (
        SELECT *, sum(size) OVER (ORDER BY finish, sid, u, doc_id NULLS FIRST, size
                                  ROWS UNBOUNDED PRECEDING) AS mixed FROM f)
      WHERE mixed <= (SELECT sum(size) FROM e) GROUP BY doc_id, source, size, copy)
SELECT e.doc_id, e.size, source_size, target, coalesce(times, 0) * e.size AS taken
FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source
LEFT JOIN m ON e.doc_id IS NOT DISTINCT FROM m.doc_id AND e.source IS NOT DISTINCT FROM m.source
           AND e.size = m.size AND e.copy = m.copy
"""
