"""Row and column cleaning: whole-row dedup, fixed drops, the cancelled
filter, safe text-to-int casts, string and constant column drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivo.functions.casts import text_to_int
from arrivo.layout import Layout
from arrivo.operators.joins import broadcast_bytes, measured
from arrivo.session import cut_lineage, drop_cut


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Map-side partial aggregation collapses copies
    before the shuffle, so a row repeated many times costs one row per map
    task, not a hot reducer."""
    return df.distinct()


def dedup_in_order(df: DataFrame, key: str) -> DataFrame:
    """P1 for rows that a selective column ``key`` orders: one sort by it and
    the other columns, of which the first of equal rows is kept. ``distinct``
    holds whole rows in a hash table before and another after the shuffle;
    where the rows lie by ``key`` already and nothing is shuffled, both stand
    in one task, and spill from half as many rows on. Copies go before the
    shuffle as well, if there is one."""
    if any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in df.schema.fields):
        return dedup_rows(df)       # which gives both zeros alike
    same = Window.partitionBy(key, *[c for c in df.columns if c != key]).orderBy(key)
    return df.withColumn("__no", F.row_number().over(same)).filter("__no = 1").drop("__no")


def row_signature(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns. Nulls are marked, because the hash
    passes over them, and both zeros of a floating column hash alike."""
    parts = []
    for f in df.schema.fields:
        col = F.col(f.name)
        parts += [col + 0.0 if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else col, col.isNull()]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def signature_groups(df: DataFrame, kept: list[str], signed: list[Column]) -> DataFrame:
    """The kept columns by signature (``__s1``, ``__s2``), with their rows."""
    return df.select(*signed, *kept).groupBy("__s1", "__s2", *kept).agg(F.count(F.lit(1)).alias("__n"))


def dedup_to(df: DataFrame, kept, sign=row_signature) -> DataFrame:
    """P1 and then only the columns ``kept``: whole-row distinct without
    shuffling the other columns.

    Rows are grouped by their signature and the kept columns and written to
    the shared folder (``drop_cut`` deletes them). Only groups of several rows
    can hide a difference in the other columns: their rows are read again and
    compared column by column, and what differs in spite of an equal signature
    comes back as often as it is distinct."""
    kept = list(kept)
    signed = [c.alias(n) for c, n in zip(sign(df), ("__s1", "__s2"))]
    groups = cut_lineage(signature_groups(df, kept, signed), "signatures")
    several = groups.filter("__n > 1").select("__s1", "__s2").distinct()
    rows, size = measured(several)
    if rows:
        if size <= broadcast_bytes(df.sparkSession):
            several = F.broadcast(several)
        again = df.select("*", *signed).join(several, ["__s1", "__s2"], "left_semi").distinct()
        collided = cut_lineage(again.groupBy("__s1", "__s2", *kept).agg(F.count(F.lit(1)).alias("__m")).filter("__m > 1"),
                               "collisions")
        if not collided.isEmpty():
            more = collided.withColumn("__again", F.explode(F.expr("sequence(2, __m)")))
            return groups.select(*kept).unionByName(more.select(*kept))
        drop_cut(collided)
    return groups.select(*kept)


def drop_names(df: DataFrame, names) -> DataFrame:
    """Drop by exact name; absent names are ignored."""
    present = set(df.columns)
    return df.drop(*[n for n in names if n in present])


def keep_not_cancelled(df: DataFrame, col: str) -> DataFrame:
    """keep ``col = 0``; null is removed as well."""
    return df.filter(F.col(col) == 0)


def drop_and_filter(df: DataFrame, layout: Layout, unknown: tuple[str, ...] = ()) -> DataFrame:
    """P2 + F1 + P3 in the reference's order: unknown columns, the cancelled
    filter, then the fixed list."""
    out = drop_names(df, unknown)
    out = keep_not_cancelled(out, layout.cancelled)
    return drop_names(out, layout.fixed_drops)


def cast_text_columns(df: DataFrame, names) -> DataFrame:
    """X3 on every present column of ``names``, in place."""
    todo = [n for n in names if n in df.columns]
    if not todo:
        return df
    return df.withColumns({n: text_to_int(F.col(n)) for n in todo})


def drop_null_label(df: DataFrame, label: str) -> DataFrame:
    """A label that failed its cast must not reach training."""
    return df.filter(F.col(label).isNotNull())


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def drop_strings(df: DataFrame) -> DataFrame:
    """P5: drop every column still of type string."""
    return df.drop(*string_columns(df))


def single_valued(df: DataFrame, candidates) -> list[str]:
    """Present candidates holding a single distinct value.

    One pass of partial aggregates (min, max, null count) instead of a
    distinct per column: a column is single-valued when min = max and it has
    no null, or when it is entirely null."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return []
    aggs = []
    for c in present:
        aggs += [F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}"),
                 F.count(c).alias(f"nn_{c}")]
    row = df.agg(F.count(F.lit(1)).alias("__n"), *aggs).first()
    out = []
    for c in present:
        n, nn = row["__n"], row[f"nn_{c}"]
        if n == 0:
            continue
        if nn == 0 or (nn == n and row[f"mn_{c}"] == row[f"mx_{c}"]):
            out.append(c)
    return out


def drop_constant(df: DataFrame, candidates) -> DataFrame:
    """Drop candidates that hold a single distinct value."""
    return df.drop(*single_valued(df, candidates))
