"""Dictionary encoding.

A dictionary maps each distinct key (as text) to its 0-based position in
sorted key order; a key not in the dictionary maps to -1. Columns listed in
one spec share a code space (Origin and Dest), which is the union of their
key sets.

Fit: ONE pass over the data for all dictionaries together: every row emits a
(dictionary, key) pair per encoded column, ``groupBy(dict, key).count()``
(partial aggregation first) gives each key and its frequency. Numbering is
distributed: range partition by (dict, key), sort within partitions, take a
partition-local row id, and write. A small table with one row per partition
and dictionary (the number of keys of the dictionary in earlier partitions) is
broadcast wherever codes are read. No global window, no driver-side key list.

Transform: dictionaries are taken from the smallest on, and as long as their
bytes together (measured by the fit) are within the session's threshold, each
of their columns is one broadcast left join. One or two columns that remain
meet their codes in shuffled left joins of the frame. More are encoded at once in
long form: the frame is written with a row number, each row emits (row,
column, dictionary key), these narrow rows join the codes once, and the codes
of a row come back to it in one join on the row number. Keys that the fit
found frequent are salted in both, rows without a key are spread.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivo.operators.joins import ROW_OVERHEAD, broadcast_bytes, hot_keys, salted_join
from arrivo.session import cut_lineage, default_parallelism, drop_cut

@dataclass(frozen=True)
class DictSpec:
    name: str
    columns: tuple[str, ...]


#: Columns with large dictionaries that meet their codes one after the other:
#: two joins of the frame move less than writing it with row numbers, two
#: narrow shuffles of every key and one of the frame.
MAX_JOINS = 2
#: Between a dictionary's name and a key, where both are one text.
SEPARATOR = "\u0000"


def number_sorted(freq: DataFrame) -> tuple[DataFrame, list]:
    """Codes (dict, key, freq, code) with code = 0-based rank of the key in
    its dictionary, and the number of keys, of occurrences and of bytes of
    each dictionary. ``freq``: dict, key, freq, the keys distinct."""
    ranged = (freq.repartitionByRange("dict", "key")
              .sortWithinPartitions("dict", "key")
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__rid", F.monotonically_increasing_id()))
    # ids must not change if a partition is recomputed: cut the lineage
    ranged = cut_lineage(ranged, "dictionary")
    # one row per (partition, dictionary): bounded by the partition count
    stats = ranged.groupBy("dict", "__pid").agg(
        F.count(F.lit(1)).alias("n"), F.min("__rid").alias("first"), F.sum("freq").alias("total"),
        F.sum(F.octet_length("key") + ROW_OVERHEAD).alias("bytes")).orderBy("dict", "__pid").collect()
    before: dict[str, int] = {}
    starts = []
    for r in stats:
        starts.append((r["dict"], r["__pid"], before.get(r["dict"], 0) - r["first"]))
        before[r["dict"]] = before.get(r["dict"], 0) + r["n"]
    offsets = freq.sparkSession.createDataFrame(starts, "dict string, __pid int, __start long")
    codes = ranged.join(F.broadcast(offsets), ["dict", "__pid"]).select(
        "dict", "key", "freq", (F.col("__start") + F.col("__rid")).alias("code"))
    return codes, stats


@dataclass
class DictionaryModel:
    specs: tuple[DictSpec, ...]
    codes: DataFrame            # dict, key, freq, code
    sizes: dict[str, int]       # distinct keys per dictionary
    totals: dict[str, int]      # key occurrences per dictionary
    bytes: int = 0              # of all dictionaries
    broadcast_limit: int | None = None
    partitions: int | None = None  # to judge hot keys; the session's by default
    written: list[DataFrame] = field(default_factory=list)  # frames numbered for the long form
    sized: dict[str, int] = field(default_factory=dict)     # bytes per dictionary

    def keys(self, name: str) -> DataFrame:
        """(key, code) of one dictionary (A4 / U1 kept distributed)."""
        return self.codes.filter(F.col("dict") == name).select("key", "code")

    def close(self) -> None:
        """Delete the written codes and frames; frames that read them are
        then void."""
        if self.specs:
            drop_cut(self.codes)
        for df in self.written:
            drop_cut(df)
        self.written.clear()

    def _with_broadcast(self, df: DataFrame, column: str, name: str) -> DataFrame:
        lut_key, lut_code = f"__k_{column}", f"__c_{column}"
        lut = self.keys(name).select(F.col("key").alias(lut_key), F.col("code").alias(lut_code))
        joined = df.join(F.broadcast(lut), F.col(column).cast("string") == F.col(lut_key), "left")
        return joined.select(*[
            F.coalesce(F.col(lut_code), F.lit(-1).cast("long")).alias(c) if c == column else F.col(c)
            for c in df.columns])

    def _with_shuffle(self, df: DataFrame, column: str, name: str) -> DataFrame:
        parts = self.partitions or default_parallelism(df.sparkSession)
        # the column itself is the key, so rows carry it once; whole numbers
        # meet the texts that a number is cast to as numbers
        key, code_key = F.col(column), F.col("key")
        if isinstance(df.schema[column].dataType, T.IntegralType):
            key, code_key = key.cast("long"), code_key.try_cast("long")
        else:
            key = key.cast("string")
        table = self.codes.filter((F.col("dict") == name) & (code_key.cast("string") == F.col("key"))).select(
            code_key.alias("__code_key"), F.col("code").alias("__code"), "freq")
        hot = hot_keys(table, "__code_key", "freq", self.totals.get(name, 0), parts)
        found = salted_join(df, key, table.drop("freq"), "__code_key", hot, parts, "left", spread_nulls=True)
        return found.select(*[F.coalesce(F.col("__code"), F.lit(-1).cast("long")).alias(c) if c == column else F.col(c)
                              for c in df.columns])

    def _in_long_form(self, df: DataFrame, todo: list[tuple[str, str]]) -> DataFrame:
        # the row number is written, so both sides of the last join agree on it
        numbered = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
        self.written.append(numbered)
        keys = F.array(*[F.struct(F.lit(i).alias("__pos"),
                                  F.concat(F.lit(name + SEPARATOR), F.col(c).cast("string")).alias("__key"))
                         for i, (c, name) in enumerate(todo)])
        long = numbered.select("__row", F.explode(keys).alias("k")).select("__row", "k.__pos", "k.__key").filter(
            F.col("__key").isNotNull())
        used = {name for _, name in todo}
        table = self.codes.filter(F.col("dict").isin(*used)).select(
            F.concat("dict", F.lit(SEPARATOR), "key").alias("__code_key"), "code", "freq")
        parts = self.partitions or default_parallelism(df.sparkSession)
        hot = hot_keys(table, "__code_key", "freq", sum(self.totals.get(n, 0) for n in used), parts)
        found = salted_join(long, F.col("__key"), table.drop("freq"), "__code_key", hot, parts, "inner")
        codes = found.groupBy("__row").agg(*[
            F.max(F.when(F.col("__pos") == i, F.col("code"))).alias(f"__c{i}") for i in range(len(todo))])
        place = {c: i for i, (c, _) in enumerate(todo)}
        return numbered.join(codes, "__row", "left").select(*[
            F.coalesce(F.col(f"__c{place[c]}"), F.lit(-1).cast("long")).alias(c) if c in place else F.col(c)
            for c in df.columns])

    def transform(self, df: DataFrame, skip=()) -> DataFrame:
        """``df`` with the columns of all dictionaries but ``skip`` encoded."""
        todo = [(c, s.name) for s in self.specs if s.name not in skip for c in s.columns if c in df.columns]
        limit = broadcast_bytes(df.sparkSession) if self.broadcast_limit is None else self.broadcast_limit
        small, used = {name for _, name in todo}, 0
        if self.bytes > limit:
            # a dictionary of unknown size counts as all of them
            size = {n: self.sized.get(n, self.bytes) for n in small}
            small = set()
            for n in sorted(size, key=lambda n: (size[n], n)):
                used += size[n]
                if used <= limit:
                    small.add(n)
        for c, name in todo:
            if name in small:
                df = self._with_broadcast(df, c, name)
        large = [(c, name) for c, name in todo if name not in small]
        if len(large) > MAX_JOINS:
            return self._in_long_form(df, large)
        for c, name in large:
            df = self._with_shuffle(df, c, name)
        return df


def fit_dictionaries(df: DataFrame, specs, broadcast_limit: int | None = None,
                     partitions: int | None = None) -> DictionaryModel:
    specs = tuple(DictSpec(s.name, tuple(c for c in s.columns if c in df.columns)) for s in specs)
    specs = tuple(s for s in specs if s.columns)
    if not specs:
        return dictionary_model(None, (), df.sparkSession, broadcast_limit, partitions)
    pairs = F.array(*[F.struct(F.lit(s.name).alias("dict"), F.col(c).cast("string").alias("key"))
                      for s in specs for c in s.columns])
    freq = (df.select(F.explode(pairs).alias("p"))
            .select("p.dict", "p.key")
            .filter(F.col("key").isNotNull())
            .groupBy("dict", "key").agg(F.count(F.lit(1)).alias("freq")))
    return dictionary_model(freq, specs, df.sparkSession, broadcast_limit, partitions)


def dictionary_model(freq: DataFrame | None, specs, spark, broadcast_limit: int | None = None,
                     partitions: int | None = None) -> DictionaryModel:
    """Number the keys of ``freq`` (dict, key, freq) and wrap the result."""
    if freq is None or not specs:
        empty = spark.createDataFrame([], "dict string, key string, freq long, code long")
        return DictionaryModel((), empty, {}, {}, 0, broadcast_limit, partitions)
    codes, stats = number_sorted(freq)
    sizes, totals = ({n: sum(r[c] for r in stats if r["dict"] == n) for n in {r["dict"] for r in stats}}
                     for c in ("n", "total"))
    sized = {n: sum(r["bytes"] for r in stats if r["dict"] == n) for n in sizes}
    return DictionaryModel(tuple(specs), codes, sizes, totals, sum(sized.values()), broadcast_limit,
                           partitions, sized=sized)
