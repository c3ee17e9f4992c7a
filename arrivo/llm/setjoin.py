"""Operator 13, N-gram Jaccard join by T-occurrence search (DivideSkip).

A document's set holds the 64-bit hashes of its distinct word shingles; equal
sets (128-bit key) are one. Two sets are linked when their Jaccard similarity
reaches the limit, so a set of n shares at least T = ceil(limit * n) hashes
with every partner. The search for partners is a T-occurrence problem on the
inverted lists of the set's hashes, which Spark narrows and deals out first:

1. Prefix test. In hash order, the first n - T + l hashes of a set hold at
   least l that a partner has in its own prefix (l as of the smallest partner).
   Only prefixes are shuffled; a hash that many sets of a block of rows hold
   leaves the block once. Sets whose prefix shares too little have no partner.
2. List lengths. The rest is read again as whole sets, their inverted lists
   are counted, and sets with fewer than T hashes in lists of two or more are
   done. The r - T + 1 shortest lists of a set of r such hashes hold all its
   partners, so sets that meet in such a short list form one neighbourhood
   (a component), and no link leaves it.
3. Search. Neighbourhoods are dealt to tasks of about ``TASK_HASHES`` hashes.
   A task indexes its sets in order of size and searches each one's larger
   partners: DivideSkip leaves out the L longest lists, merges the others with
   a heap for sets that occur T - L times (skipping ahead in lists that cannot
   help), and probes the long lists by binary search. What reaches the exact
   overlap is a link. Sets known to be connected are not compared again, so a
   dense group costs a search, not all its pairs.

A neighbourhood too large for a task is dealt in chunks that share some pivot
sets; what stays outside its largest component after that is searched, in
blocks, against every chunk. Nothing is left out.

Null and empty texts and texts without words have an empty set and their own
doc_id as component. Null doc_ids count as larger than all others. Repeated
rows and copies share a set; fewer words than a shingle make one shingle. An
empty table gives no rows. Hashes of different shingles of two compared sets
are taken to differ (probability of an error below 1e-12 a pair of texts).
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm.common import batches_of, table
from arrivo.llm.simhash import components
from arrivo.operators.joins import measured
from arrivo.session import cut_lineage, drop_cut

SHINGLE_WORDS = 5
PERCENT = 80
#: Share of a set by which its prefix is longer than one common hash needs.
LONGER = 20
#: Hashes that a search task holds; a neighbourhood beyond twice that is split.
TASK_HASHES = 1 << 19
PIVOTS = 16
#: Rows whose prefixes are compared before they are shuffled; prefix hashes of a shuffled part.
BLOCK_ROWS, PART_HASHES = 8_192, 1 << 20
#: Weight of the probes against the merge in the number of long lists.
MU = 0.0085
CACHED_WORDS = 1 << 20
#: Bytes of the list of texts to read again up to which it is broadcast.
BROADCAST_BYTES = 32 << 20


class _Words(dict):
    """Hashes of words, computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    def __init__(self, words: int = SHINGLE_WORDS):
        self.words, self.seen = words, _Words()
        self.odd = [np.uint64(xxhash.xxh3_64_intdigest(bytes([i])) | 1) for i in range(words + 1)]

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles of a text."""
        ws = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
        if not ws:
            return np.empty(0, np.uint64)
        if len(ws) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(ws))], dtype=np.uint64)
        h = np.fromiter(map(self.seen.__getitem__, ws), np.uint64, len(ws))
        n = len(ws) - self.words + 1
        out = h[:n] * self.odd[0]
        for i in range(1, self.words):
            out += h[i:i + n] * self.odd[i]
        # mixed, so that the order of hashes is as good as random
        for shift in (32, 29):
            out ^= out >> np.uint64(shift)
            out *= self.odd[-1]
        return np.unique(out ^ (out >> np.uint64(32)))


def least_overlap(n: int | np.ndarray, percent: int = PERCENT) -> int | np.ndarray:
    """Hashes that a set of n shares at least with every partner."""
    return -(-percent * n // 100)


def overlap_of(n: int, m: int | np.ndarray, percent: int = PERCENT) -> int | np.ndarray:
    """Common hashes that two sets of n and m need to be linked."""
    return -(-percent * (n + m) // (100 + percent))


def longer_by(n: int) -> int:
    return max(1, n // LONGER)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - least_overlap(n, percent) + longer_by(n) if n else 0


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _sets(docs: DataFrame, whole: bool, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n, k1, k2 (key of the set) and the whole sorted set
    or its prefix as ``hashes``, for (doc_id, text_hash, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.hashes(t.as_py()) for t in batch.column("text")]
            keys = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets],
                            dtype=np.int64).reshape(-1, 2)
            held = sets if whole else [s[:prefix_length(len(s), percent)] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys[:, 0]), pa.array(keys[:, 1]), _lists(held)],
                ["doc_id", "text_hash", "n", "k1", "k2", "hashes"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, n long, k1 long, k2 long, hashes array<long>")


#: What a posting says: one set of a block holds the hash, several do, or
#: (under any hash) its set shares a hash with another of the block.
ONE, SEVERAL, SHARED = 0, 1, 2


def _block_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One posting (h, k1) for each distinct prefix hash of a block of rows
    and one for each set and hash that the set shares inside the block; the
    latter are spread over all hashes, as nothing is to meet there."""
    for some in _gathered(batches):
        k1 = some.column("k1").to_numpy()
        one = np.unique(k1, return_index=True)[1]  # copies in a block are one set
        hashes = some.column("hashes").combine_chunks().take(pa.array(one))
        flat = hashes.flatten().to_numpy()
        own = np.repeat(k1[one], np.diff(hashes.offsets.to_numpy()))
        start, many, shared = _credited(flat, own, np.zeros(len(flat), bool))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([flat[start], flat[shared] ^ own[shared]])),
             pa.array(np.concatenate([own[start], own[shared]])),
             pa.array(np.concatenate([np.where(many, SEVERAL, ONE), np.full(len(shared), SHARED)]), pa.int8())],
            ["h", "k1", "says"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _credited(h: np.ndarray, k1: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of postings (h, k1): the index of one for each hash, whether several
    sets hold the hash (or a posting is marked ``shared``), and the indices of
    one posting for each set and hash that several sets hold."""
    by = np.lexsort((k1, h))
    h, k1, shared = h[by], k1[by], shared[by]
    new, other = np.ones(len(h), bool), np.zeros(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    other[1:] = ~new[1:] & (k1[1:] != k1[:-1])
    start = np.flatnonzero(new)
    many = np.add.reduceat(other | shared, start) > 0 if len(h) else new
    return by[start], many, by[many[np.cumsum(new) - 1] & (new | other)] if len(h) else by


def _part_credits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set (k1) of each hash that it shares with another set."""
    held = list(batches)
    if held:
        h, k1, says = (pa.Table.from_batches(held).column(c).to_numpy() for c in ("h", "k1", "says"))
        done = says == SHARED
        h, its, several = h[~done], k1[~done], says[~done] == SEVERAL
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([k1[done], its[_credited(h, its, several)[2]]]))], ["k1"])


def _hopeful(rows: DataFrame, percent: int) -> DataFrame:
    """(doc_id, text_hash) of one row for each set whose prefix shares enough."""
    sets = rows.filter("n > 0")
    total = sets.agg(F.sum(F.size("hashes"))).first()[0] or 0
    parts = max(1, -(-total // PART_HASHES))
    posted = sets.select("k1", "hashes").mapInArrow(_block_postings, "h long, k1 long, says tinyint")
    credits = posted.repartition(parts, "h").mapInArrow(_part_credits, "k1 long").groupBy("k1").agg(
        F.count("*").alias("common"))
    # the smallest partner of a set decides how many common hashes the prefixes hold
    smallest = F.floor((F.col("n") * percent + 99) / 100)
    need = F.greatest(F.lit(1), F.floor(smallest / LONGER))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    return cut_lineage(sets.drop("hashes").join(credits, "k1").filter(F.col("common") >= need).groupBy("k1", "k2").agg(
        first).select("first.doc_id", "first.text_hash").distinct(), "jaccard-hopeful")


def _neighbourhoods(sets: DataFrame, percent: int) -> DataFrame:
    """(sid, root): sets that meet in short lists, with their component."""
    lists = sets.select("sid", "n", F.explode("hashes").alias("h"))
    lengths = lists.groupBy("h").agg(F.count("*").alias("len")).filter("len > 1")
    mine = lists.join(lengths, "h").groupBy("sid", "n").agg(F.collect_list(F.struct("len", "h")).alias("lists"))
    need = F.floor((F.col("n") * percent + 99) / 100).cast("int")
    short = cut_lineage(mine.filter(F.size("lists") >= need).select(
        "sid", F.explode(F.slice(F.array_sort("lists"), F.lit(1), F.size("lists") - need + 1)).alias("l")).select(
        "sid", "l.h"), "jaccard-short")
    least = short.groupBy("h").agg(F.min("sid").alias("least"), F.count("*").alias("len")).filter("len > 1")
    edges = short.join(least, "h").filter("sid <> least").select(F.col("sid").alias("a"), F.col("least").alias("b"))
    linked = components(edges.distinct())
    drop_cut(short)
    return linked.select(F.col("v").alias("sid"), "root").unionByName(
        linked.select(F.col("root").alias("sid"), "root").distinct())


class Index:
    """Inverted lists of sets in order of size; ``connected`` labels the sets
    that need no comparison any more."""

    def __init__(self, sets: list[np.ndarray], connected: np.ndarray, percent: int = PERCENT):
        self.percent, self.connected = percent, connected.copy()
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        by = np.argsort(flat, kind="stable")  # so the members of a list ascend
        self.members = np.repeat(np.arange(len(sets)), self.sizes)[by]
        new = np.concatenate([[True], flat[by][1:] != flat[by][:-1]]) if len(flat) else np.empty(0, bool)
        ends = np.append(np.flatnonzero(new)[1:], len(flat)) if len(flat) else np.empty(0, np.int64)
        # where each hash of a set stands in the lists, and where its list ends
        self.at = np.empty(len(flat), np.int64)
        self.at[by] = np.arange(len(flat))
        self.end = ends[np.cumsum(new) - 1][self.at] if len(flat) else ends
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def later_lists(self, q: int) -> list[np.ndarray]:
        """For each hash of set q, the later sets that hold it, could be large
        enough partners and are not connected to q yet; empty ones left out."""
        here = slice(self.first[q], self.first[q + 1])
        start, length = self.at[here] + 1, self.end[here] - self.at[here] - 1
        some = length > 0
        start, length = start[some], length[some]
        if len(start) < overlap_of(self.sizes[q], self.sizes[q], self.percent):
            return []
        line = np.repeat(np.arange(len(start)), length)
        who = self.members[np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())]
        keep = (self.connected[who] != self.connected[q]) & (self.sizes[who] * self.percent <= 100 * self.sizes[q])
        line, who = line[keep], who[keep]
        return np.split(who, np.flatnonzero(np.diff(line)) + 1) if len(who) else []

    def partners(self, q: int) -> Iterator[int]:
        """Later sets linked to set q."""
        n = int(self.sizes[q])
        need = overlap_of(n, n, self.percent)  # with a partner of the same size at least
        lists = sorted(self.later_lists(q), key=len)
        if len(lists) < need:
            return
        long = min(need - 1, int(need / (MU * math.log2(len(lists[-1]) + 1) + 1)))
        cut = len(lists) - long
        found = merge_skip([x.tolist() for x in lists[:cut]], need - long)
        if not found:
            return
        who, count = np.array(list(found)), np.array(list(found.values()))
        needs = overlap_of(n, self.sizes[who], self.percent)
        for i, members in enumerate(lists[cut:]):
            place = np.searchsorted(members, who)
            count += members[np.minimum(place, len(members) - 1)] == who
            if i % 16 == 15:
                able = count + (long - i - 1) >= needs
                who, count, needs = who[able], count[able], needs[able]
                if not len(who):
                    return
        yield from who[count >= needs].tolist()

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that connect all linked sets, thinned to a forest."""
        for q in range(len(self.sizes)):
            for other in self.partners(q):
                mine, its = self.connected[q], self.connected[other]
                if mine != its:
                    self.connected[self.connected == its] = mine
                    yield q, other


def merge_skip(lists: list[list[int]], times: int) -> dict[int, int]:
    """Numbers that occur in ``times`` of the ascending lists at least, with
    how often. Lists that cannot reach the count at their present number are
    moved ahead to the least number that can."""
    place = [0] * len(lists)
    heap = [(x[0], i) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    out = {}
    while len(heap) >= times:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= times:
            out[top] = len(popped)
            ahead = top + 1
        else:
            while len(popped) < times - 1:
                popped.append(heapq.heappop(heap)[1])
            ahead = heap[0][0]
        for i in popped:
            place[i] = bisect_left(lists[i], ahead, place[i])
            if place[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][place[i]], i))
    return out


def _task_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("sid").sort_values(["n", "sid"])
    sid = pdf["sid"].to_numpy()
    known = pd.factorize(pdf["known"])[0]
    pairs = list(Index([np.asarray(h, np.int64) for h in pdf["hashes"]], known, percent).links())
    a, b = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
    return pd.DataFrame({"a": sid[a], "b": sid[b]})


def _searched(dealt: DataFrame, by: list[str], percent: int) -> DataFrame:
    """Links found in each group of ``dealt`` (sid, n, hashes, known); sets of
    equal ``known`` are connected already."""
    return dealt.groupBy(*by).applyInPandas(lambda pdf: _task_links(pdf, percent), "a long, b long")


def _links(near: DataFrame, percent: int, task_hashes: int) -> DataFrame:
    """(a, b): links that connect all linked sets of ``near`` (sid, n,
    hashes, root). Neighbourhoods never share a link."""
    weights = cut_lineage(near.groupBy("root").agg(F.sum("n").alias("weight"), F.count("*").alias("sets")),
                          "jaccard-weights")
    total = weights.agg(F.sum("weight")).first()[0] or 0
    bins = max(1, -(-total // task_hashes))
    large = weights.filter(F.col("weight") > 2 * task_hashes).select(
        "root", F.ceil(F.col("weight") / task_hashes).alias("chunks"))
    near = near.withColumn("known", F.col("sid"))
    small = near.join(weights.filter(F.col("weight") <= 2 * task_hashes).select("root"), "root").withColumn(
        "bin", F.pmod(F.xxhash64("root"), F.lit(bins)))
    found = cut_lineage(_searched(small.select("bin", "sid", "n", "hashes", "known"), ["bin"], percent), "jaccard-links")
    if large.isEmpty():
        return found
    # a chunk of a large neighbourhood is searched with the pivots that all its chunks share
    split = near.join(large, "root").withColumn("chunk", F.pmod(F.xxhash64("sid"), F.col("chunks")))
    numbered = Window.partitionBy("root").orderBy(F.xxhash64("sid"), "sid")
    pivots = split.select("root", "sid").withColumn("no", F.row_number().over(numbered)).filter(
        F.col("no") <= PIVOTS).select("root", "sid")
    held = ["root", "chunk", "sid", "n", "hashes", "known"]
    everywhere = split.join(pivots, ["root", "sid"]).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    first = cut_lineage(_searched(split.select(*held).unionByName(everywhere.select(*held)), ["root", "chunk"], percent),
                        "jaccard-links")
    # what the largest component leaves over is searched against every chunk
    roots = components(first).withColumnRenamed("v", "sid").withColumnRenamed("root", "own")
    now = split.drop("known").join(roots, "sid", "left").withColumn("known", F.coalesce("own", "sid"))
    sizes = now.groupBy("root", "known").agg(F.count("*").alias("sets"), F.sum("n").alias("hashed"))
    largest = sizes.groupBy("root").agg(F.max(F.struct("sets", "known")).alias("largest"))
    others = cut_lineage(sizes.join(largest, "root").filter("known <> largest.known").select("root", "known", "hashed"),
                         "jaccard-others")
    load = others.groupBy("root").agg(F.ceil(F.sum("hashed") / task_hashes).alias("blocks"))
    asked = now.join(others.select("root", "known"), ["root", "known"]).join(load, "root")
    held = ["root", "chunk", "block", "sid", "n", "hashes", "known"]
    asked = asked.withColumns({"block": F.pmod(F.xxhash64("sid", F.lit("block")), F.col("blocks")),
                               "chunk": F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))})
    against = now.join(load, "root").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    second = cut_lineage(_searched(asked.select(*held).unionByName(against.select(*held)),
                                   ["root", "chunk", "block"], percent), "jaccard-links")
    return found.unionByName(first).unionByName(second)


def jaccard_components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
                       text: str = "text", task_hashes: int = TASK_HASHES) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (the
    smallest doc_id that links of ``percent`` similarity reach)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                        F.col(text).alias("text"))
    with batches_of(spark):
        rows = cut_lineage(_sets(texts, False, shingle_words, percent), "jaccard-rows")
    hopeful = _hopeful(rows, percent)
    prefixes, rows = rows, cut_lineage(rows.drop("hashes", "text_hash"), "jaccard-documents")
    drop_cut(prefixes)
    again = F.broadcast(hopeful) if measured(hopeful)[1] <= BROADCAST_BYTES else hopeful
    wanted = again.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    with batches_of(spark):
        sets = _sets(texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (
            F.col("text_hash") == F.col("__hash")), "left_semi"), True, shingle_words, percent)
        sets = cut_lineage(sets.select("k1", "k2", "n", "hashes").dropDuplicates(["k1", "k2"]).withColumn(
            "sid", F.monotonically_increasing_id()), "jaccard-sets")
    near = cut_lineage(sets.select("sid", "n", "hashes").join(_neighbourhoods(sets, percent), "sid"), "jaccard-near")
    roots = components(_links(near, percent, task_hashes))
    # back from sets to documents
    linked = roots.select(F.col("v").alias("sid"), "root").unionByName(
        roots.select(F.col("root").alias("sid"), "root").distinct()).join(sets.select("sid", "k1", "k2"), "sid")
    keys = rows.filter("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first")).join(
        linked.select("k1", "k2", "root"), ["k1", "k2"], "left")
    keys = cut_lineage(keys, "jaccard-keys")
    some = keys.filter("root is not null")
    smallest = some.groupBy("root").agg(F.min("first").alias("component"))
    keys = some.join(smallest, "root").select("k1", "k2", "component").unionByName(
        keys.filter("root is null").select("k1", "k2", F.col("first").alias("component")))
    out = rows.join(keys, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
    for done in (hopeful, sets, near, roots):
        drop_cut(done)
    return out


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
