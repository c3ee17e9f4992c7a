"""Operator 8, SimHash near-duplicates by a binary trie joined with itself.

Fingerprints are the leaves of a binary trie over their 64 bits. Two copies
of the trie are walked together as pairs of nodes that sum the bits in which
their paths differ; a pair goes no further once the sum exceeds the budget.

Upper levels: Spark deals every distinct fingerprint to the node pairs of
one depth that are still within the budget (a node and the masks of few
bits), so each pair is one group. Nodes that hold more than ``NODE_ROWS``
fingerprints are dealt on, a few bits deeper, as often as needed; no group
outgrows a task. Lower levels: each group walks its two subtrees level by
level in numpy and returns a spanning forest of the links found, which keeps
every connection without listing all pairs of a dense group. Components
follow by alternating large-star and small-star rounds over written tables.

Null and empty texts have fingerprint 0 and link like any other. Null
doc_ids count as larger than all others. Repeated rows share a fingerprint;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm.common import small_batches, table, unused
from arrivo.session import cut_lineage, drop_cut

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
#: Most fingerprints of one node pair's side in a task; bits dealt at a time
#: below a node that holds more.
NODE_ROWS, DEEPER_BITS = 32_768, 4
#: Hashes and node pairs worked on at once.
HASH_BLOCK, PAIR_BLOCK = 1 << 16, 1 << 20


def fingerprint_of(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of one text, from words in lower case (A-Z)."""
    ws = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not ws:
        return 0
    joined, starts, ends, at = b" ".join(ws), [], [], 0
    for w in ws:
        starts.append(at)
        at += len(w) + 1
        ends.append(at - 1)
    spans = list(zip(starts, ends[k - 1:])) or [(0, len(joined))]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(spans), HASH_BLOCK):
        h = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans[i:i + HASH_BLOCK]], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(spans), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, k: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, k) for t in texts], dtype="int64")

    return run(text)


def masks_within(bits: int, budget: int) -> list[int]:
    return [sum(1 << b for b in c) for n in range(budget + 1) for c in combinations(range(bits), n)]


def _dealt(rows: DataFrame, depth: int, masks: Column) -> DataFrame:
    """One row for each node pair (smaller node, mask) of a depth that the
    fingerprint's node belongs to; ``side`` says which of the two it is."""
    node = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
    return rows.withColumn("mask", F.explode(masks)).withColumn("own", node).withColumn(
        "node", F.least(F.col("own"), F.col("own").bitwiseXOR(F.col("mask")))).withColumn(
        "side", F.col("own") != F.col("node")).select("fp", "mask", "node", "side")


def node_pairs(fps: DataFrame, max_bits: int, node_rows: int) -> list[tuple[int, DataFrame]]:
    """(depth, rows) of the node pairs to walk; no node in them holds more
    than ``node_rows`` fingerprints, unless it is a single one."""
    total, depth, out = fps.count(), 0, []
    while total > node_rows << depth and depth < 24:
        depth += 1
    lit = [F.lit(m).cast("long") for m in masks_within(depth, max_bits)]
    rows = _dealt(fps, depth, F.array(*lit))
    while True:
        crowded = cut_lineage(
            fps.groupBy(F.shiftrightunsigned("fp", 64 - depth).alias("node") if depth else F.lit(0).cast(
                "long").alias("node")).count().filter(F.col("count") > node_rows).select("node"), "simhash-nodes")
        if depth > 64 - DEEPER_BITS or crowded.isEmpty():
            return [*out, (depth, rows)]
        # pairs with a crowded node go deeper; there are few, at most total / node_rows
        far = rows.withColumn("other", F.col("node").bitwiseXOR(F.col("mask")))
        a, b = (crowded.select(F.col("node").alias(n), F.lit(True).alias(f"{n}_full")) for n in ("node", "other"))
        far = far.join(a, "node", "left").join(b, "other", "left")
        is_full = F.col("node_full").isNotNull() | F.col("other_full").isNotNull()
        out.append((depth, far.filter(~is_full).select("fp", "mask", "node", "side")))
        step = min(DEEPER_BITS, 64 - depth)
        depth += step
        finer = F.filter(
            F.array(*[F.lit(m).cast("long") for m in masks_within(step, max_bits)]),
            lambda m: F.bit_count(m) + F.bit_count(F.col("above")) <= max_bits)
        deeper = far.filter(is_full).select("fp", F.col("mask").alias("above"))
        rows = _dealt(deeper, depth, F.transform(finer, lambda m: F.shiftleft(F.col("above"), step).bitwiseOR(m)))


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of n vertices."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, before[u], low)
        np.minimum.at(label, before[v], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    return label


def walk(a: np.ndarray, b: np.ndarray | None, depth: int, err: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between sorted fingerprints under one node (``b`` None) or two:
    (vertex, vertex) index pairs, b's after a's, thinned to a forest."""
    same = b is None
    other = a if same else b
    shift = 0 if same else len(a)
    n = len(a) + (0 if same else len(b))
    eu, ev = np.empty(0, np.int64), np.empty(0, np.int64)

    def zeros(x: np.ndarray, bit: int) -> np.ndarray:
        return np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1) == 0)])

    # a pair of nodes: its ranges in a and other, the bits that differ so far
    stack = [(depth, np.array([[0, len(a), 0, len(other), err]], np.int64))]
    while stack:
        depth, p = stack.pop()
        if len(p) > PAIR_BLOCK:
            stack += [(depth, p[:len(p) // 2]), (depth, p[len(p) // 2:])]
            continue
        na, nb = p[:, 1] - p[:, 0], p[:, 3] - p[:, 2]
        leaf = (na * nb <= 4) | (depth == 64)
        if leaf.any():
            q, size = p[leaf], (na * nb)[leaf]
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            width = np.repeat(q[:, 3] - q[:, 2], size)
            i, j = np.repeat(q[:, 0], size) + k // width, np.repeat(q[:, 2], size) + k % width
            near = np.bitwise_count(a[i] ^ other[j]) <= budget
            if same:
                near &= i < j
            eu, ev = np.concatenate([eu, i[near]]), np.concatenate([ev, j[near] + shift])
            if len(eu) > PAIR_BLOCK:
                root = forest(eu, ev, n)
                eu = np.flatnonzero(root != np.arange(n))
                ev = root[eu]
            p = p[~leaf]
        if not len(p):
            continue
        za = zeros(a, 63 - depth)
        zb = za if same else zeros(other, 63 - depth)
        am, bm = p[:, 0] + za[p[:, 1]] - za[p[:, 0]], p[:, 2] + zb[p[:, 3]] - zb[p[:, 2]]
        a0, a1, b0, b1 = (p[:, 0], am), (am, p[:, 1]), (p[:, 2], bm), (bm, p[:, 3])
        grown = [np.stack([*x, *y, p[:, 4] + d], axis=1) for x, y, d in (
            (a0, b0, 0), (a1, b1, 0), (a0, b1, 1), (a1, b0, 1))]
        if same:  # under one node, (1, 0) repeats (0, 1)
            grown[3] = grown[3][p[:, 0] != p[:, 2]]
        q = np.concatenate(grown)
        q = q[(q[:, 4] <= budget) & (q[:, 1] > q[:, 0]) & (q[:, 3] > q[:, 2])]
        if len(q):
            stack.append((depth + 1, q))
    root = forest(eu, ev, n)
    eu = np.flatnonzero(root != np.arange(n))
    return eu, root[eu]


def _walker(depth: int, max_bits: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        side = pdf["side"].to_numpy()
        a, b = np.sort(fp[~side]), np.sort(fp[side])
        u = v = np.empty(0, np.int64)
        if key[1] == 0:
            u, v = walk(a, None, depth, 0, max_bits)
        elif len(a) and len(b):
            u, v = walk(a, b, depth, (int(key[1]) & (1 << 64) - 1).bit_count(), max_bits)
        both = np.concatenate([a, b]).view(np.int64)
        return pd.DataFrame({"a": both[u], "b": both[v]})

    return group


def links(fps: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b) links that connect all of ``fps`` (distinct ``fp``) that lie
    within ``max_bits`` of each other."""
    found = [rows.groupBy("node", "mask").applyInPandas(_walker(depth, max_bits), "a long, b long")
             for depth, rows in node_pairs(fps, max_bits, node_rows)]
    return reduce(DataFrame.unionByName, found)


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b) but the roots, which
    are the smallest vertices of their components."""
    pairs = cut_lineage(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("root")).filter(
        "v <> root").distinct(), "simhash-links")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("v", "root").cast("decimal(38,0)"))).first())

    def star(both: DataFrame) -> DataFrame:
        # both: (u, w); each w above u, and in small stars u itself, is tied to u's smallest
        low = both.groupBy("u").agg(F.min("w").alias("low")).select("u", F.least("u", "low").alias("low"))
        return both.join(low, "u")

    was = None
    while was != (now := mark(pairs)):
        was = now
        both = pairs.select(F.col("v").alias("u"), F.col("root").alias("w")).unionByName(
            pairs.select(F.col("root").alias("u"), F.col("v").alias("w")))
        large = star(both).filter("w > u").select(F.col("w").alias("u"), F.col("low").alias("w")).distinct()
        tied = star(large)
        small = tied.select(F.col("w").alias("v"), F.col("low").alias("root")).unionByName(
            tied.select(F.col("u").alias("v"), F.col("low").alias("root")))
        last, pairs = pairs, cut_lineage(small.filter("v <> root").distinct(), "simhash-stars")
        drop_cut(last)
    return pairs


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    text: str = "text", node_rows: int = NODE_ROWS) -> DataFrame:
    """One row for each document: doc_id, text_hash, fp, group (the
    component's smallest fingerprint), component_id (its smallest doc_id)
    and kept_hash (the text_hash of the document that stands for it)."""
    small_batches(docs.sparkSession)
    rows = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
        fingerprint(F.col(text), shingle_words).alias("fp")), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("first")
    fps = cut_lineage(rows.groupBy("fp").agg(first), "simhash-fps")
    roots = components(links(fps.select("fp"), max_bits, node_rows))
    grouped = fps.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn(
        "group", F.coalesce("root", "fp")).select("fp", "group", "first")
    best = grouped.groupBy("group").agg(F.min("first").alias("best"))
    classes = grouped.join(best, "group").select(
        "fp", "group", F.col("best.doc_id").alias("component_id"), F.col("best.text_hash").alias("kept_hash"))
    return rows.join(classes, "fp").select("doc_id", "text_hash", "fp", "group", "component_id", "kept_hash")


def keep_one_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                  text: str = "text") -> DataFrame:
    """Rows of ``docs`` with all their columns, one of each component: the
    smallest doc_id's."""
    own, row = unused(docs, "__own"), unused(docs, "__row")
    # the right side's names differ from all of docs'
    by_id, by_hash = unused(docs, "__id"), unused(docs, "__hash")
    keep = cut_lineage(near_duplicates(docs, shingle_words, max_bits, text).select(
        F.col("component_id").alias(by_id), F.col("kept_hash").alias(by_hash)).distinct(), "simhash-keep")
    once = F.row_number().over(Window.partitionBy("doc_id", own).orderBy("doc_id"))
    return (docs.withColumn(own, F.xxhash64(F.col(text))).join(
        keep, F.col("doc_id").eqNullSafe(F.col(by_id)) & (F.col(own) == F.col(by_hash)), "left_semi")
        .withColumn(row, once).filter(F.col(row) == 1).select(*docs.columns))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
