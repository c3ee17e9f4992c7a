"""Operator 7, approximate nearest neighbours by vantage-point trees.

Nearness is the inner product. Vectors get one more component,
sqrt(M^2 - |x|^2) with M the largest norm, and queries a zero; the Euclidean
distance of these orders candidates as the inner product does, and it is a
metric, which the trees need. Rounding is relative to M^2, so M is the largest
norm of a band in which norms differ by a factor of ``BAND`` at most, and
bands and queries are scaled to norm 1.

Vectors are dealt by hash to shards of about ``SHARD_ROWS``. Each shard
builds one tree for each band: a node's vantage point splits its vectors at the median
distance, down to leaves of ``LEAF_ROWS``. A block of queries goes down the
tree together; each query takes its nearer child first and enters the other
one only if the triangle inequality leaves room for a vector nearer than
``tau / factor``, tau being its k-th best distance so far. Factor 1 is exact
search, larger factors prune more. The best of all shards are merged.

Equal vectors of a shard are one point in the tree that keeps its k + 1
smallest ids, which is all that ties can ask for, so a very common vector
costs no more than any other. Vectors that are null, zero, of another length
than most, or hold null or non-finite components take no part, as query or
candidate. Rows with a null id take no part; repeated rows are repeated
candidates with one id, and a query never finds its own id. A table without
vectors gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm.common import table

K = 20
QUERY_EVERY = 20  # fixed by the data contract
#: Pruning factor of the query: measured recall is in the README.
FACTOR = 3.0
SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 16_384, 2_048, 256
BAND = 16.0


def usable(vec: Column) -> Column:
    """Whether a vector takes part, whatever its length."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


class Tree:
    """Vantage-point tree over the rows of ``x``."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.x, self.leaf_rows = x, leaf_rows
        self.order = np.arange(len(x))
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(x))

    def _build(self, lo: int, hi: int) -> int:
        """A node: (vantage row, inner child, outer child, the least and the
        largest distance of each child) or a leaf (None, lo, hi)."""
        me = len(self.nodes)
        self.nodes.append((None, lo, hi))
        if hi - lo <= self.leaf_rows:
            return me
        rows = self.order[lo:hi]
        # the vantage point: the row farthest from the first one spreads best
        v = rows[np.argmax(((self.x[rows] - self.x[rows[0]]) ** 2).sum(axis=1))]
        d = np.sqrt(((self.x[rows] - self.x[v]) ** 2).sum(axis=1))
        mid = len(rows) // 2
        part = np.argpartition(d, mid)
        self.order[lo:hi], d = rows[part], d[part]
        inner, outer = self._build(lo, lo + mid), self._build(lo + mid, hi)
        self.nodes[me] = (v, inner, outer, d[:mid].min(), d[:mid].max(), d[mid:].min(), d[mid:].max())
        return me

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(distances, rows) of the k nearest found for each query, both
        with -1 and inf where there are fewer."""
        self.best = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), -1)
        self.worst = np.full(len(queries), np.inf)
        self.q, self.sq = queries, (queries ** 2).sum(axis=1)
        self.sx = (self.x ** 2).sum(axis=1)
        self._visit(self.root, np.arange(len(queries)), factor)
        return self.best, self.found

    def _visit(self, node: int, active: np.ndarray, factor: float) -> None:
        if not len(active):
            return
        v, *rest = self.nodes[node]
        if v is None:
            rows = self.order[rest[0]:rest[1]]
            d = self.sq[active, None] + self.sx[rows] - 2 * (self.q[active] @ self.x[rows].T)
            np.sqrt(np.maximum(d, 0, out=d), out=d)
            better = (d < self.worst[active, None]).any(axis=1)
            if not better.any():
                return
            active, d = active[better], d[better]
            both = np.concatenate([self.best[active], d], axis=1)
            ids = np.concatenate([self.found[active], np.broadcast_to(rows, d.shape)], axis=1)
            k = self.best.shape[1]
            top = np.argpartition(both, k - 1, axis=1)[:, :k]
            self.best[active] = np.take_along_axis(both, top, axis=1)
            self.found[active] = np.take_along_axis(ids, top, axis=1)
            self.worst[active] = self.best[active].max(axis=1)
            return
        inner, outer, lo1, hi1, lo2, hi2 = rest
        d = np.sqrt(np.maximum(self.sq[active] + self.sx[v] - 2 * (self.q[active] @ self.x[v]), 0))
        near = np.maximum(np.maximum(d - hi1, lo1 - d), 0)  # no inner vector can be nearer
        far = np.maximum(np.maximum(d - hi2, lo2 - d), 0)
        first = near <= far
        for side, child, other, bound in ((first, inner, outer, far), (~first, outer, inner, near)):
            self._visit(child, active[side], factor)
            open_ = bound[side] * factor <= self.worst[active[side]] * (1 + 1e-9)
            self._visit(other, active[side][open_], factor)


def norms(x: np.ndarray) -> np.ndarray:
    """Norms, without overflow of the squares."""
    largest = np.abs(x).max(axis=1)
    return largest * np.sqrt(((x / largest[:, None]) ** 2).sum(axis=1))


def search_shard(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray,
                 k: int, factor: float) -> pd.DataFrame:
    """The k best candidates of one shard for each query."""
    order = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[order], x[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(x)))
    points = x[start]
    norm = norms(points)
    # bands end at half powers, away from norm 1
    band = np.floor(np.log2(norm) / np.log2(BAND) + 0.5)
    asked = np.column_stack([q / norms(q)[:, None], np.zeros(len(q))])
    pairs = []
    for b in np.unique(band):
        rows = np.flatnonzero(band == b)
        unit = points[rows] / (norm[rows].max() * (1 + 1e-12))
        rest = np.sqrt(np.maximum(1 - (unit ** 2).sum(axis=1), 0))
        # one more, as the query itself may be among them
        _, found = Tree(np.column_stack([unit, rest])).search(asked, k + 1, factor)
        held = found >= 0
        pairs.append((np.nonzero(held)[0], rows[found[held]]))
    who, point = (np.concatenate(p) for p in zip(*pairs))
    # summed component by component, so equal vectors get equal scores
    score = (points[point] * q[who]).sum(axis=1)
    # the smallest ids of each point; one more, as the query may be among them
    times = np.minimum(count[point], k + 1)
    who, score = np.repeat(who, times), np.repeat(score, times)
    row = np.repeat(start[point], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    other = ids[row] != query_ids[who]
    who, score, vec = who[other], score[other], ids[row][other]
    order = np.lexsort((vec, -score, who))
    who, score, vec = who[order], score[order], vec[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    top = rank < k
    return pd.DataFrame({"query_id": query_ids[who[top]], "vec_id": vec[top], "score": score[top]})


def _searcher(k: int, factor: float) -> Callable:
    def run(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        x, q = (np.stack(df["vec"].to_numpy()).astype(np.float64) for df in (shard, queries))
        return search_shard(shard["vec_id"].to_numpy(), x, queries["vec_id"].to_numpy(), q, k, factor)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR,
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found for each
    row of ``queries``; both frames hold (vec_id, vec). A task holds one
    shard and one block of queries, both of bounded size."""
    def cleaned(df: DataFrame) -> DataFrame:
        ok = df.filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
        return ok.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))

    vectors, queries = cleaned(vectors), cleaned(queries)
    lengths = vectors.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"))
    shape = lengths.orderBy(F.desc("n"), "dim").limit(1).collect()
    schema = "query_id long, vec_id long, score double"
    if not shape:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = shape[0]
    queries = queries.filter(F.size("vec") == dim)
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-queries.count() // query_rows))
    dealt = vectors.filter(F.size("vec") == dim).withColumns({
        "shard": F.pmod(F.xxhash64("vec_id"), F.lit(shards)),
        "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    asked = queries.withColumns({
        "block": F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int"),
        "shard": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))})
    found = dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        _searcher(k, factor), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return nearest(vectors, vectors.filter(F.col("vec_id") % QUERY_EVERY == 0))
