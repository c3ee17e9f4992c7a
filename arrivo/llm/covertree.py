"""Operator 11, hard negatives by cover trees over norm-augmented candidates.

Each component x of a vector becomes floor(256 x), so scores are whole
numbers and compared exactly. Vectors get one more component,
sqrt(M^2 - |x|^2) with M the largest norm of a shard, and anchors a zero: the
distance of an anchor and a candidate then follows from their inner product.

Rows are dealt to shards of about ``SHARD_ROWS``: labels share ``LABELS``
buckets by hash, and a bucket has as many shards as its rows need, so a very
common label is only more shards. A shard becomes one cover tree, built once
and written as one binary row. A node covers its rows within a radius; its
children are a net of the rows: each centre is at least the reached radius
away from the others, the node's own centre is one of them, and every row is
within the radius of a child. From level to level the radius falls by
``BASE``, or as far as a net of limited size allows; nodes of at most
``LEAF_ROWS`` rows are leaves. Radii are measured, so the bounds hold however
far a net got.

Blocks of anchors descend a tree level by level. A node at distance d with
radius r holds inner products between those of distances d + r and d - r, so
nodes (and all below) outside every window of an anchor are skipped. Leaves
are taken best bound first, in rounds of growing size, until no leaf can hold
a better row than the k-th found in any window, and their rows are scored
exactly. Two searches follow each other: positives in the shards of the
anchor's label bucket, then negatives in all shards, with a window for each
positive. The best of all shards are merged.

Left out are rows with a null label, id or vector, a null or non-finite
component, another length than most (of equally common lengths the
shortest counts), or whole numbers whose squared norm reaches 2^55 (scores
would not fit a long). Repeated rows are repeated candidates with one id;
a repeated anchor is asked once, and never finds its own id. Ties go to the
smaller id. A negative positive_score has no window, zero has that of zero.
Empty tables, labels without other rows and windows without rows give no rows.
"""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivo.llm.common import table
from arrivo.session import cut_lineage, drop_cut

# fixed by the data contract
POSITIVES, NEGATIVES = 5, 3
ANCHOR_EVERY, RELABEL_EVERY, LABELS_OF_DATA = 50, 7, 10
SCALE = 256.0
LOW_PERCENT, HIGH_PERCENT = 50, 95

#: Rows of a shard and anchors of a block; label buckets.
SHARD_ROWS, ANCHOR_ROWS, LABELS = 16_384, 8_192, 64
#: Anchors that descend together, rows of a leaf, most centres of a net.
TOGETHER, LEAF_ROWS, FANOUT = 512, 256, 32
BASE = 1.3
LARGEST_SQUARE = 2.0 ** 55
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class CoverTree:
    """Cover tree over whole-number rows ``x`` with ``ids`` and ``labels``.

    Rows are kept in the order of the leaves, by id within a leaf. Nodes are
    listed level by level: ``parent``, ``centre`` (row), ``radius``, ``level``
    and, for leaves, the rows ``lo`` to ``hi`` (else both -1)."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        wide = x.astype(np.float64)
        square = (wide ** 2).sum(axis=1)
        self.largest = float(square.max(initial=0.0))
        points = np.column_stack([wide, np.sqrt(np.maximum(self.largest - square, 0))])
        nodes, order = [], []
        level = [(-1, np.arange(len(x)), 0, _distance(points, points[0]))] if len(x) else []
        depth = 0
        while level:
            below = []
            for parent, rows, centre, dist in level:
                me, radius = len(nodes), float(dist.max())
                leaf = len(rows) <= LEAF_ROWS or radius == 0
                lo = sum(map(len, order)) if leaf else -1
                nodes.append((parent, centre, radius, depth, lo, lo + len(rows) if leaf else -1))
                if leaf:
                    order.append(rows[np.argsort(ids[rows], kind="stable")])
                else:
                    below += [(me, *child) for child in _net(points, rows, dist, centre, radius / BASE)]
            level, depth = below, depth + 1
        rows = np.concatenate(order) if order else np.empty(0, np.int64)
        place = np.empty(len(rows), np.int64)
        place[rows] = np.arange(len(rows))
        self.x, self.ids, self.labels = x[rows], ids[rows], labels[rows]
        self.parent, centre, self.radius, self.level, self.lo, self.hi = (
            np.array(c) for c in (zip(*nodes) if nodes else [[]] * 6))
        self.centre = place[centre] if nodes else np.empty(0, np.int64)

    def pack(self) -> bytes:
        out, x = io.BytesIO(), self.x
        for kind in (np.int16, np.int32):
            if x.size and np.abs(x).max() <= np.iinfo(kind).max:
                x = x.astype(kind)
                break
        np.savez(out, **{**vars(self), "x": x})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as held:
            vars(tree).update({k: held[k] for k in held.files})
        tree.x, tree.largest = tree.x.astype(np.int64), float(tree.largest)
        return tree

    def bounds(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, largest) inner product of each anchor with the rows of
        each leaf; leaves outside all windows (low to high) have a largest
        of -inf. Windows narrow no bound, they only end the descent."""
        wide = q.astype(np.float64)
        own = (wide ** 2).sum(axis=1)[:, None] + self.largest
        least, most = (np.full((len(q), len(self.parent)), v) for v in (-np.inf, np.inf))
        low_all, high_all = low.min(axis=1)[:, None], high.max(axis=1)[:, None]
        for depth in range(int(self.level.max(initial=-1)) + 1):
            at = np.flatnonzero(self.level == depth)
            if depth:
                above = self.parent[at]
                least[:, at], most[:, at] = least[:, above], most[:, above]
                at = at[(most[:, at] > -np.inf).any(axis=0)]
            # twice the inner product is own - distance^2
            d = np.sqrt(np.maximum(own - 2 * (wide @ self.x[self.centre[at]].T.astype(np.float64)), 0))
            r, slack = self.radius[at], 1e-9 * own + 1
            least[:, at] = np.maximum(least[:, at], (own - (d + r) ** 2 - slack) / 2)
            most[:, at] = np.minimum(most[:, at], (own - np.maximum(d - r, 0) ** 2 + slack) / 2)
            shut = (most[:, at] < low_all) | (least[:, at] > high_all)
            most[:, at] = np.where(shut, -np.inf, most[:, at])
        leaves = np.flatnonzero(self.lo >= 0)
        return least[:, leaves], most[:, leaves]

    def search(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray,
               k: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), each anchor x window x k, of the best rows of equal
        (``same``) or other label in each window, the anchor's own id left
        out; missing ones score ``LEAST``."""
        shape = (*low.shape, k)
        best, found = np.full(shape, LEAST), np.full(shape, MOST)
        least, most = self.bounds(q, low, high)
        lo, hi = self.lo[self.lo >= 0], self.hi[self.lo >= 0]
        left, step = most > -np.inf, 1
        while True:
            bar = np.maximum(low, best[:, :, -1])  # windows above their k-th best so far
            able = left & ((most[:, :, None] >= bar[:, None]) & (least[:, :, None] <= high[:, None])
                           & (low <= high)[:, None]).any(axis=2)
            if not able.any():
                return best, found
            take = able
            if step < able.shape[1]:
                rank = np.where(able, most, -np.inf)
                first = np.argpartition(-rank, step - 1, axis=1)[:, :step]
                take = np.zeros_like(able)
                np.put_along_axis(take, first, True, axis=1)
                take &= able
            for leaf in np.flatnonzero(take.any(axis=0)):
                asked = np.flatnonzero(take[:, leaf])
                rows = slice(lo[leaf], hi[leaf])
                score = products(q[asked], self.x[rows])
                fits = (self.labels[rows] == labels[asked, None]) == same
                fits &= self.ids[rows] != ids[asked, None]
                for w in range(low.shape[1]):
                    floor = np.maximum(low[asked, w], best[asked, w, -1])[:, None]
                    inside = fits & (score >= floor) & (score <= high[asked, w, None])
                    some = np.flatnonzero(inside.any(axis=1))
                    if len(some):
                        _merge(best, found, asked[some], w, np.where(inside[some], score[some], LEAST), self.ids[rows])
            left &= ~take
            step *= 2


def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def _net(points: np.ndarray, rows: np.ndarray, dist: np.ndarray, centre: int, radius: float) -> list[tuple]:
    """(rows, centre, distances to it) of the children of a node: the row
    farthest from all centres becomes the next one until all are within
    ``radius`` or the net is large enough."""
    most = min(FANOUT, max(2, 2 * len(rows) // LEAF_ROWS))
    centres, nearest, dist = [centre], np.zeros(len(rows), np.int64), dist.copy()
    while len(centres) < most and dist.max() > radius:
        far = int(np.argmax(dist))
        d = _distance(points[rows], points[rows[far]])
        closer = d < dist
        closer[far] = True
        dist[closer], nearest[closer] = d[closer], len(centres)
        centres.append(int(rows[far]))
    return [(rows[nearest == i], c, dist[nearest == i]) for i, c in enumerate(centres)]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products; as doubles, which are faster, where no partial
    sum can leave their whole numbers."""
    wide, tall = q.astype(np.float64), x.astype(np.float64)
    if (wide ** 2).sum(axis=1).max(initial=0) * (tall ** 2).sum(axis=1).max(initial=0) < 2.0 ** 105:
        return (wide @ tall.T).astype(np.int64)
    return q @ x.T


def _merge(best: np.ndarray, found: np.ndarray, asked: np.ndarray, w: int, score: np.ndarray,
           ids: np.ndarray) -> None:
    """Put the k best of ``score`` (anchor x row, rows by id) among the best."""
    k = best.shape[2]
    all_s, all_i = [best[asked, w]], [found[asked, w]]
    line = np.arange(len(asked))
    for _ in range(min(k, score.shape[1])):
        top = score.argmax(axis=1)  # the first of equals has the smallest id
        got = score[line, top]
        all_s.append(got[:, None])
        all_i.append(np.where(got == LEAST, MOST, ids[top])[:, None])
        score[line, top] = LEAST
    s, i = np.concatenate(all_s, axis=1), np.concatenate(all_i, axis=1)
    by = np.lexsort((i, -np.maximum(s, LEAST + 1)), axis=1)[:, :k]
    best[asked, w], found[asked, w] = np.take_along_axis(s, by, axis=1), np.take_along_axis(i, by, axis=1)


def whole_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec) with whole numbers, of the rows that take part."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad)
    floors = F.transform("vec", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       floors.alias("vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    return rows.filter(square < LARGEST_SQUARE).withColumn("vec", F.col("vec").cast("array<long>"))


def _stacked(vec: pd.Series) -> np.ndarray:
    return np.stack(vec.to_numpy()).astype(np.int64)


def plant(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The tree of a shard as one row."""
    tree = CoverTree(_stacked(pdf["vec"]), pdf["vec_id"].to_numpy(), pdf["label"].to_numpy())
    return pd.DataFrame({"shard": [key[0]], "tree": [tree.pack()]})


def _asker(k: int, same: bool, windows: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]) -> Callable:
    def run(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for data in trees["tree"] if len(asked) else ():
            tree = CoverTree.unpack(data)
            for at in range(0, len(asked), TOGETHER):
                some = asked.iloc[at:at + TOGETHER]
                best, found = tree.search(_stacked(some["vec"]), some["vec_id"].to_numpy(), some["label"].to_numpy(),
                                          *windows(some), k, same)
                who, window, place = np.nonzero(best > LEAST)
                out.append(pd.DataFrame({"anchor": some["anchor"].to_numpy()[who], "slot": window + 1,
                                         "found_id": found[who, window, place], "score": best[who, window, place]}))
        if not out:
            return pd.DataFrame({"anchor": [], "slot": [], "found_id": [], "score": []}, dtype="int64")
        return pd.concat(out)

    return run


def _everything(asked: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """One window that holds every score."""
    return np.full((len(asked), 1), LEAST + 1), np.full((len(asked), 1), MOST)


def _windows(low_percent: int, high_percent: int) -> Callable:
    def run(asked: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """A window for each positive; where there are fewer, empty ones."""
        low, high = (np.full((len(asked), asked["scores"].map(len).max()), v) for v in (1, 0))
        for i, scores in enumerate(asked["scores"]):
            s = np.asarray(scores, dtype=np.int64)
            low[i, :len(s)], high[i, :len(s)] = -(-low_percent * s // 100), high_percent * s // 100
        return low, high

    return run


def _search(trees: DataFrame, asked: DataFrame, blocks: int, shards: Column, run: Callable) -> DataFrame:
    """``run`` over every block of ``asked`` and each tree of ``shards``."""
    dealt = asked.withColumns({"block": F.pmod("anchor", F.lit(blocks)).cast("int"), "shard": F.explode(shards)})
    copied = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return copied.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInPandas(
        run, "anchor long, slot int, found_id long, score long")


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT,
                   shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """For each anchor (a condition on the columns vec_id, label) and each of
    its best rows of equal label, the best rows of other labels whose score
    is between the two percentages of the positive's. ``vectors`` holds
    (vec_id, label, vec)."""
    spark = vectors.sparkSession
    rows = whole_rows(vectors)
    bucket = F.pmod(F.xxhash64("label"), F.lit(LABELS)).cast("int")
    lengths = rows.groupBy(F.size("vec").alias("dim"), bucket.alias("bucket")).agg(F.count("*").alias("n"))
    common = lengths.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dim").limit(1)
    counts = {r["bucket"]: r["n"] for r in lengths.join(common.select("dim"), "dim").collect()}
    shape = common.collect()
    if not shape:
        return spark.createDataFrame([], RESULT)
    rows = rows.filter(F.size("vec") == shape[0]["dim"])
    # shards of a bucket are numbered one after the other
    each = [-(-counts.get(b, 0) // shard_rows) for b in range(LABELS)]
    first = [sum(each[:b]) for b in range(LABELS)]
    of = {name: F.element_at(F.array(*map(F.lit, values)), bucket + 1)
          for name, values in (("first", first), ("each", each))}
    # dealt by a row number, so equal rows are spread too; written before a row can be dealt again
    shard = of["first"] + F.pmod(F.xxhash64(F.monotonically_increasing_id()), of["each"])
    placed = cut_lineage(rows.withColumn("shard", shard.cast("int")), "negatives-rows")
    trees = cut_lineage(placed.groupBy("shard").applyInPandas(plant, "shard int, tree binary"), "negatives-trees")
    anchors = cut_lineage(placed.filter(is_anchor).select("vec_id", "label", "vec").distinct().withColumn(
        "anchor", F.monotonically_increasing_id()), "negatives-anchors")
    blocks = max(1, -(-anchors.count() // anchor_rows))

    def best(found: DataFrame, by: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    own = F.sequence(of["first"], of["first"] + of["each"] - 1)
    near = best(_search(trees, anchors, blocks, own, _asker(positives, True, _everything)), ["anchor"], positives)
    lists = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "found_id", "score"))).alias("near"))
    asked = cut_lineage(anchors.join(lists, "anchor").withColumn("scores", F.col("near.score")), "negatives-asked")
    everywhere = F.sequence(F.lit(0), F.lit(sum(each) - 1))
    far = best(_search(trees, asked.drop("near"), blocks, everywhere,
                       _asker(negatives, False, _windows(low_percent, high_percent))), ["anchor", "slot"], negatives)
    pairs = asked.select("anchor", F.col("vec_id").alias("anchor_id"), F.explode("near").alias("p")).select(
        "anchor", F.col("p.rank").alias("slot"), "anchor_id", F.col("p.found_id").alias("positive_id"),
        F.col("p.score").alias("positive_score"))
    out = cut_lineage(pairs.join(far, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score")), "negatives")
    for done in (placed, trees, anchors, asked):
        drop_cut(done)
    return out


OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER)
         AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS_OF_DATA).otherwise(
        F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("vec"))
    return hard_negatives(vectors, F.col("vec_id") % ANCHOR_EVERY == 0)
