"""Hard negatives, whitening and the n-gram Jaccard join against brute force."""

import random
from collections import defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from arrivo.llm import covertree, setjoin, whitening
from arrivo.llm.common import table

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


# ---- operator 11

def brute_negatives(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """rows: (vec_id, label, whole-number vector)."""
    out, asked = [], {}
    for a in rows:
        if is_anchor(a[0]):
            asked[(a[0], a[1], tuple(a[2]))] = a
    for aid, label, vec in asked.values():
        scored = sorted((-sum(p * q for p, q in zip(vec, v)), i, other) for i, other, v in rows if i != aid)
        for s, pid, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and -low * s <= -100 * x[0] <= -high * s][:negatives]
            out += [(aid, pid, r + 1, nid, -s, -n) for r, (n, nid, _) in enumerate(fit)]
    return sorted(out)


def whole(rows):
    ok = [r for r in rows if None not in r and all(x is not None and np.isfinite(x) for x in r[2])]
    return [(i, label, [int(np.floor(256 * float(x))) for x in v]) for i, label, v in ok]


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_negatives_equal_sql(spark):
    got = sorted(map(tuple, covertree.op11_hard_negatives(spark, SF).select(COLUMNS).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({covertree.OP11_SQL})").fetchall()
    assert len(got) > 100 and got == sorted(want)


def clustered(n, dim, seed, labels=4):
    """Vectors around a few points, so that nodes are skipped, with copies."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, dim)) * 3
    x = middle[rng.integers(6, size=n)] + rng.normal(size=(n, dim)) * 0.2
    x[n // 2:n // 2 + n // 6] = x[0]
    return [(int(i), int(rng.integers(labels)), v.astype(np.float32).tolist()) for i, v in enumerate(x)]


def test_negatives_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(covertree, "LEAF_ROWS", 16)
    rows = clustered(900, 6, 1)
    frame = spark.createDataFrame(rows, "vec_id long, label int, vec array<float>")
    got = covertree.hard_negatives(frame, F.col("vec_id") % 9 == 0, shard_rows=60, anchor_rows=30)
    assert sorted(map(tuple, got.select(COLUMNS).collect())) == brute_negatives(whole(rows), lambda i: i % 9 == 0)


@pytest.mark.parametrize("scale", [1, 150])
def test_cover_tree(monkeypatch, scale):
    """Nets cover and keep apart, every row is in one leaf, bounds hold, and a
    search reads a part of the leaves only. The larger scale leaves doubles."""
    monkeypatch.setattr(covertree, "LEAF_ROWS", 16)
    rows = whole(clustered(1500, 5, 2))
    x = np.array([r[2] for r in rows]) * scale * scale
    ids, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    tree = covertree.CoverTree.unpack(covertree.CoverTree(x, ids, labels).pack())
    assert sorted(tree.ids) == sorted(ids) and (tree.x == x[tree.ids]).all()
    points = np.column_stack([tree.x, np.sqrt(tree.largest - (tree.x.astype(float) ** 2).sum(axis=1))])
    leaves = np.flatnonzero(tree.lo >= 0)
    assert (np.sort(np.concatenate([np.arange(tree.lo[n], tree.hi[n]) for n in leaves])) == np.arange(len(x))).all()
    under = defaultdict(list)
    for leaf in leaves:
        node = leaf
        while node >= 0:
            under[node] += range(tree.lo[leaf], tree.hi[leaf])
            node = tree.parent[node]
    for node, its in under.items():
        d = np.linalg.norm(points[its] - points[tree.centre[node]], axis=1)
        assert d.max() <= tree.radius[node] * (1 + 1e-9) + 1e-9
        below = np.flatnonzero(tree.parent == node)
        if len(below):
            assert tree.centre[node] in tree.centre[below]
            c = points[tree.centre[below]]
            apart = np.linalg.norm(c[:, None] - c[None], axis=2) + np.eye(len(c)) * 1e30
            assert apart.min() >= tree.radius[below].max() * (1 - 1e-9)
    q, everything = x[:40], np.full((40, 1), covertree.LEAST + 1)
    read = []
    exact = covertree.products
    monkeypatch.setattr(covertree, "products", lambda a, b: read.append(len(a) * len(b)) or exact(a, b))
    best, found = tree.search(q, ids[:40], labels[:40], everything, np.full((40, 1), covertree.MOST), 5, True)
    for i in range(40):
        want = sorted((-int(s), int(j)) for s, j, same in zip(x @ q[i], ids, labels == labels[i]) if same and j != i)[:5]
        assert list(zip((-best[i, 0]).tolist(), found[i, 0].tolist())) == want
    assert sum(read) < 40 * len(x) / 2


def test_negatives_odd_rows(spark):
    rows = [(0, 1, [0.5, 0.5]), (0, 1, [0.5, 0.5]), (1, 1, [0.5, 0.4]), (1, 1, [0.5, 0.4]), (2, 2, [0.4, 0.4]),
            (3, 2, [0.4, 0.4]), (3, 2, [0.4, 0.4]), (5, 3, [0.3, 0.5]), (None, 2, [0.4, 0.4]), (6, None, [0.4, 0.4]),
            (7, 2, None), (8, 2, [None, 0.4]), (9, 2, [NAN, 0.4]), (11, 2, [INF, 0.4]), (12, 2, [0.4]),
            (10, 4, [0.0, 0.0]), (13, 4, [0.1, 0.1]), (20, 5, [-0.5, 0.0]), (21, 5, [0.5, 0.0]), (22, 2, [3e30, 0.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "vec_id long, label int, vec array<double>, shard string, anchor int")
    got = sorted(map(tuple, covertree.hard_negatives(frame, F.col("vec_id") % 10 == 0).select(COLUMNS).collect()))
    held = [r for r in whole(rows) if len(r[2]) == 2 and r[0] != 22]
    assert got == brute_negatives(held, lambda i: i % 10 == 0)
    assert {g[0] for g in got} == {0, 10} and len(got) == len(set(got)) + 3  # copies of 1 and 3 count each
    assert covertree.hard_negatives(frame.limit(0), F.lit(True)).count() == 0
    assert covertree.hard_negatives(frame.filter("vec is null"), F.lit(True)).columns == COLUMNS
    none = spark.createDataFrame([(i, i % 2, []) for i in range(4)], "vec_id long, label int, vec array<double>")
    got = covertree.hard_negatives(none, F.col("vec_id") == 0).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == [(0, 2, 1, 1, 0, 0), (0, 2, 2, 3, 0, 0)]


def test_negative_windows():
    """Limits are rounded inwards, and a negative positive has no window."""
    import pandas as pd
    low, high = covertree._windows(50, 95)(pd.DataFrame({"scores": [np.array([7, -3, 0]), np.array([100])]}))
    assert low.tolist() == [[4, -1, 0], [50, 1, 1]] and high.tolist() == [[6, -3, 0], [95, 0, 0]]


# ---- operator 12

def reference(x):
    """Eigenvalues falling, whitened rows, deviations of whole-number rows."""
    n = len(x)
    y = x - x.mean(axis=0)
    value, vector = np.linalg.eigh(y.T @ y / n)
    value, vector = value[::-1], vector[:, ::-1]
    big = x.astype(object)
    return value, y @ vector / np.sqrt(np.maximum(value, 1e-300)), ((n * big - big.sum(axis=0)) ** 2).sum(axis=1)


def test_whitening_whole_table(spark):
    held = table(spark, SF, "embeddings").collect()
    x = np.floor(np.array([r.embedding for r in held], dtype=float) * 1024).astype(np.int64) + 100_000
    value, white, deviation = reference(x)
    at = {r.vec_id: i for i, r in enumerate(held)}
    got = whitening.op12_whitening(spark, SF).collect()
    assert len(got) == 8 * len(held) and {r.component for r in got} == set(range(1, 9))
    mine = np.zeros((len(held), 8))
    for r in got:
        i = at[r.vec_id]
        mine[i, r.component - 1] = r.whitened
        assert r.n == len(held) and r.deviation == deviation[i] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(value[r.component - 1] / value.sum(), rel=1e-9)
    sign = np.sign((mine * white[:, :8]).sum(axis=0))
    assert np.abs(mine - white[:, :8] * sign).max() < 1e-9


def test_eigen_of_odd_matrices():
    rng = np.random.default_rng(5)
    for d, rank in ((1, 1), (7, 7), (7, 3), (12, 0), (30, 30)):
        g = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-2, 3, size=d)[:, None]
        a = g @ g.T
        factor, order = whitening.pivoted_cholesky(a)
        assert factor.shape[1] == rank and np.allclose(np.triu(factor, 1), 0)
        assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], atol=1e-12 * max(1, np.abs(a).max()))
        value, vector = whitening.eigen(a)
        assert np.allclose(vector.T @ vector, np.eye(rank), atol=1e-12)
        assert np.allclose(value, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9, atol=1e-12 * np.abs(a).max(initial=0))
    value, _ = whitening.eigen(np.eye(5) * 3)  # equal eigenvalues
    assert np.allclose(value, 3)


def test_whitening_odd_rows(spark):
    rows = [(1, [0.5, 1.0, 2.0]), (1, [0.5, 1.0, 2.0]), (None, [0.25, 1.0, 4.0]), (3, [0.75, 1.0, 2.5]), (4, None),
            (5, [None, 1.0, 2.0]), (6, [NAN, 1.0, 2.0]), (7, [INF, 1.0, 2.0]), (8, [1.0]), (9, []), (10, [1e30, 1.0, 2.0]),
            (11, [-4e6, 1.0, 2.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, vec array<double>, pos int")
    got = whitening.whiten(frame).collect()
    kept = [r for r in rows if r[0] in (1, None, 3, 11)]
    assert sorted(str(r.vec_id) for r in got) == sorted(str(r[0]) for r in kept for _ in range(3))
    x = np.floor(np.array([r[1] for r in kept]) * 1024).astype(np.int64) + 100_000
    _, _, deviation = reference(x)
    by_id = {r[0]: int(d) for r, d in zip(kept, deviation)}
    assert all(r.deviation == (by_id[r.vec_id] if by_id[r.vec_id] < 2 ** 63 else None) for r in got)
    assert max(by_id.values()) > 2 ** 63  # the outlier's own does not fit
    # one dimension has no variance: two components are left
    assert {r.component for r in got if r.whitened is None} == {3}
    assert all(r.identity_error < 1e-4 for r in got)
    same = whitening.whiten(frame.filter("vec_id = 1")).collect()
    assert len(same) == 6 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in same)
    for none in (frame.limit(0), frame.filter("vec_id = 4"), frame.filter("vec_id = 9")):
        assert whitening.whiten(none).count() == 0


# ---- operator 13

def word_set(text, k=5):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} or ({tuple(ws)} if ws else set())


def brute_components(docs, percent=80):
    """(doc_id, n_shingles, component_id) by all pairs that share a shingle."""
    sets, holders = [word_set(t) for _, t in docs], defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in {p for members in holders.values() for p in combinations(members, 2)}:
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)), key=str)


def joined(frame, **options):
    return sorted(map(tuple, setjoin.jaccard_components(frame, **options).select(
        "doc_id", "n_shingles", "component_id").collect()), key=str)


def test_jaccard_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = sorted(map(tuple, setjoin.op13_jaccard_join(spark, SF).select(
        "doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == brute_components(docs) and len({g[2] for g in got}) < len(got)


def crowded(seed, groups=6, members=25):
    """Near copies at all distances around the limit, chained, and passages
    that unrelated texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randrange(8, 130)) + (passage if rng.random() < 0.7 else [])
        for _ in range(members):
            t = list(base if not texts or rng.random() < 0.6 else texts[-1].split())
            for _ in range(rng.randrange(0, 4)):
                at = rng.randrange(len(t))
                t[at:at + rng.randrange(0, 2)] = rng.choices(vocabulary, k=rng.randrange(0, 3))
            texts.append(" ".join(t) or "x")
        texts.append(" ".join(passage + rng.choices(vocabulary, k=10)))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, task_hashes", [(1, 1 << 20), (2, 1500), (3, 300)])
def test_jaccard_near_copies(spark, seed, task_hashes):
    """The smaller tasks split neighbourhoods into chunks and blocks."""
    docs = crowded(seed)
    got = joined(spark.createDataFrame(docs, "doc_id long, text string"), task_hashes=task_hashes)
    assert got == brute_components(docs)


def test_jaccard_index_equals_all_pairs(monkeypatch):
    for seed in range(6):
        sets = sorted({frozenset(hash(g) for g in word_set(t)) for _, t in crowded(seed, 4, 15)}, key=len)
        for mu in (setjoin.MU, 1.0, 1e-9):  # none to nearly all lists are long
            monkeypatch.setattr(setjoin, "MU", mu)
            index = setjoin.Index([np.array(sorted(s), dtype=np.int64) for s in sets], np.arange(len(sets)))
            want = {(i, j) for i, j in combinations(range(len(sets)), 2)
                    if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
            assert {(q, p) for q in range(len(sets)) for p in index.partners(q)} == want


def test_merge_skip():
    rng = random.Random(7)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randrange(1, 20))) for _ in range(rng.randrange(1, 8))]
        times = rng.randrange(1, len(lists) + 2)
        count = {x: sum(x in one for one in lists) for x in range(30)}
        assert setjoin.merge_skip(lists, times) == {x: n for x, n in count.items() if n >= times}


def test_jaccard_odd_rows(spark):
    nine = "a b c d e f g h i"
    rows = [(1, None), (2, ""), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (6, "a b c d"), (7, nine), (8, nine.upper()),
            (None, nine), (None, "q"), (None, None), (9, nine + " j"), (10, "\x1c a b"), (11, "é É"), (12, "É É"),
            (13, nine), (13, nine), (14, "z " * 30_000), (15, "z " * 6), (16, "z z z z z")]
    frame = spark.createDataFrame([(*r, 5, "y") for r in rows], "doc_id long, text string, n long, k1 string")
    got = joined(frame)
    assert got == brute_components_with_empty(rows)
    assert [g for g in got if g[0] == 9] == [(9, 6, 7)]  # 5 of 6 are common
    assert {g[2] for g in got if g[0] in (14, 15, 16)} == {14}
    assert joined(frame.limit(0)) == [] and joined(frame.filter("doc_id = 1")) == [(1, 0, 1)]


def brute_components_with_empty(rows):
    """Empty sets are linked with nothing, copies of the same row included."""
    some = [r for r in rows if word_set(r[1])]
    return sorted([*brute_components(some), *((d, 0, d) for d, t in rows if not word_set(t))], key=str)


def test_jaccard_hot_shingles(spark, monkeypatch):
    """Small blocks and parts: a passage in a third of all texts leaves each
    block once, and no credit is lost."""
    monkeypatch.setattr(setjoin, "BLOCK_ROWS", 8)
    monkeypatch.setattr(setjoin, "PART_HASHES", 200)
    docs = crowded(11, 8, 12)
    rows = spark.createDataFrame([(i, t) for i, t in docs] * 2, "doc_id long, text string").repartition(6)
    assert joined(rows) == sorted(brute_components(docs) * 2, key=str)
