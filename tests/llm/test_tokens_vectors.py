"""Token counts, byte-level BPE and nearest neighbours against the public
library and brute force; the pipeline against its parts."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from arrivo.llm import bpe, mixing, quality, registry, simhash, tokencounts, toxicity, vptree
from arrivo.llm.common import table

SF = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path(bpe.RANKS)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS),
                             special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)


def odd_texts(n):
    rng = random.Random(3)
    pool = "abc XYZ  \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ​　﻿'sré12½!?{}<|endoftext|>日本\U0001f642́\x00"
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_bpe_equals_library(codec, encoding):
    rng = random.Random(4)
    long = ["".join(rng.choice("abcdefgh") for _ in range(3000)), "aab" * 400, "z" * 30_001, "日本語" * 300, "=" * 999]
    texts = [*odd_texts(3000), *long, "", "   ", "a" * 3000, "don't we'll I'M", "\n\n a", "<|endoftext|>", "word " * 50_000]
    ids = codec.encode(texts)
    assert [i.tolist() for i in ids] == [encoding.encode_ordinary(t) for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_bpe_pieces_without_spaces(encoding):
    """A thousand pieces of 180 bytes, text without spaces in several scripts,
    long runs of one letter: right, and without a query for each."""
    rng = random.Random(5)
    letters = {"han": (0x4e00, 0x7000), "kana": (0x3042, 0x3093), "thai": (0xe01, 0xe2e), "latin": (0x61, 0x7b)}
    word = {k: lambda n, a=a: "".join(chr(rng.randrange(*a)) for _ in range(n)) for k, a in letters.items()}
    texts = [word["han"](60) for _ in range(1000)] + [word[k](4000) for k in letters]
    texts += ["".join(rng.choice("ACGT") for _ in range(100_000)), "=" * 20_000, "ab" * 9_000, "-" * 300 + "=" * 300]
    codec = bpe.Codec(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    start = time.process_time()
    ids = codec.encode(texts)
    assert time.process_time() - start < 15
    assert [i.tolist() for i in ids] == [encoding.encode_ordinary(t) for t in texts]


def test_bpe_parts_join_to_the_piece(codec):
    for raw in ["日本語の文章".encode() * 30, b"qxzjvk" * 50, b"a", b"\xff\xfe", b"token" * 40]:
        parts = codec.split(raw)
        assert b"".join(parts) == raw and all(parts)
        for n in range(1, len(parts)):
            at = len(b"".join(parts[:n]))
            assert not any(raw[i:j] in codec.ranks for i in range(max(0, at - 40), at) for j in range(at + 1, at + 40))


def test_bpe_long_parts_in_blocks(codec, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_ROWS", 2_000)
    monkeypatch.setattr(bpe, "LONG_PIECE", 8)
    codec.forget()
    texts = ["ab" * 90, "=" * 700, "aab" * 130, "z" * 64, "tokenization" * 12, "information" * 30]
    assert [i.tolist() for i in codec.encode(texts)] == [encoding.encode_ordinary(t) for t in texts]
    codec.forget()


def test_bpe_letters_are_the_library_s(codec):
    """Over all code points: pieces are cut as the library's classes say."""
    ranks = bpe.load_ranks(RANKS)
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        library = tiktoken.Encoding("one", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
        find = bpe.finder(kind)
        assert [c for c in chars if find(c)] == [c for c in chars if library.encode_ordinary(c)], kind
    for c in "\u0558\u088f\ua7f1\U00010ee7\U0001246f\U000323b0":
        assert codec.find(f" {c}a1") == [f" {c}", "a", "1"]


def test_bpe_forgets_safely(codec, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ROWS", 20)
    monkeypatch.setattr(bpe, "PIECE_ROWS", 200)
    for t in odd_texts(40):
        assert codec.encode([t])[0].tolist() == encoding.encode_ordinary(t)


def test_bpe_whole_table(spark, encoding):
    text = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = bpe.op1_byte_bpe(spark, SF).collect()
    assert len(got) == len(text)
    for r in got:
        ids = encoding.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_bpe_odd_rows(spark):
    rows = [(1, None, 0), (1, None, 0), (None, "x y", 0), (2 ** 60 + 1, "", 0), (4, "z" * 200_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.round_trip(docs, RANKS).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert sum(r.n_tokens == 0 and r.ids_sha256 == r.decoded_sha256 == none for r in got) == 3
    encoded = bpe.encode_documents(docs, RANKS)
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode_documents(encoded, RANKS).collect()}
    assert back == {i: (t or "").encode() for i, t, _ in rows}
    assert bpe.round_trip(docs.limit(0), RANKS).count() == 0


def test_token_counts(spark):
    path = public_tokenizers.path(tokencounts.RANKS)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokencounts.load_ranks(path),
                            special_tokens={})
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string"))
    n = np.array([len(lib.encode_ordinary(r.text or "")) for r in docs.collect()])
    hist = tokencounts.length_histogram(docs, path)
    sums = tokencounts.suffix_sums(hist).cache()
    for r in sums.collect():
        assert r.docs == (n == r.n_tokens).sum() and r.tokens == n[n == r.n_tokens].sum()
        assert r.docs_at_least == (n >= r.n_tokens).sum() and r.tokens_at_least == n[n >= r.n_tokens].sum()
        assert r.truncated_total == np.minimum(n, r.n_tokens).sum()
        assert r.quantile == pytest.approx((n <= r.n_tokens).mean())
    for limit, a in tokencounts.answer_limits(sums, [0, 1, 300, 1024, 10 ** 7]).items():
        assert a == {"docs_longer": (n > limit).sum(), "tokens_longer": n[n > limit].sum(),
                     "truncated_total": np.minimum(n, limit).sum()}
    assert tokencounts.quantiles(sums, [0.5, 0.9]) == [int(np.quantile(n, q, method="inverted_cdf")) for q in (0.5, 0.9)]
    none = tokencounts.suffix_sums(tokencounts.length_histogram(docs.limit(0), path))
    assert none.count() == 0 and tokencounts.quantiles(none, [0.5]) == [None]


def brute(ids, x, qid, q, k):
    out = []
    for i, v in zip(qid, q):
        s = (x * v).sum(axis=1)
        out.append([(int(ids[j]), s[j]) for j in np.lexsort((ids, -s)) if ids[j] != i][:k])
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_exact_search(spark, scale):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 8)).round(2)
    x = x * rng.uniform(0.1, 5, size=(700, 1)) if scale else x / np.linalg.norm(x, axis=1, keepdims=True)
    x[200:420] = x[7]  # a very common vector
    ids = rng.permutation(700)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, vec array<double>")
    got = vptree.nearest(df, df.filter("vec_id % 20 = 0"), 20, 1.0, shard_rows=300, query_rows=20).collect()
    ask = ids % 20 == 0
    for i, want in zip(ids[ask], brute(ids, x, ids[ask], x[ask], 20)):
        rows = sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert [r.vec_id for r in rows] == [v for v, _ in want]
        assert [r.score for r in rows] == pytest.approx([s for _, s in want], abs=1e-12)


def test_far_larger_vectors_spoil_no_search(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[3] *= 1e8  # a candidate
    x[40] *= 1e8  # a query as well
    ids = np.arange(600)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, vec array<double>")
    got = {}
    for r in vptree.nearest(df, df.filter("vec_id % 20 = 0"), 20, 1.0, shard_rows=400).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {int(i): [v for v, _ in w] for i, w in zip(ids[::20], brute(ids, x, ids[::20], x[::20], 20))}


def test_recall_of_the_query(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = {}
    for r in vptree.op7_nearest_neighbours(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    ask = ids % 20 == 0
    want = brute(ids, x, ids[ask], x[ask], 20)
    recall = np.mean([len(got[i] & {v for v, _ in w}) / 20 for i, w in zip(ids[ask], want)])
    assert recall >= 0.97 and len(got) == ask.sum()


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [-1.0, 0.0]), (40, [nan, 0.0]), (1, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, vec array<double>, rank int")
    got = vptree.nearest(df, df.filter("vec_id % 20 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 0.5), (0, 2, 1, 0.5), (0, 3, 8, -1.0)]
    assert vptree.nearest(df.limit(0), df).count() == 0
    assert vptree.nearest(df, df.limit(0)).count() == 0


def test_pipeline_against_its_parts(spark, encoding):
    import corpus_pipeline
    docs = table(spark, SF, "documents")
    good = {r.doc_id for r in quality.quality_report(docs).filter("kept").collect()}
    model = toxicity.train(docs, table(spark, SF, "labels"))
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in good}
    ids = list(rows)
    fine = {i for i, s in zip(ids, model.scores([rows[i].text for i in ids])) if s < toxicity.THRESHOLD}
    left = docs.filter(F.col("doc_id").isin(list(fine)))
    one = {r.component_id for r in simhash.near_duplicates(left).collect()}
    taken = {r.doc_id: r.times for r in mixing.mix(docs.filter(F.col("doc_id").isin(list(one)))).collect() if r.times}
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
        assert r.n_tokens == len(encoding.encode_ordinary(rows[r.doc_id].text))
    assert got == taken and 0 < len(one) < len(fine) < len(good)


def test_stages_keep_columns_and_pass_empty_tables(spark):
    import corpus_pipeline
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry
    for n in range(1, 11):
        assert len([q for q in registry.QUERIES if q.startswith(f"op{n}_")]) == 1
    assert set(registry.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(registry.ORACLE_SQL) <= set(entry.oracle_sql())
