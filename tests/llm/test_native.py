"""Quality rules, mixing and sharding against brute force in Python."""

import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from arrivo.llm import mixing, quality, sharding
from arrivo.llm.common import running_sums, table, word_count

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta " * 8000
TEXTS = ["", None, "   \n\t ", "one", "a b", "a b c", "a b c a b c", "x y x y x y", "a\nb\na\n\n \na", "# $ | <b> 5%",
         LONG, "w1 w2 w3 w4 w5 w1 w2 w3 w9 " * 3, " lead and trail \x0b\x0c", "nbsp\xa0is a word é"]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}", 1) for i, t in enumerate(TEXTS)]
    rows += [(3, "one", "en", "s0", 1)] * 2 + [(None, "a b c d", None, None, None)]
    return frame(spark, rows)


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base(t):
    ws, t = split(t), t or ""
    wins = Counter(zip(ws, ws[1:], ws[2:]))
    covered = {j for i, w in enumerate(zip(ws, ws[1:], ws[2:])) if wins[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if split(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, docs):
    for r in quality.quality_report(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        want = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.text
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality.quality_report(docs).count() == docs.count()


def test_quality_order_does_not_change_the_verdict(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rules = quality.text_rules()
    plans = [rules, rules[::-1], quality.plan_cascade(docs, rules, 50)]
    kept = [{r.doc_id for r in docs.filter(quality.verdict(p).isNull()).collect()} for p in plans]
    assert kept[0] == kept[1] == kept[2] and 0 < len(kept[0]) < docs.count()
    assert {r.name for r in plans[2]} == {r.name for r in rules}


def test_cascade_order_is_that_of_the_costs(spark):
    """A rule that hashes each text 200 times over comes after the cheap one
    that rejects as many, and one that rejects nothing comes last."""
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    even = F.crc32("text") % 2 == 0
    dear = F.aggregate(F.sequence(F.lit(1), F.lit(200)), F.lit(0).cast("long"),
                       lambda a, i: a.bitwiseXOR(F.xxhash64(F.concat("text", i.cast("string"))))) % 2 == 0
    rules = [quality.Rule("never", F.length("text") < 0), quality.Rule("dear", dear), quality.Rule("cheap", even)]
    for _ in range(2):
        assert [r.name for r in quality.plan_cascade(docs, rules)] == ["cheap", "dear", "never"]
    plan = docs.sample(0.5, 1).limit(10)._jdf.queryExecution().executedPlan().toString()
    assert "Sample" in plan


def test_quality_keeps_clean_and_drops_junk(spark):
    joined = quality.quality_report(table(spark, "/root/testdata/sf0.1", "documents")).join(
        table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").filter("not base_failed")
    got = {(r.quality, r.kept): r["count"] for r in joined.groupBy("quality", "kept").count().collect()}
    assert got.get((1, False), 0) <= 0.01 * got[1, True]
    assert got.get((0, True), 0) <= 0.1 * got[0, False]


def test_empty_and_clashing(spark, docs):
    none = docs.limit(0)
    assert quality.filter_quality(none).count() == 0
    assert mixing.mixed_documents(none).count() == 0
    assert sharding.shard_by_bytes(none).count() == 0
    odd = docs.withColumns({c: F.lit("x") for c in (
        "__id", "__SOURCE", "size", "n_words", "kept", "target", "h", "rid", "shard", "words", "u")})
    assert quality.filter_quality(odd).columns == odd.columns
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert sharding.shard_by_bytes(odd).count() == odd.count()


def waterfill(sizes, weights, most):
    """Targets by repeated sharing, source by source order."""
    left, free, out = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        full = [i for i in free if most * sizes[i] <= level * weights[i]]
        if not full:
            for i in free:
                out[i] = level * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
            free.remove(i)
    return out


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 100, 5], [0, 7, 1000, 3, 2], [1, 1, 500, 2, 1, 90]])
def test_mix_targets(spark, sizes):
    rows = [(i, "w " * n, "en", None if i == len(sizes) - 1 else f"s{i}", 0) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in mixing.mix(frame(spark, rows)).collect()}
    want = waterfill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3)
    for i, w in enumerate(want):
        assert got[None if i == len(sizes) - 1 else f"s{i}"] == pytest.approx(w)


def test_mix_takes_near_target(spark, docs):
    big = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix(big).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r.times <= 3 * r.copies
        taken[r.source] += r.times * r["size"]
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
    assert sum(taken.values()) <= sum(r["size"] * r.copies for r in rows)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2 * largest[s] + max(largest.values()) / 10
    again = {(r.doc_id, r.source, r["size"]): r.times for r in mixing.mix(big.repartition(7)).collect()}
    assert again == {(r.doc_id, r.source, r["size"]): r.times for r in rows}
    mixed = mixing.mixed_documents(docs)
    want = Counter({(r.doc_id, r.source, r["size"]): r.times for r in mixing.mix(docs).collect()})
    got = Counter((r.doc_id, r.source, len(split(r.text))) for r in mixed.collect())
    assert got == +want


@pytest.mark.parametrize("copies", [50, 150, 350, 3000])
def test_mix_repeated_rows(spark, copies, tmp_path):
    """One row repeated often: its source still ends near its target, the
    rows taken are those of the mix, and the SQL states the same."""
    rows = [(i, "w " * 100, "en", "abc"[i % 3], i) for i in range(300)] + [(10 ** 6, "w " * 100, "en", "b", 0)] * copies
    docs = frame(spark, rows)
    groups = mixing.mix(docs).collect()
    taken, target, want = Counter(), {}, {}
    for r in groups:
        taken[r.source] += r.times * r["size"]
        target[r.source] = r.target
        want[r.doc_id] = r.times
    assert sum(r.copies for r in groups) == len(rows)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 300, (s, taken, target)
    mixed = Counter(r.doc_id for r in mixing.mixed_documents(docs).select("doc_id").collect())
    assert mixed == +Counter(want)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "size", "source_size", "taken"]
    got = Counter(tuple(r[c] for c in names) for r in mixing.op5_mixing(spark, str(tmp_path)).collect())
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert got == Counter(db.execute(f"SELECT {', '.join(names)} FROM ({mixing.OP5_SQL})").fetchall())


def test_shards(spark, docs):
    big = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    hot = spark.range(10_000, 13_000).select(F.col("id").alias("doc_id"), F.lit("copy of one text " * 9).alias("text"))
    # without the one text that is larger than a shard
    odd = docs.filter("text is null or length(text) < 1000").select(F.col("doc_id") + 20_000, "text")
    every = big.unionByName(hot).unionByName(odd.toDF("doc_id", "text"))
    rows = sharding.shard_by_bytes(every).collect()
    text = {r.doc_id: r.text or "" for r in every.collect()}
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in every.collect())
    load, slots, homes = Counter(), {}, {}
    for r in rows:
        t = text[r.doc_id]
        assert r["size"] == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode())
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        homes.setdefault(t, Counter())[r.shard] += r["size"]
    mean = sum(load.values()) / 24
    assert set(load) == set(range(24))
    biggest = max(r["size"] for r in rows)
    assert all(abs(x - mean) <= 0.06 * mean + 2 * biggest for x in load.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values() if sum(h.values()) <= 0.05 * mean)
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shard_by_bytes(every.repartition(5)).collect()
             if r.doc_id is not None and r.doc_id < 20_000}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows if r.doc_id is not None and r.doc_id < 20_000}


def test_shards_of_few_rows_and_one_repeated_row(spark):
    rows = frame(spark, [(7, "same", "en", "s", 1)] * 5000)
    got = sharding.shard_by_bytes(rows, 8)
    sizes = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    assert sharding.shard_by_bytes(rows.limit(1), 8).count() == 1


def test_running_sums(spark):
    df = spark.createDataFrame([(g, i, i * i) for g in "ab" for i in range(40)], "g string, i int, v long").withColumn(
        "bucket", F.floor(F.col("i") / 7))
    for r in running_sums(df, ["g"], "bucket", [F.col("i")], {"v": "s"}).collect():
        assert r.s == sum(k * k for k in range(r.i + 1))


def test_word_count(spark, docs):
    for r in docs.select("text", word_count(F.col("text")).alias("n")).collect():
        assert r.n == len(split(r.text))
