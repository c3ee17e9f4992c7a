"""SimHash and toxicity against brute force and held-out labels."""

import math
import random
import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pytest
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.llm import simhash, toxicity
from arrivo.llm.common import table

SF = "/root/testdata/sf0.1"


def slow_fingerprint(text, k=3):
    ws = (text or "").translate({c: c + 32 for c in range(65, 91)})
    ws = [w for w in ws.translate(dict.fromkeys([9, 10, 11, 12, 13], " ")).split(" ") if w]
    if not ws:
        return 0
    parts = [" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint():
    long = " ".join(f"Word{i % 777}" for i in range(70_000))
    for t in ["", None, " \n", "One", "one TWO", "a b c", "Ä É b c d", "nbsp\xa0x y z a b", "a b c " * 50, long]:
        assert simhash.fingerprint_of(t) % (1 << 64) == slow_fingerprint(t)


def test_fingerprint_equals_spark_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("only two")).alias("h")).first().h
    assert simhash.fingerprint_of("Only TWO") == got


def brute_components(fps, budget=2):
    x = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= budget
    label = np.arange(len(x))
    while True:
        low = np.array([label[n].min() for n in near])
        if (low == label).all():
            return label
        label = low


def made_fingerprints(n, seed=5):
    """Random ones, chains of near ones, and a dense group under one node."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        out.append(rng.choice(out) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    out += [0xABCDEF << 40 | rng.getrandbits(9) for _ in range(n)]
    return sorted(set(out))


@pytest.mark.parametrize("node_rows", [100_000, 48])
def test_trie_join(spark, node_rows):
    fps = made_fingerprints(200)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.v: r.root for r in simhash.components(simhash.links(df, 2, node_rows)).collect()}
    label = brute_components(fps)
    groups = {}
    for s, lab in zip(signed, label):
        groups.setdefault(lab, []).append(s)
    want = {v: min(g) for g in groups.values() for v in g if v != min(g)}
    assert roots == want


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    assert {r.root for r in simhash.components(df).collect()} == {0}


def test_near_duplicates(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = simhash.near_duplicates(docs).collect()
    ids = [r.doc_id for r in rows]
    label = brute_components([r.fp % (1 << 64) for r in rows])
    smallest = {}
    for i, lab in zip(ids, label):
        smallest[lab] = min(smallest.get(lab, i), i)
    assert all(r.component_id == smallest[lab] for r, lab in zip(rows, label))
    assert len(set(smallest.values())) < len(rows)
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(smallest.values())


def test_near_duplicates_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __own string, fp string"
    rows = [(1, None), (2, ""), (3, " \n"), (None, "same words here now"), (None, "same words here now"),
            (5, "Same WORDS here now"), (6, "other words stand here"), (6, "other words stand here"), (7, None)]
    df = spark.createDataFrame([(i, t, None, None, None, "x", "y") for i, t in rows], schema)
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == Counter({(1, 1): 1, (2, 1): 1, (3, 1): 1, (7, 1): 1, (None, 5): 2, (5, 5): 1, (6, 6): 2})
    kept = simhash.keep_one_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5, 6]
    lonely = df.filter("doc_id is null")
    assert [r.doc_id for r in simhash.keep_one_each(lonely).collect()] == [None]
    assert simhash.keep_one_each(df.limit(0)).count() == 0


def marked(clause, lexicon=toxicity.Lexicon({"idiot": 1.0}, {"lowei": 0.5})):
    return dict(toxicity.clause_events(lexicon.arcs(clause)))


def test_grammar():
    assert marked("what an idiot indeed") == {"I": 1.0}
    assert marked("you are an idiot") == {"It": 1.0}
    assert marked("you are not an idiot") == {"Int": 1.0}
    assert marked("she said you are an idiot") == {"Irt": 1.0}
    assert marked("she said you are not an idiot") == {"Irnt": 1.0}
    assert marked("idiot you") == {"I": 1.0, "a": 1.0}
    assert marked("i will kill you") == {"T": 1.0, "a": 1.0}
    assert marked("loweisch und loweien") == {"I": 1.0}
    assert marked("nothing of that kind") == {}
    assert marked("not at all in any way an idiot") == {"I": 1.0}


def test_composition_equals_running_in_turn():
    rng = random.Random(1)
    machines = [toxicity.reported(toxicity.INPUT),
                toxicity.window(toxicity.events(("r",)) + toxicity.PLAIN, "N", 2, "n"),
                toxicity.window(toxicity.events(("r", "n")) + toxicity.PLAIN, "Y", 4, "t"),
                toxicity.addressed(toxicity.events(("r", "n", "t")) + toxicity.PLAIN, 2)]
    for _ in range(300):
        symbols = [rng.choice(toxicity.INPUT) for _ in range(rng.randrange(12))]
        state, got = 0, []
        for s in symbols:
            state, out = toxicity.GRAMMAR.step(state, s)
            got.append(out)
        for m in machines:
            state, out = 0, []
            for s in symbols:
                state, o = m.step(state, s)
                out.append(o)
            symbols = out
        assert got == symbols


def test_clauses_of_whole_texts():
    lexicon = toxicity.Lexicon({"idiot": 1.0}, {})
    finder = lexicon.finder()
    text = "fine words here. " * 20_000 + "You idiot! Not an idiot; IDIOT\nthe end idiot"
    assert toxicity.text_events(text, lexicon, finder) == Counter({"It": 1.0, "In": 1.0, "I": 2.0})
    assert toxicity.text_events(None, lexicon, finder) == toxicity.text_events("", lexicon, finder) == Counter()
    assert toxicity.text_events("idiotic nonidiot", lexicon, finder) == Counter()


def test_held_out_accuracy(spark):
    scored = toxicity.op2_toxicity(spark, SF).join(table(spark, SF, "labels"), "doc_id").filter("held_out")
    got = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    hit, miss, false = got[1, 1], got.get((1, 0), 0), got.get((0, 1), 0)
    assert hit / (hit + miss) >= 0.85 and hit / (hit + false) >= 0.9
    edge = scored.agg(F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert 0 <= edge.lo < edge.hi <= 1


def test_held_out_labels_are_not_used(spark):
    docs, labels = table(spark, SF, "documents").limit(1500), table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(
        F.col("toxic")))
    a, b = (toxicity.train(docs, x) for x in (labels, flipped))
    assert a.lexicon == b.lexicon and np.allclose(a.weights, b.weights) and a.bias == pytest.approx(b.bias)


def test_only_near_copies_are_one_training_row(spark):
    least = spark.range(20_000).select(F.col("id"), F.xxhash64(F.lit("q"), F.lit("r"), F.concat(F.lit("w"), "id")).alias("h"))
    word = f"w{least.orderBy('h').first().id}"
    rng = random.Random(8)
    base = [f"b{k}" for k in range(100)]
    rows = [(i, f"q r {word} " + " ".join(f"u{i}x{k}" for k in range(10))) for i in range(100)]
    rows += [(i, " ".join(base[:(p := rng.randrange(100))] + [f"v{i}"] + base[p + 1:])) for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    known = {r.doc_id for r in docs.filter(~toxicity.held_out(F.col("doc_id"))).collect()}
    got = toxicity.training_sample(docs, labels).collect()
    assert sum(r.text.startswith("q r ") for r in got) == sum(i < 100 for i in known)
    assert sum(r.text.startswith(("b0", "v")) for r in got) <= 8
    assert sum(r.weight for r in got) == pytest.approx(len(known))


def test_lexicon_keeps_weaker_terms_beside_many(spark):
    strong = " ".join("".join("abcdefghij"[int(d)] for d in f"{i:03d}") + "xstrong" for i in range(1000))
    rows = [(f"{strong} {'weakish' if i < 20 else ''}", 1, 1.0) for i in range(30)]
    rows += [("fine words here", 0, 1.0) for _ in range(270)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int, weight double"))
    assert marked("a weakish thing", lexicon)
    assert all(marked(w, lexicon) for w in strong.split())


def test_forms_of_seed_words():
    assert marked("I am killing you") == {"T": 1.0, "a": 1.0}
    assert marked("he kills them") == {"Tt": 1.0, "a": 1.0}
    assert marked("ich töte dich") == {"T": 1.0, "a": 1.0}
    assert marked("you're an idiot") == marked("you’re an idiot") == {"It": 1.0}
    assert marked("nobody is idiot") == marked("doesn't seem idiot") == {"In": 1.0}


def test_marks_are_learned_from_places(spark):
    rng = random.Random(5)
    fill = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]

    def text(*core):
        return " ".join(rng.choices(fill, k=6) + list(core) + rng.choices(fill, k=6))

    rows = [(text("zork", "blah", "moronic"), 1, 1.0) for _ in range(60)]
    rows += [(text("moronic"), 1, 1.0) for _ in range(60)] + [(text("moronic"), 0, 1.0) for _ in range(60)]
    rows += [(text("hardly", "moronic"), 0, 1.0) for _ in range(60)]
    sample = spark.createDataFrame(rows, "text string, toxic int, weight double")
    got = toxicity.learn_marks(sample, toxicity.Lexicon({"moronic": 1.0}, {})).marks
    assert got["hardly"] == "N" and got["zork"] == got["blah"] == "Y" and len(got) <= 5
    assert toxicity.learn_marks(sample.limit(0), toxicity.Lexicon({"moronic": 1.0}, {})).marks == {}


def test_words_beside_surer_insults_are_no_marks(spark):
    rows = [("an zork", 1, 1.0)] * 90 + [("der bleh", 1, 1.0)] * 60 + [("der bleh", 0, 1.0)] * 60
    sample = spark.createDataFrame(rows, "text string, toxic int, weight double")
    assert toxicity.learn_marks(sample, toxicity.Lexicon({"zork": 1.5, "bleh": 0.6}, {})).marks == {}


def test_repeated_ids_count_once(spark):
    docs = spark.createDataFrame([(i // 50, f"text {i} " + " ".join(f"w{i}x{k}" for k in range(9))) for i in range(500)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i % 10, int(i % 10 == 3 and i > 900)) for i in range(1000)],
                                   "doc_id long, toxic int")
    got = toxicity.training_sample(docs, labels).collect()
    known = [i for i in range(10) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(int(r.text.split()[1]) // 50 for r in got) == known
    assert {int(r.text.split()[1]) // 50 for r in got if r.toxic} == {3} & set(known)


def plain_events(text, lexicon):
    """Marks by their definition, clause by clause, without machines."""
    out = Counter()
    for clause in re.split(r"[.!?;\n]+", (text or "").lower()):
        ws = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?", clause)
        weights = [max([lexicon.words.get(w, 0), *(v for k, v in lexicon.stems.items() if w.startswith(k))]) for w in ws]
        symbols = ["I" if v else lexicon.marks.get(w) or toxicity.seed_symbol(w) for w, v in zip(ws, weights)]
        last = -9
        for i, x in enumerate(symbols):
            if x in "IT":
                mark = ("r" if "R" in symbols[:i] else "") + ("n" if "N" in symbols[max(i - 2, 0):i] else "") + (
                    "t" if "Y" in symbols[max(i - 4, 0):i] else "")
                out[x + mark] += weights[i] or 1.0
                last = i
            elif x == "Y":
                if i - last <= 2:
                    out["a"] += 1.0
                last = -9
    return out


def test_lexicon_fit_and_scores_equal_brute_force(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    sample = toxicity.training_sample(docs, labels)
    rows = sample.collect()
    lexicon = toxicity.learn_lexicon(sample)
    n = Counter(r.toxic for r in rows)
    held = {0: Counter(), 1: Counter()}
    for r in rows:
        ws = set(re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?", r.text.lower()))
        held[r.toxic].update({w + "$" for w in ws} | {w[:k] for w in ws for k in range(4, 9) if k <= len(w)})
    odds, rate = {}, n[1] / (n[0] + n[1])
    for t, a in held[1].items():
        b = held[0][t]
        share = a / (a + b)
        gain = a * math.log(share / rate) + (b * math.log((1 - share) / (1 - rate)) if b else 0)
        o = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
        if o >= 3 and gain > 1 + math.log((n[0] + n[1]) * 300):
            odds[t] = o
    assert odds
    want = {}
    for t in sorted(odds, key=lambda t: (len(t), t)):
        if any(u != t and u.startswith(t) and held[1][u] >= 0.9 * held[1][t] for u in odds):
            continue
        if all(odds[t] > want[s] + 0.5 for s in want if len(s) < len(t) and t.startswith(s)):
            want[t] = odds[t]
    weights = {t: min(o / 5, 1.5) for t, o in want.items()}
    assert lexicon.words == pytest.approx({t[:-1]: w for t, w in weights.items() if t[-1] == "$"})
    assert lexicon.stems == pytest.approx({t: w for t, w in weights.items() if t[-1] != "$"})

    model = toxicity.train(docs, labels)
    x = np.array([[math.log1p(plain_events(r.text, model.lexicon)[k]) for k in toxicity.KINDS] + [1.0] for r in rows])
    y, c = (np.array([r[k] for r in rows], dtype=float) for k in ("toxic", "weight"))
    w, start = np.append(model.weights, model.bias), np.append(toxicity.PRIOR, toxicity.PRIOR_BIAS)
    slope = x.T @ (c * (1 / (1 + np.exp(-x @ w)) - y)) + np.append(np.full(len(toxicity.KINDS), 0.05), 0.005) * (w - start)
    assert np.abs(slope).max() < 1e-3  # the only minimum of a convex loss

    for r in docs.select("text", toxicity.toxicity(F.col("text"), model).alias("p")).collect():
        found = plain_events(r.text, model.lexicon)
        z = model.bias + sum(math.log1p(found[k]) * v for k, v in zip(toxicity.KINDS, model.weights))
        assert r.p == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_toxicity_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "you idiot"), (3, "x " * 100_000)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, score string, toxic int")
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = docs.select("doc_id", toxicity.toxicity(F.col("text"), model).alias("p")).collect()
    assert len(got) == 5 and all(0 <= r.p <= 1 for r in got)
    assert {r.doc_id for r in got if r.p >= 0.3} == {None}
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    empty = docs.limit(0)
    assert toxicity.drop_toxic(empty, toxicity.train(empty, labels.limit(0))).count() == 0


def test_union_of_links_has_one_schema(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "fp long")
    parts = [rows for _, rows in simhash.node_pairs(df, 2, 8)]
    assert len(parts) > 1 and reduce(DataFrame.unionByName, parts).columns == ["fp", "mask", "node", "side"]
