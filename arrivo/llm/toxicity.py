"""Operator 2, toxicity by a weighted finite-state pattern grammar.

A clause is turned into a string over a small alphabet: insult (I), threat
(T), target (Y), negation (N), reported speech (R), other (O). Four Mealy
machines rewrite that string, each marking events by what stands around
them, and are composed into one transducer before any text is read:

- reported speech marks events that follow a verb of saying (``r``),
- negation marks events up to two words after a negation (``n``),
- target marks events up to four words after a target (``t``),
- address turns a target up to two words after an event into ``a``.

The first arcs carry weights too: the insult lexicon is learned, whole words
and word stems that a labelled sample holds in toxic texts far above chance,
each with its log-odds. The words that stand before a lexicon word are learned
as well: such that make a text far less often toxic than other texts with a
lexicon word are negations, such that make it far more often toxic are targets.
The seed words are what is known before. The weights of a text's events are
summed for each kind of event; logistic regression on the sums scores the text.

Only rows whose crc32(doc_id as text) mod 4 is not ``HELD_OUT`` are learned
from, at most about ``TRAIN_DOCS`` of each label (a bounded sample by hash). A
doc_id that the labels repeat counts once, as toxic if any of its labels is; a
doc_id that the documents repeat, with the text of the least hash. Every text is scored whole. Null and empty texts have no clause and get the
score of a text without events; so do all texts if no label can be learned
from and no seed word matches. Repeated rows score alike; an empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import let, small_batches, table, uniform, words
from arrivo.session import cut_lineage

#: Bound of the training sample, for each label.
TRAIN_DOCS = 4000
PARTS, HELD_OUT = 4, 2  # fixed by the data contract
THRESHOLD = 0.3  # fixed by the data contract
#: Stem lengths that the lexicon may use, and log-odds that a term needs.
STEMS, MIN_ODDS = range(4, 9), 3.0
#: Log-odds that a learned negation or target needs.
MARK_ODDS = 1.0
#: Terms of a text, as a bound of how many are tried for the lexicon.
TERMS_TRIED = 300
#: Further min-hashes that tell near copies, and the share alike that they need.
MIN_HASHES, NEAR = 128, 0.8
#: Log-odds of a lexicon entry that counts as weight 1.
FULL_WEIGHT = 5.0
L2 = 0.05

# Seed words (English, German, French, Spanish).
SEED_WORDS = {
    "T": "kill kills killed killing hurt hurts hurting shoot shoots shooting stab stabs stabbed stabbing strangle "
         "strangles strangled strangling murder murders murdered murdering töten töte tötet tötete getötet umbringen "
         "umbringe umgebracht ermorden ermordet tuer tuerai tuerons tuez assassiner matar mato mataré matado asesinar",
    "Y": "you your he his she they their him her them people du dein ihr euch dich vous votre tu toi usted tú ellos",
    "N": "not never no none nobody nothing neither without cannot nicht nichts niemand kein keine nie ohne pas rien "
         "aucun aucune jamais sans nunca nadie nada ningún sin",
    "R": "said says wrote called claimed quoted reported sagte schrieb dit écrit dijo escribió",
}
DEFAULT_LEXICON = "idiot moron stupid scum"

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;\n]+")
#: Words before an event that the grammar's negations and targets reach.
REACH_N, REACH_Y = 2, 4


class Machine:
    """A Mealy machine: ``arcs[state][symbol] = (next state, output)``;
    symbols without an arc keep state 0's way and pass unchanged."""

    def __init__(self, arcs: list[dict[str, tuple[int, str]]]):
        self.arcs = arcs

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs[state].get(symbol, (0, symbol))


def events(marks: tuple[str, ...]) -> list[str]:
    """Event symbols with any of the given marks, in order."""
    out = ["I", "T"]
    for m in marks:
        out += [e + m for e in out]
    return out


def reported(alphabet: list[str]) -> Machine:
    said = {s: (1, s + "r" if s[0] in "IT" else s) for s in alphabet}
    return Machine([{"R": (1, "R")}, said])


def window(alphabet: list[str], opener: str, reach: int, mark: str) -> Machine:
    """Marks events within ``reach`` words after ``opener``."""
    arcs: list[dict] = [{opener: (reach, opener)}]
    for left in range(1, reach + 1):
        arcs.append({s: (reach if s == opener else left - 1, s + mark if s[0] in "IT" else s)
                     for s in alphabet})
    return Machine(arcs)


def addressed(alphabet: list[str], reach: int) -> Machine:
    """Turns a target within ``reach`` words after an event into ``a``."""
    arcs: list[dict] = []
    for left in range(reach + 1):
        arcs.append({s: (reach, s) if s[0] in "IT" else (0, "a") if s == "Y" and left else (max(left - 1, 0), s)
                     for s in alphabet})
    return Machine(arcs)


def compose(first: Machine, second: Machine, alphabet: list[str]) -> Machine:
    """The machine that feeds ``first``'s output to ``second``."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], []
    for p, q in todo:
        row = {}
        for s in alphabet:
            p2, mid = first.step(p, s)
            q2, out = second.step(q, mid)
            if (p2, q2) not in number:
                number[p2, q2] = len(todo)
                todo.append((p2, q2))
            row[s] = (number[p2, q2], out)
        arcs.append(row)
    return Machine(arcs)


INPUT = ["I", "T", "Y", "N", "R", "O"]
PLAIN = ["Y", "N", "R", "O"]


def grammar() -> Machine:
    machine = reported(INPUT)
    for build, marks in ((lambda a: window(a, "N", REACH_N, "n"), ("r",)),
                         (lambda a: window(a, "Y", REACH_Y, "t"), ("r", "n")),
                         (lambda a: addressed(a, 2), ("r", "n", "t"))):
        machine = compose(machine, build(events(marks) + PLAIN), INPUT)
    return machine


GRAMMAR = grammar()
KINDS = [*events(("r", "n", "t")), "a"]
#: What a kind adds before anything is learned: an event, less if negated or
#: reported, more if aimed at someone.
PRIOR = np.array([2.0 if k == "a" else 4.0 * (1 - 0.7 * ("r" in k) - 0.2 * ("n" in k)) + 1.0 * ("t" in k)
                  for k in KINDS])
PRIOR_BIAS = -4.0


@dataclass(frozen=True)
class Lexicon:
    """Weights of insults: whole words, and stems of words that begin so.
    ``marks`` are learned symbols of other words."""
    words: dict[str, float]
    stems: dict[str, float]
    marks: dict[str, str] = field(default_factory=dict)

    def arcs(self, clause: str) -> list[tuple[str, float]]:
        """Symbol and weight of each word of a clause."""
        out = []
        for w in WORD.findall(clause):
            weight = max([self.words.get(w, 0.0), *(self.stems.get(w[:n], 0.0) for n in STEMS)])
            out.append(("I", weight) if weight > 0 else (self.marks.get(w) or seed_symbol(w), 1.0))
        return out

    def finder(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for w in [*self.words, *self.stems, *SEED_WORDS["T"].split()]:
            found.add_word(w, w)
        found.make_automaton()
        return found


SYMBOL_OF = {w: symbol for symbol, ws in SEED_WORDS.items() for w in ws.split()}


def seed_symbol(word: str) -> str:
    """Symbol of a seed word; "isn't" negates, "you're" is its first part."""
    if word in SYMBOL_OF:
        return SYMBOL_OF[word]
    if word.endswith(("n't", "n’t")):
        return "N"
    return SYMBOL_OF.get(re.split("['’]", word)[0], "O")


def clause_events(arcs: list[tuple[str, float]]) -> Counter:
    """Summed weights of the kinds of marked events in one clause."""
    state, out = 0, Counter()
    for symbol, weight in arcs:
        state, made = GRAMMAR.step(state, symbol)
        if made not in PLAIN:
            out[made] += weight
    return out


def text_events(text: str | None, lexicon: Lexicon, finder: ahocorasick.Automaton) -> Counter:
    """Summed weights of the kinds of marked events of a whole text. Clauses
    without a hit of the finder hold no event and are skipped."""
    out = Counter()
    for clause in hit_clauses((text or "").lower(), finder):
        out.update(clause_events(lexicon.arcs(clause)))
    return out


def hit_clauses(text: str, finder: ahocorasick.Automaton) -> Iterator[str]:
    """Clauses of a text that hold a hit of the finder."""
    hits = [end for end, _ in finder.iter(text)]
    if not hits:
        return
    start, at = 0, 0
    for stop in [*(m.start() for m in CLAUSE.finditer(text)), len(text)]:
        if at < len(hits) and hits[at] < stop:
            while at < len(hits) and hits[at] < stop:
                at += 1
            yield text[start:stop]
        start = stop


def features(found: Counter) -> np.ndarray:
    """Weight of each kind, damped so that length alone decides little."""
    return np.log1p(np.array([found[k] for k in KINDS], dtype=float))


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def scores(self, texts) -> list[float]:
        finder = self.lexicon.finder()
        return [1 / (1 + math.exp(-(self.bias + float(features(text_events(t, self.lexicon, finder)) @ self.weights))))
                for t in texts]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> DataFrame:
    """(text, toxic, weight) of labelled rows outside the held-out part, about
    ``bound`` of each label at most; the weight makes up for the share drawn.
    Copies and near copies (equal least hash of their word triples, and at
    least ``NEAR`` of ``MIN_HASHES`` further ones alike) are one row, or their
    rare words would pass for signs of the label."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.lit(1.0)  # no such label, no such row
    for value, n in counts.items():
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, bound / n))).otherwise(share)
    chosen = known.filter(uniform(F.col("doc_id"), F.lit("train")) < share)
    chosen = chosen.withColumn("weight", 1 / share)
    drawn = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "weight").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))
    triples = let(words(F.lower("text")), lambda w: F.transform(F.sequence(F.lit(0), F.greatest(
        F.size(w) - 3, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    texts = cut_lineage(drawn.groupBy("text", "toxic").agg(
        F.sum("weight").alias("weight"), F.min(F.xxhash64("text", "doc_id")).alias("order")), "toxicity-sample")
    texts = texts.withColumn("id", F.xxhash64("text", "toxic"))
    signed = texts.withColumn("triples", triples).select(
        "id", "toxic", "weight", "order", F.array_min("triples").alias("key"), _signature("triples").alias("signature"))
    rows = signed.orderBy("toxic", "key", "order").collect()  # as few as the sample
    kept = docs.sparkSession.createDataFrame(_near_copies(rows), "of long, sum double")
    return texts.join(F.broadcast(kept), F.col("id") == F.col("of")).select("text", "toxic", F.col("sum").alias("weight"))


def _signature(triples: str) -> Column:
    """``MIN_HASHES`` least values, each by another hash, of an array of hashes."""
    odd = np.random.default_rng(1).integers(1 << 63, size=(MIN_HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @F.pandas_udf("binary")
    def run(arrays: pd.Series) -> pd.Series:
        out = []
        for a in arrays:
            h = np.asarray(a, dtype=np.int64).view(np.uint64)
            parts = [((h[k:k + 4096] * odd) >> np.uint64(32)).min(axis=1) for k in range(0, len(h), 4096)]
            out.append(np.min(parts, axis=0).astype(np.uint32).tobytes())
        return pd.Series(out, dtype="object")

    return run(triples)


def _near_copies(rows: list) -> list[tuple[int, float]]:
    """(id, weight) of the first text of each group of near copies, from rows
    in order of label and key."""
    kept = []
    for _, group in groupby(rows, lambda r: (r["toxic"], r["key"])):
        group = list(group)
        signatures = np.array([np.frombuffer(r["signature"], dtype=np.uint32) for r in group])
        first: list[int] = []
        sums: list[float] = []
        for k, r in enumerate(group):
            alike = (signatures[first] == signatures[k]).mean(axis=1) if first else np.zeros(0)
            if len(alike) and alike.max() >= NEAR:
                sums[int(alike.argmax())] += r["weight"]
            else:
                first.append(k)
                sums.append(r["weight"])
        kept += [(group[k]["id"], w) for k, w in zip(first, sums)]
    return kept


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            terms = set()
            for w in set(WORD.findall((text or "").lower())):
                terms.add(w + "$")
                terms.update(w[:n] for n in STEMS if n <= len(w))
            counts[int(toxic)].update(terms)
    rows = [(t, n, counts[0][t]) for t, n in counts[1].items()]
    rows += [(t, 0, n) for t, n in counts[0].items() if t not in counts[1]]
    yield pd.DataFrame(rows, columns=["term", "tox", "clean"])


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms whose share of toxic texts cannot be chance: a log-likelihood
    ratio that pays for the number of terms tried. A stem gives way to one
    continuation that covers nine tenths of its toxic texts; a continuation
    stays only if it is a clearly surer sign than the stem."""
    n1, n0 = (sample.filter(F.col("toxic") == v).count() for v in (1, 0))
    if not n1 or not n0:
        return Lexicon(dict.fromkeys(DEFAULT_LEXICON.split(), 1.0), {})
    terms = sample.mapInPandas(_term_counts, "term string, tox long, clean long").groupBy("term").agg(
        F.sum("tox").alias("tox"), F.sum("clean").alias("clean"))
    rate = n1 / (n1 + n0)
    precision = F.col("tox") / (F.col("tox") + F.col("clean"))
    ratio = F.col("tox") * F.log(precision / rate) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - precision) / (1 - rate))).otherwise(0.0)
    odds = F.log((F.col("tox") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    good = terms.filter((odds >= MIN_ODDS) & (ratio > 1 + math.log((n1 + n0) * TERMS_TRIED))).select(
        "term", "tox", odds.alias("odds"))
    # the bounded sample bounds the terms
    found = {r["term"]: (r["tox"], r["odds"]) for r in good.collect()}
    ordered = sorted(found)

    def longer(term: str) -> Iterator[str]:
        for k in range(bisect_right(ordered, term), len(ordered)):
            if not ordered[k].startswith(term):
                break
            yield ordered[k]

    kept: dict[str, float] = {}
    for term in sorted(found, key=lambda t: (len(t), t)):
        n, odds = found[term]
        stems = [kept[term[:k]] for k in STEMS if k < len(term) and term[:k] in kept]
        covered = any(found[t][0] >= 0.9 * n for t in longer(term))
        if not covered and all(odds > s + 0.5 for s in stems):
            kept[term] = odds
    weight = {t: min(odds / FULL_WEIGHT, 1.5) for t, odds in kept.items()}
    return Lexicon({t[:-1]: w for t, w in weight.items() if t[-1] == "$"},
                   {t: w for t, w in weight.items() if t[-1] != "$"})


def learn_marks(sample: DataFrame, lexicon: Lexicon) -> Lexicon:
    """The lexicon with the negations and targets that stand before its words.
    A word's texts are compared with those that hold insults of the same
    weights, or words of a language with surer insults would pass for targets.
    The test is that of the lexicon, for as many words as there are."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder, counts = lexicon.finder(), {0: Counter(), 1: Counter()}
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                counts[int(toxic)].update(places_before(text, lexicon, finder))
        for toxic, found in counts.items():
            yield pd.DataFrame([(*place, n if toxic else 0, 0 if toxic else n) for place, n in found.items()],
                               columns=["word", "symbol", "weight", "tox", "clean"])

    # the bounded sample bounds the words
    rows = sample.mapInPandas(counted, "word string, symbol string, weight double, tox long, clean long").groupBy(
        "word", "symbol", "weight").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean")).collect()
    share = {r["weight"]: (r["tox"] + 0.5) / (r["tox"] + r["clean"] + 1) for r in rows if r["symbol"] == "I"}
    found: dict[tuple[str, str], np.ndarray] = {}
    for r in rows:
        if r["symbol"] != "I":
            n = r["tox"] + r["clean"]
            found[r["word"], r["symbol"]] = found.get((r["word"], r["symbol"]), 0) + np.array(
                [r["tox"], r["clean"], n * share[r["weight"]]])
    marks: dict[str, str] = {}
    for (word, symbol), (tox, clean, expected) in sorted(found.items()):
        rate = expected / (tox + clean)
        odds = math.log((tox + 0.5) / (clean + 0.5)) - math.log(rate / (1 - rate))
        if gain(tox, clean, rate) > 1 + math.log(len(found)) and (
                odds <= -MARK_ODDS if symbol == "N" else odds >= MARK_ODDS):
            marks[word] = symbol
    return Lexicon(lexicon.words, lexicon.stems, marks)


def gain(tox: float, clean: float, rate: float) -> float:
    """Log-likelihood gain of the counts' own share of toxic texts over ``rate``."""
    n = tox + clean
    return sum(k * math.log(k / n / p) for k, p in ((tox, rate), (clean, 1 - rate)) if k)


def places_before(text: str | None, lexicon: Lexicon, finder: ahocorasick.Automaton) -> list[tuple[str, str, float]]:
    """(word, N or Y, weight) of the words without a symbol that a negation's
    or a target's place before an insult holds, once with the largest weight of
    these insults, and ("", "I", weight) for each weight of an insult."""
    places, weights = {}, set()
    for clause in hit_clauses((text or "").lower(), finder):
        ws, arcs = WORD.findall(clause), lexicon.arcs(clause)
        for i, (symbol, weight) in enumerate(arcs):
            if symbol != "I":
                continue
            weights.add(weight)
            for mark, reach in (("N", REACH_N), ("Y", REACH_Y)):
                for k in range(max(i - reach, 0), i):
                    if arcs[k][0] == "O":
                        places[ws[k], mark] = max(weight, places.get((ws[k], mark), 0.0))
    return [(*place, w) for place, w in places.items()] + [("", "I", w) for w in weights]


def fit(sample: DataFrame, lexicon: Lexicon) -> Model:
    """Weights of the event kinds by ridge logistic regression around the
    prior, from at most 2 * ``TRAIN_DOCS`` rows of event counts."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = lexicon.finder()
        for pdf in batches:
            yield pd.DataFrame({
                "x": [features(text_events(t, lexicon, finder)).tolist() for t in pdf["text"]],
                "toxic": pdf["toxic"], "weight": pdf["weight"]})

    # texts with equal events are one row
    rows = sample.mapInPandas(counted, "x array<double>, toxic int, weight double").groupBy("x", "toxic").agg(
        F.sum("weight").alias("count")).collect()
    if len({r["toxic"] for r in rows}) < 2:
        return Model(lexicon, PRIOR, PRIOR_BIAS)
    x = np.array([[*r["x"], 1.0] for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    n = np.array([r["count"] for r in rows], dtype=float)
    start = np.append(PRIOR, PRIOR_BIAS)
    w = start.copy()
    penalty = np.append(np.full(len(KINDS), L2), L2 / 10)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + penalty * (w - start)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return Model(lexicon, w[:-1], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> Model:
    small_batches(docs.sparkSession)
    sample = training_sample(docs, labels, bound).persist()
    try:
        return fit(sample, learn_marks(sample, learn_lexicon(sample)))
    finally:
        sample.unpersist()


def toxicity(text: Column, model: Model) -> Column:
    """Score of a text column, from 0 to 1."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts), dtype="float64")

    return run(text)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below the threshold."""
    return docs.filter(toxicity(F.col("text"), model) < threshold)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
