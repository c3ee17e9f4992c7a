"""Operator 6, quality rules: a short-circuit cascade.

Each rule is a boolean column that is true where the rule rejects a row.
``plan_cascade`` times every rule on a sample of bounded size, counts what it
rejects there, and orders the rules by rejections per second. ``verdict``
turns the order into one CASE expression, which Spark evaluates branch by
branch, so that a costly rule runs only on rows that the cheaper ones let
through. The order never changes which rows are kept.

Null and empty texts have no words and fail ``short``. Repeated rows are
judged one by one. An empty table gives an empty result and the given order.
Built-in expressions only.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import let, table, words

#: Rows on which cost and selectivity are estimated.
SAMPLE_ROWS = 1000
#: Timed runs of each rule, and the least cost of one.
RUNS, LEAST_SECONDS = 2, 1e-3
SAMPLE_SEED = 17

SYMBOLS = "#*$%&|<>"  # fixed by the data contract
MIN_WORDS = 50  # fixed by the data contract
MAX_REPEAT_PERCENT = 50  # fixed by the data contract
MAX_SYMBOLS_PERCENT = 10
MAX_DUP_LINES_PERCENT = 40
MAX_EXCLAMATIONS_PERCENT = 30
MAX_UPPER_PERCENT = 60
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 12


def repeat_words(ws: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more.

    Windows are sorted by hash, so equal ones meet, and neighbours with one
    hash are compared word by word; the covered words follow from the gaps
    between the positions of repeated windows."""
    none = F.lit(0).cast("long")

    def hits(w: Column, s: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            at = [F.get(w, x["p"] + k) == F.get(w, y["p"] + k) for k in range(3)]
            return (x["h"] == y["h"]) & at[0] & at[1] & at[2]

        found = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
        return F.array_sort(F.transform(found, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        last = F.lit(3)
        gaps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, last), last))
        return F.aggregate(gaps, none, lambda s, g: s + g)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))

    return let(ws, lambda w: F.when(F.size(w) < 4, none).otherwise(
        let(F.sort_array(windows(w)), lambda s: let(hits(w, s), covered))))


def dup_lines(text: Column) -> Column:
    """(lines with a word, those of them that equal an earlier line)."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    return let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dups")))


def removed(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def word_chars(text: Column) -> Column:
    """Characters of a text that are in words."""
    return F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def text_rules(text: str = "text", ws: Column | None = None) -> list[Rule]:
    """The rules of this library on a text column; ``ws`` are its words if
    they are at hand. Thresholds compare whole numbers, so SQL engines agree
    on them."""
    t = F.coalesce(F.col(text), F.lit(""))
    ws = words(t) if ws is None else ws
    n, chars = F.size(ws).cast("long"), word_chars(t)
    upper = F.length(F.regexp_replace(t, r"[^\p{Lu}]", ""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    return [
        Rule("short", n < MIN_WORDS),
        Rule("symbols", removed(t, SYMBOLS) * 100 > n * MAX_SYMBOLS_PERCENT),
        Rule("exclamations", removed(t, "!") * 100 > n * MAX_EXCLAMATIONS_PERCENT),
        Rule("capitals", upper * 100 > letters * MAX_UPPER_PERCENT),
        Rule("word_length", (chars < n * MIN_WORD_CHARS) | (chars > n * MAX_WORD_CHARS)),
        Rule("dup_lines", let(dup_lines(t), lambda x: x["dups"] * 100 > x["lines"] * MAX_DUP_LINES_PERCENT)),
        Rule("repeats", repeat_words(ws) * 100 > n * MAX_REPEAT_PERCENT),
    ]


def plan_cascade(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in order of rejections per second on a sample. Rows are
    drawn with a share that gives about twice the sample, whatever the number
    of partitions, and cut to ``sample_rows``. A rule's cost is the time of its
    count over the sample without that of a count that tests nothing, the
    least of ``RUNS`` runs each."""
    n = docs.count()
    if not n:
        return list(rules)
    sample = docs.sample(min(1.0, 2 * sample_rows / n), SAMPLE_SEED).limit(sample_rows).persist()
    try:
        sample.count()

        def timed(rejects: Column) -> tuple[float, int]:
            runs = []
            for _ in range(RUNS):
                began = time.perf_counter()
                rejected = sample.filter(rejects).count()
                runs.append(time.perf_counter() - began)
            return min(runs), rejected

        idle, _ = timed(F.rand(SAMPLE_SEED) < 0)
        rated = [(timed(r.rejects), i) for i, r in enumerate(rules)]
        return [rules[i] for _, i in sorted(
            (-(rejected + 1e-3) / max(cost - idle, LEAST_SECONDS), i) for (cost, rejected), i in rated)]
    finally:
        sample.unpersist()


def verdict(rules: list[Rule]) -> Column:
    """Name of the first rule in the given order that rejects; null if none."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.rejects, F.lit(rule.name)).otherwise(out)
    return out


def filter_quality(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with all their columns. The
    words are split once for all rules."""
    place = {r.name: i for i, r in enumerate(plan_cascade(docs, text_rules(text), sample_rows))}
    return docs.filter(let(words(F.col(text)), lambda ws: verdict(
        sorted(text_rules(text, ws), key=lambda r: place[r.name]))).isNull())


def quality_report(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts and verdict of every row: doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept. The counts
    feed the rules that need them; the others run only on rows that passed
    so far."""
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = dup_lines(t)
    counts = let(words(t), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), word_chars(t).alias("word_chars"),
        removed(t, SYMBOLS).alias("n_symbols"), lines.alias("lines"), repeat_words(ws).alias("n_repeat_words")))
    counted = docs.select("doc_id", "text", counts.alias("c"))
    n = F.col("c.n_words")
    from_counts = {"short": n < MIN_WORDS,
                   "symbols": F.col("c.n_symbols") * 100 > n * MAX_SYMBOLS_PERCENT,
                   "word_length": (F.col("c.word_chars") < n * MIN_WORD_CHARS)
                   | (F.col("c.word_chars") > n * MAX_WORD_CHARS),
                   "dup_lines": F.col("c.lines.dups") * 100 > F.col("c.lines.lines") * MAX_DUP_LINES_PERCENT,
                   "repeats": F.col("c.n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT}
    order = plan_cascade(docs, text_rules(), sample_rows)
    rules = [Rule(r.name, from_counts.get(r.name, r.rejects)) for r in order]
    return counted.select(
        "doc_id", "c.n_words", "c.word_chars", "c.n_symbols", F.col("c.lines.dups").alias("n_dup_lines"),
        "c.n_repeat_words", (from_counts["short"] | from_counts["repeats"]).alias("base_failed"),
        verdict(rules).isNull().alias("kept"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln
  FROM documents),
g AS (SELECT row_number() OVER () AS rid, * FROM w),
win AS (SELECT rid, i, ws[i] AS a, ws[i+1] AS b, ws[i+2] AS c
        FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM g)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM win)
        WHERE k > 1),
cov AS (SELECT rid, count(DISTINCT j) AS n
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM hit) GROUP BY rid),
base AS (
  SELECT doc_id, t, ln, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM g LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR n_symbols * 100 > n_words * 10
            OR length(regexp_replace(t, '[^!]', '', 'g')) * 100 > n_words * 30
            OR length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) * 100
               > length(regexp_replace(t, '[^\p{L}]', '', 'g')) * 60
            OR word_chars < n_words * 2 OR word_chars > n_words * 12
            OR n_dup_lines * 100 > len(ln) * 40) AS kept
FROM f
"""
