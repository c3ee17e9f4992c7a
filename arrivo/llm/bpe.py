"""Operator 1, byte-level BPE encoding and decoding in DuckDB, per partition.

Each Spark task opens an in-memory DuckDB with two tables made from the rank
file: ``merges`` (pair of ids -> id of the joined token, which is its rank)
and ``vocab`` (id -> bytes). Texts are cut into pieces by the tokenizer's
pattern. Pieces that are tokens are done; others of ``SPLIT_PIECE`` bytes and
more are cut wherever no token of the vocabulary matches across (no
contraction ever joins the two sides, so each part can be contracted by
itself); pieces and parts become token-position rows, and one recursive query joins them with ``merges``,
contracts the leftmost pair of least rank of each, and repeats until none has
a pair left. Decoding joins the ids with ``vocab`` and concatenates
the bytes of a document by an ordered aggregate.

Equal pieces and equal parts of a task are encoded once. The pattern never
matches across white space that precedes a piece, so texts are first cut at
white space and equal cuts are matched once. What a task remembers is bounded
by ``CACHE_ROWS`` (it forgets and starts anew, results stay the same), the
rows of one query by ``PIECE_ROWS`` and ``TOKEN_BLOCK`` or one text; texts are
whole, whatever their length. Of parts of ``LONG_PIECE`` bytes and more all
occurrences of the least pair are contracted in a step, many parts in a query.

Letters and numbers are those of the Unicode version that the public
tokenizer library knows; ``regex`` knows newer ones, see ``LATER``.

Null and empty texts have no tokens. Repeated rows give equal rows; an empty
table gives no rows. Extra columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import load_ranks, small_batches, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Distinct cuts that a task remembers, rows that one recursive query may keep,
#: and characters in one decoding query.
CACHE_ROWS, PIECE_ROWS, TOKEN_BLOCK = 250_000, 3_000_000, 400_000
#: Bytes from which a piece is cut into parts and from which a part is long,
#: and rows that the steps of one query on long parts may keep.
SPLIT_PIECE, LONG_PIECE, LONG_ROWS = 32, 128, 1_000_000
MEMORY = "700MB"

#: White space of the pattern, fixed by Unicode.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")

#: Letters and numbers that Unicode got after the version that the
#: tokenizer library's classes follow; to it they are neither.
LATER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f"
    "\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)

ENCODE = """
WITH RECURSIVE state(piece, pos, id, next, step) AS (
  SELECT piece, pos, id, next, 0 FROM positions
  UNION ALL
  (WITH least AS (
     SELECT s.piece, min((m.rank << 32) | s.pos) AS best
     FROM state s JOIN merges m ON m.pair = (s.id::BIGINT << 32) | s.next
     GROUP BY s.piece),
   joined AS (
     SELECT l.piece, (l.best & 4294967295)::INTEGER AS at, (l.best >> 32)::INTEGER AS id, s.next AS after
     FROM least l JOIN state s ON s.piece = l.piece AND s.pos = (l.best & 4294967295) + 1)
   SELECT s.piece,
          CASE WHEN s.pos > j.at THEN s.pos - 1 ELSE s.pos END,
          CASE WHEN s.pos = j.at THEN j.id ELSE s.id END,
          CASE WHEN s.pos = j.at THEN j.after WHEN s.pos = j.at - 1 THEN j.id ELSE s.next END,
          s.step + 1
   FROM state s JOIN joined j ON s.piece = j.piece
   WHERE s.pos <> j.at + 1))
SELECT s.piece, s.id
FROM state s JOIN (SELECT piece, max(step) AS step FROM state GROUP BY piece) f
  ON s.piece = f.piece AND s.step = f.step
ORDER BY s.piece, s.pos
"""

# For long parts: every occurrence of the least pair is contracted in one
# step, from the left, up to the first whose joined token makes a pair with a
# neighbour that ranks before it, as that pair is next. Only tokens that are
# not ``safe`` have such pairs at all.
ENCODE_LONG = """
WITH RECURSIVE state(piece, pos, id, step) AS (
  SELECT piece, pos, id, 0 FROM positions
  UNION ALL
  (WITH pairs AS (
     SELECT piece, pos, id, step, lag(id) OVER w AS before, lead(id) OVER w AS next, lead(id, 2) OVER w AS after
     FROM state WHERE step < {steps} WINDOW w AS (PARTITION BY piece ORDER BY pos)),
   ranked AS (
     SELECT p.*, m.rank, m.safe, min(m.rank) OVER (PARTITION BY piece) AS least
     FROM pairs p LEFT JOIN merges m ON m.pair = (p.id::BIGINT << 32) | p.next),
   hits AS (
     SELECT *, coalesce(rank = least, false) AS hit,
            pos - row_number() OVER (PARTITION BY piece, coalesce(rank = least, false) ORDER BY pos) AS run
     FROM ranked WHERE least IS NOT NULL),
   chosen AS (
     SELECT *, hit AND row_number() OVER (PARTITION BY piece, hit, run ORDER BY pos) % 2 = 1 AS odd FROM hits),
   beside AS (
     SELECT *, odd AND NOT safe AS open,
            CASE WHEN lag(odd, 2, false) OVER (PARTITION BY piece ORDER BY pos) THEN least ELSE before END AS left_id
     FROM chosen),
   checked AS (
     SELECT b.*, coalesce(l.rank < least, false) OR coalesce(r.rank < least, false) AS stops
     FROM beside b
     LEFT JOIN merges l ON l.pair = CASE WHEN open THEN (left_id::BIGINT << 32) | least END
     LEFT JOIN merges r ON r.pair = CASE WHEN open THEN (least::BIGINT << 32) | after END),
   limited AS (
     SELECT *, odd AND NOT coalesce(bool_or(stops) OVER (PARTITION BY piece ORDER BY pos
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS joins
     FROM checked),
   taken AS (
     SELECT *, coalesce(lag(joins) OVER (PARTITION BY piece ORDER BY pos), false) AS gone FROM limited)
   SELECT piece, (row_number() OVER (PARTITION BY piece ORDER BY pos) - 1)::INTEGER,
          CASE WHEN joins THEN least::INTEGER ELSE id END, step + 1
   FROM taken WHERE NOT gone))
SELECT s.piece, s.id, s.step = {steps} AS more
FROM state s JOIN (SELECT piece, max(step) AS step FROM state GROUP BY piece) f
  ON s.piece = f.piece AND s.step = f.step
ORDER BY s.piece, s.pos
"""

#: {0} is what to make of a document's bytes.
DECODE = """
SELECT doc, {0}(unhex(array_to_string(list(v.hex ORDER BY t.pos), '')))
FROM tokens t JOIN vocab v ON v.id = t.id
GROUP BY doc
"""


def finder(pattern: str) -> Callable[[str], list[str]]:
    """Finds the matches of the pattern with the library's letters and
    numbers. Texts without later ones take the faster plain classes."""
    exact = pattern
    for kind in (r"\p{L}", r"\p{N}"):
        exact = exact.replace(kind, f"[{kind}--[{LATER}]]")
    plain, exact = regex.compile(pattern).findall, regex.compile(exact, regex.V1).findall
    later = re.compile(f"[{LATER}]").search
    return lambda text: plain(text) if text.isascii() or not later(text) else exact(text)


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, finder(pattern)
        self.singles = np.arange(max(ranks.values()) + 1, dtype=np.int32)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        early = {part for p, r in pairs for part in (p >> 32, p & 0xFFFFFFFF) if r < part}
        self._table("merges", {"pair": np.array([p for p, _ in pairs], np.int64),
                               "rank": np.array([r for _, r in pairs], np.int64),
                               "safe": np.array([r not in early for _, r in pairs])})
        self._table("vocab", {"id": np.array(list(ranks.values()), np.int32),
                              "hex": pa.array([t.hex() for t in ranks])})
        self.forget()

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def forget(self) -> None:
        self.cuts, self.known = _Numbers(), 0
        self.pieces: dict[str, np.ndarray] = {}
        self.parts = {bytes([b]): self.byte_ids[b:b + 1] for b in range(256)}
        # ids of all known cuts end to end, and where each cut's begin
        self.ids, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    @cached_property
    def prefixes(self) -> frozenset[bytes]:
        return frozenset(t[:i] for t in self.ranks for i in range(1, len(t) + 1))

    def split(self, raw: bytes) -> list[bytes]:
        """The piece cut wherever no token matches across."""
        parts, start, reach, ranks, prefixes = [], 0, 1, self.ranks, self.prefixes
        for i in range(len(raw)):
            # reach: where the furthest token that starts before i ends
            if reach == i:
                parts.append(raw[start:i])
                start, reach = i, i + 1
            end = reach + 1
            while end <= len(raw) and raw[i:end] in prefixes:
                if raw[i:end] in ranks:
                    reach = end
                end += 1
        parts.append(raw[start:])
        return parts

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of short pieces and parts, by the recursive query."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(size)
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        following = np.append(ids[1:], -1)
        following[ends - 1] = -1
        self.db.register("positions", pa.table({
            "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), size),
            "pos": (np.arange(len(ids)) - np.repeat(ends - size, size)).astype(np.int32),
            "id": ids, "next": following.astype(np.int32)}))
        out = self.db.sql(ENCODE).to_arrow_table()
        self.db.unregister("positions")
        merged = out["id"].to_numpy()
        stops = np.cumsum(np.bincount(out["piece"].to_numpy(), minlength=len(pieces))).tolist()
        return [merged[i:j] for i, j in zip([0, *stops], stops)]

    def merge_long(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of long parts, some steps at a time, so that the rows that a
        recursive query keeps stay bounded."""
        ids = [self.byte_ids[np.frombuffer(p, np.uint8)] for p in parts]
        live = list(range(len(parts)))
        while live:
            size = np.array([len(ids[i]) for i in live])
            self.db.register("positions", pa.table({
                "piece": np.repeat(np.arange(len(live), dtype=np.int32), size),
                "pos": (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32),
                "id": np.concatenate([ids[i] for i in live])}))
            out = self.db.sql(ENCODE_LONG.format(steps=max(1, LONG_ROWS // int(size.sum())))).to_arrow_table()
            self.db.unregister("positions")
            piece, merged, more = (out[c].to_numpy() for c in ("piece", "id", "more"))
            stops = np.cumsum(np.bincount(piece, minlength=len(live)))
            for i, got in zip(live, np.split(merged, stops[:-1])):
                ids[i] = got
            live = [i for i, stop in zip(live, stops) if more[stop - 1]]
        return ids

    def learn(self) -> None:
        """Encode the cuts that were first seen since the last call."""
        fresh = [c for c, n in zip(reversed(self.cuts), range(len(self.cuts) - self.known))][::-1]
        if not fresh:
            return
        split = [self.find(c) for c in fresh]
        todo = {p: p.encode() for ps in split for p in ps if p not in self.pieces}
        cut, uncut = {}, {}
        for p, raw in todo.items():
            whole = self.ranks.get(raw)
            if whole is not None:
                self.pieces[p] = self.singles[whole:whole + 1]
            elif len(raw) < SPLIT_PIECE:
                uncut[p] = raw
            else:
                cut[p] = self.split(raw)
        parts = dict.fromkeys(s for ss in cut.values() for s in ss if s not in self.parts)
        # n bytes take at most n steps of at most n rows
        for block in _blocks(uncut, PIECE_ROWS, lambda p: len(uncut[p]) ** 2):
            self.pieces.update(zip(block, self.merge([uncut[p] for p in block])))
        for block in _blocks((s for s in parts if len(s) < LONG_PIECE), PIECE_ROWS, lambda s: len(s) ** 2):
            self.parts.update(zip(block, self.merge(block)))
        for block in _blocks((s for s in parts if len(s) >= LONG_PIECE), LONG_ROWS // LONG_PIECE):
            self.parts.update(zip(block, self.merge_long(block)))
        for p, ss in cut.items():
            self.pieces[p] = np.concatenate([self.parts[s] for s in ss])
        ids = [np.concatenate([self.pieces[p] for p in ps]) if len(ps) != 1 else self.pieces[ps[0]] for ps in split]
        self.ids = np.concatenate([self.ids, *ids])
        ends = self.starts[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.starts = np.concatenate([self.starts, ends])
        self.known = len(self.cuts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if self.known > CACHE_ROWS:
            self.forget()
        number = self.cuts.__getitem__
        numbered = [np.fromiter(map(number, CUT.findall(t)), np.int64) for t in texts]
        self.learn()
        out = []
        for cuts in numbered:
            first = self.starts[cuts]
            size = self.starts[cuts + 1] - first
            total = int(size.sum())
            at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(total)
            out.append(self.ids[at])
        return out

    def _tokens(self, ids: list[np.ndarray]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        self.db.register("tokens", pa.table({
            "doc": np.repeat(np.arange(len(ids), dtype=np.int32), size),
            "pos": np.arange(len(flat), dtype=np.int64), "id": flat.astype(np.int32)}))

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids."""
        self._tokens(ids)
        got = dict(self.db.execute(DECODE.format("")).fetchall())
        return [got.get(i, b"") for i in range(len(ids))]

    def decoded_digests(self, ids: list[np.ndarray]) -> list[str]:
        """SHA-256 of the decoded bytes of each list of ids."""
        self._tokens(ids)
        got = dict(self.db.execute(DECODE.format("sha256")).fetchall())
        none = hashlib.sha256(b"").hexdigest()
        return [got.get(i, none) for i in range(len(ids))]


def _blocks(texts: Iterable, most: int, size: Callable = len) -> Iterator[list]:
    """Runs of texts whose sizes sum to about ``most``."""
    block, total = [], 0
    for t in texts:
        block.append(t)
        total += size(t)
        if total >= most:
            yield block
            block, total = [], 0
    if block:
        yield block


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN,
                     text: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(load_ranks(ranks_path), pattern)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            ids = [i for block in _blocks(texts, TOKEN_BLOCK) for i in codec.encode(block)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids})

    return _with_id(docs, text).mapInPandas(run, "doc_id string, ids array<int>").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, bytes: what the ids of every row stand for."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(load_ranks(ranks_path), pattern)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "bytes": codec.decode(
                [np.empty(0, np.int32) if i is None else np.asarray(i, np.int32) for i in pdf["ids"]])})

    return encoded.select(F.col("doc_id").cast("string").alias("doc_id"), "ids").mapInPandas(
        run, "doc_id string, bytes binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def _with_id(docs: DataFrame, text: str) -> DataFrame:
    # ids as text: pandas would turn a column of longs with nulls into floats
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text"))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN,
               text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit numbers),
    decoded_sha256 (bytes that the ids decode to) of every text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(load_ranks(ranks_path), pattern)
        for pdf in batches:
            texts, at = [t or "" for t in pdf["text"]], 0
            for block in _blocks(texts, TOKEN_BLOCK):
                ids = codec.encode(block)
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[at:at + len(block)].to_numpy(),
                    "n_tokens": [len(i) for i in ids],
                    "ids_sha256": [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                    "decoded_sha256": codec.decoded_digests(ids)})
                at += len(block)

    return _with_id(docs, text).mapInPandas(
        run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))
