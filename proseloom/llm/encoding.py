"""Problem 8: token ids of every text by a public byte-level BPE vocabulary.

Texts are cut into pre-tokens by the vocabulary's published pattern inside the JVM. Each
partition gathers its distinct pre-tokens and encodes those it has not met yet with DuckDB:
a recursive query over token-position rows joins the merge table and contracts each word's
leftmost pair of least rank until no pair is left, and an ordered aggregation reads off the
ids. Ids of texts are then looked up by dictionary code, without a Python loop over tokens.

A null text and an empty text give the empty list; a blank text is encoded like any other.
Strings that spell special tokens are ordinary text. Every row gives one row, repeated rows
too; an empty table gives an empty result. The folder of the vocabulary file is a parameter;
its content (under 2 MB) is read by the driver and broadcast.
"""

from __future__ import annotations

import json
import os
from itertools import groupby

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

FOLDER = "/opt/tokenizers"
NAME = "byte_bpe_50k"
MAX_FILE_BYTES = 8_000_000
LONG = 64            # bytes from which a pre-token is contracted in a loop over a table, all places of a pair at once
ONCE = 150_000       # bytes of pre-tokens in one recursive query, whose steps all stay in memory
TOKENS_ONCE = 1_000_000  # pre-tokens of the texts taken from a batch at a time
CACHE = 300_000      # pre-tokens whose ids one worker remembers

# The published pre-token pattern of this vocabulary, in Java's syntax.
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable bytes for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def load(folder: str = FOLDER, name: str = NAME) -> bytes:
    path = os.path.join(folder, f"{name}.json")
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError("the vocabulary is too large to broadcast")
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """Ids of pre-tokens by recursive queries; one per Python worker."""

    def __init__(self, content: bytes):
        model = json.loads(content)["model"]
        vocab = model["vocab"]
        letters = byte_letters()
        self.base = np.array([vocab[c] for c in letters], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        back = {c: b for b, c in enumerate(letters)}
        self.bytes = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        merges = pa.table({  # noqa: F841 - DuckDB reads it by name
            "l": pa.array([vocab[a] for a, _ in pairs], pa.int32()), "r": pa.array([vocab[b] for _, b in pairs], pa.int32()),
            "rank": pa.array(range(len(pairs)), pa.int32()), "m": pa.array([vocab[a + b] for a, b in pairs], pa.int32())})
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "preserve_insertion_order": False, "temp_directory": ""})  # nothing is spilled to a local disk
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.known: dict[str, np.ndarray] = {}

    def _rows(self, words: list[bytes]):
        n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        w = np.repeat(np.arange(len(words), dtype=np.int32), n)
        pos = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        tok = self.base[np.frombuffer(b"".join(words), dtype=np.uint8)]
        return pa.table({"w": w, "pos": pos, "tok": tok})

    def _short(self, words: list[bytes]) -> list[np.ndarray]:
        start = self._rows(words)  # noqa: F841
        got = self.con.sql("""
WITH RECURSIVE s AS (
  SELECT 0 AS step, w, pos, tok FROM start
  UNION ALL
  SELECT step + 1, w, pos, CASE WHEN pos = spot THEN m ELSE tok END
  FROM (
    SELECT *, lag(pos) OVER (PARTITION BY w ORDER BY pos) AS before
    FROM (
      SELECT step, w, pos, tok, first_value(pos) OVER best AS spot, first_value(rank) OVER best AS least, first_value(m) OVER best AS m
      FROM (SELECT step, w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM s) p
      LEFT JOIN merges ON p.tok = merges.l AND p.nxt = merges.r
      WINDOW best AS (PARTITION BY w ORDER BY rank NULLS LAST, pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    ) WHERE least IS NOT NULL
  ) WHERE before IS DISTINCT FROM spot
), last AS (SELECT w, max(step) AS step FROM s GROUP BY w)
SELECT w, list(tok ORDER BY pos) AS ids FROM s JOIN last USING (w, step) GROUP BY w ORDER BY w""").to_arrow_table()
        ids = got["ids"].combine_chunks()
        off = np.asarray(ids.offsets)
        flat = np.asarray(ids.values)
        return [flat[off[i]:off[i + 1]] for i in range(len(ids))]

    def _long(self, word: bytes) -> np.ndarray:
        """One long pre-token: per round, every place of the pair of least rank, taken from the left without overlap."""
        start = self._rows([word])  # noqa: F841
        self.con.execute("CREATE OR REPLACE TEMP TABLE t AS SELECT pos, tok FROM start")
        while True:
            self.con.execute("""
CREATE OR REPLACE TEMP TABLE c AS
WITH p AS (SELECT pos, tok, lead(tok) OVER (ORDER BY pos) AS nxt, lead(pos) OVER (ORDER BY pos) AS nxt_pos, row_number() OVER (ORDER BY pos) AS k FROM t),
     q AS (SELECT p.*, rank, m FROM p JOIN merges ON p.tok = l AND p.nxt = r),
     b AS (SELECT *, k - row_number() OVER (ORDER BY pos) AS run FROM q WHERE rank = (SELECT min(rank) FROM q))
SELECT pos, nxt_pos, m FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY pos) AS i FROM b) WHERE i % 2 = 1""")
            if not self.con.execute("SELECT count(*) FROM c").fetchone()[0]:
                break
            self.con.execute("""
CREATE OR REPLACE TEMP TABLE t AS
SELECT t.pos, coalesce(c.m, t.tok) AS tok FROM t LEFT JOIN c USING (pos) WHERE t.pos NOT IN (SELECT nxt_pos FROM c)""")
        return np.array([x for (x,) in self.con.execute("SELECT tok FROM t ORDER BY pos").fetchall()], dtype=np.int32)

    def ids_of(self, tokens: list[str]) -> list[np.ndarray]:
        new = [t for t in tokens if t not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known = {t: self.known[t] for t in tokens if t in self.known}
        raw = [t.encode() for t in new]
        short = [i for i, b in enumerate(raw) if len(b) < LONG]
        part = np.cumsum([len(raw[i]) for i in short]) // ONCE if short else []
        for _, own in groupby(zip(part, short), key=lambda x: x[0]):
            some = [i for _, i in own]
            for i, ids in zip(some, self._short([raw[i] for i in some])):
                self.known[new[i]] = ids
        for i, b in enumerate(raw):
            if len(b) >= LONG:
                self.known[new[i]] = self._long(b)
        return [self.known[t] for t in tokens]

    def decode(self, ids: pa.ListArray) -> list[str]:
        """Texts of lists of ids: the vocabulary joined by id, bytes put together by an ordered aggregation."""
        flat = ids.flatten()
        doc = np.repeat(np.arange(len(ids)), np.asarray(ids.value_lengths().fill_null(0)))
        rows = pa.table({"doc": doc, "pos": np.arange(len(flat)), "id": flat})  # noqa: F841
        if not self.con.execute("SELECT count(*) FROM duckdb_tables() WHERE table_name = 'vocab'").fetchone()[0]:
            letters = pa.table({"id": pa.array(list(self.bytes), pa.int32()), "hex": [b.hex() for b in self.bytes.values()]})  # noqa: F841
            self.con.execute("CREATE TABLE vocab AS SELECT * FROM letters")
        got = dict(self.con.execute("SELECT doc, string_agg(hex, '' ORDER BY pos) FROM rows JOIN vocab USING (id) GROUP BY doc").fetchall())
        return [bytes.fromhex(got.get(i, "")).decode("utf-8", "replace") for i in range(len(ids))]


_encoders: dict[int, Encoder] = {}


def _encoder(content: bytes) -> Encoder:
    key = hash(content)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(content)
    return _encoders[key]


def encode_lists(enc: Encoder, tokens: pa.ListArray) -> pa.ListArray:
    """Lists of pre-tokens to lists of ids."""
    flat = tokens.flatten().dictionary_encode()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    off = np.asarray(tokens.offsets).astype(np.int64)
    off = off - off[0]
    if not len(flat):
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(tokens) + 1, dtype=np.int32)), pa.array([], pa.int32()))
    each = enc.ids_of(flat.dictionary.to_pylist())
    n = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
    begin = np.cumsum(n) - n
    table = np.concatenate(each).astype(np.int32)
    codes = np.asarray(flat.indices)
    k = n[codes]
    ends = np.concatenate([[0], np.cumsum(k)])
    at = np.repeat(begin[codes] - ends[:-1], k) + np.arange(ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends[off].astype(np.int32)), pa.array(table[at]))


def _parts(batches):
    """Batches cut into slices of about TOKENS_ONCE pre-tokens; single texts stay whole."""
    for b in batches:
        part = np.cumsum(np.asarray(b.column(1).value_lengths())) // TOKENS_ONCE
        at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
        for i, j in zip(at, at[1:]):
            if j > i:
                yield b.slice(i, j - i)


def encode(docs: DataFrame, folder: str = FOLDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every row."""
    content = docs.sparkSession.sparkContext.broadcast(load(folder))

    def run(batches):
        enc = _encoder(content.value)
        for b in _parts(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), encode_lists(enc, b.column(1))], names=["doc_id", "ids"])

    tokens = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(PATTERN), F.lit(0))
    return docs.select(F.col(id_col).alias("doc_id"), tokens.alias("t")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, folder: str = FOLDER) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    content = encoded.sparkSession.sparkContext.broadcast(load(folder))

    def run(batches):
        enc = _encoder(content.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(enc.decode(b.column(1)))], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
