"""Problem 6: cutting oversized texts at natural boundaries.

Dynamic programming over boundary positions. A piece ends at a paragraph (blank line) where
its reach holds one, else at a sentence that ends its line, else at a sentence, else at
another line end, else at a word, else anywhere; its reach is all of the ``limit`` characters
from its start behind the previous end. Among all chains of such pieces the one with the
least sum of cut penalties and squared size imbalance is taken, so a chain that finds
paragraphs later on is worth an uneven piece before. A piece starts up to ``overlap``
characters before the previous end, at a word where there is one, and shares at least one
character with it. Joined without the shared parts the pieces give the text back.

Texts above SPAN characters are first cut into spans of at most that, at the last paragraph,
else sentence, line or word of a span; spans are cut as texts of their own, one task each.

Texts up to ``limit`` give no pieces, null texts neither; characters are Unicode code
points; rows delivered again give the same pieces once.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

LIMIT, MAX_OVERLAP, OVERLAP = 4_000, 200, 120
SPAN = 400_000  # characters of a text that one step cuts

_KINDS = (
    (re.compile(r"\n[ \t\r]*\n\s*"), 0.0),
    (re.compile(r"[.!?…][\"'”’»)]*[ \t\r]*\n+"), 0.15),
    (re.compile(r"[.!?…][\"'”’»)]*\s+"), 0.3),
    (re.compile(r"\n+"), 0.45),
    (re.compile(r"\s+"), 0.6),
)


def cut_points(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions after a natural boundary, and the best kind of each (0 paragraph ... 4 word)."""
    kind: dict[int, int] = {}
    for k, (pattern, _) in enumerate(_KINDS):
        for m in pattern.finditer(text):
            kind.setdefault(m.end(), k)
    kind.pop(len(text), None)
    at = np.array(sorted(kind), dtype=np.int64)
    return at, np.array([kind[p] for p in at.tolist()], dtype=np.int8)


def _starts(text: str, words: np.ndarray, ends: np.ndarray, overlap: int) -> np.ndarray:
    """Where the piece after each end begins: the first word start in the overlap window, else its left edge."""
    left = np.maximum(ends - overlap, 1)
    i = np.searchsorted(words, left)
    ok = (i < len(words))
    first = np.where(ok, words[np.minimum(i, max(len(words) - 1, 0))] if len(words) else left, ends)
    return np.where(first < ends, first, np.maximum(ends - overlap, 1))


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP, head: int = 0) -> list[tuple[int, int]]:
    """(start, end) of each piece, in order. The first ``head`` characters are the overlap with what comes before: no piece ends in them."""
    n = len(text)
    if n <= limit:
        return [(0, n)]
    at, kinds = cut_points(text)
    penalties = np.array([p for _, p in _KINDS])
    least = -(-(n - overlap) // (limit - overlap))
    target = min(limit, (n + (least - 1) * overlap) / least)
    # states are ends of pieces; a state's cost is that of the best chain of pieces up to it
    cost: dict[int, float] = {head: 0.0}
    back: dict[int, int] = {}
    begin = {head: 0}
    queue, seen = [head], {head}
    while queue:
        e = heapq.heappop(queue)
        s = begin[e]
        hi = s + limit
        if hi >= n:
            c = cost[e] + ((n - s - target) / target) ** 2
            if c < cost.get(n, float("inf")):
                cost[n], back[n] = c, e
            continue
        a, b = np.searchsorted(at, e, "right"), np.searchsorted(at, hi, "right")
        if a < b:
            best = kinds[a:b].min()
            ends = at[a:b][kinds[a:b] == best]
            penalty = penalties[best]
        else:
            ends, penalty = np.array([hi]), 1.0
        starts = _starts(text, at, ends, overlap)
        new = cost[e] + penalty + ((ends - s - target) / target) ** 2
        for x, st, c in zip(ends.tolist(), starts.tolist(), new.tolist()):
            if c < cost.get(x, float("inf")):
                cost[x], back[x], begin[x] = c, e, st
            if x not in seen:
                seen.add(x)
                heapq.heappush(queue, x)
    chain, e = [], n
    while e != head:
        chain.append((begin[back[e]], e))
        e = back[e]
    return chain[::-1]


def spans(text: str, size: int = SPAN, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, head, end) of the spans of a text: each begins ``overlap`` characters early, where the first ``head`` ones belong to the span before."""
    out, at = [], 0
    while len(text) - at > size:
        window = text[at:at + size]
        points, kinds = cut_points(window)
        late = points > size // 2
        end = at + (int(points[late & (kinds == kinds[late].min())][-1]) if late.any() else size)
        start = max(0, at - overlap)
        out.append((start, at - start, end))
        at = end
    start = max(0, at - overlap)
    out.append((start, at - start, len(text)))
    return out


SCHEMA = "chunk_id long, piece_no int, n_pieces int, start_char int, end_char int, piece string"


def _cut(limit: int, overlap: int):
    """Pieces of rows (chunk_id, start, head, text), numbered within each row."""
    def run(batches):
        for b in batches:
            out = [[] for _ in range(6)]
            for cid, start, head, text in zip(*(b.column(c).to_pylist() for c in ("chunk_id", "start", "head", "text"))):
                parts = cuts(text, limit, overlap, head)
                for k, (s, e) in enumerate(parts):
                    for col, v in zip(out, (cid, k + 1, len(parts), start + s, start + e, text[s:e])):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()))],
                names=["chunk_id", "piece_no", "n_pieces", "start_char", "end_char", "piece"])
    return run


def _to_spans(size: int, overlap: int):
    def run(batches):
        for b in batches:
            for cid, text in zip(b.column("chunk_id").to_pylist(), b.column("text").to_pylist()):
                for start, head, end in spans(text, size, overlap):
                    yield pa.RecordBatch.from_pydict({"chunk_id": [cid], "start": [start], "head": [head], "text": [text[start:end]]}, schema=pa.schema(
                        [("chunk_id", pa.int64()), ("start", pa.int32()), ("head", pa.int32()), ("text", pa.string())]))
    return run


def split_texts(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, span: int = SPAN) -> DataFrame:
    """Pieces of every text longer than ``limit``: chunk_id, piece_no from 1, n_pieces, [start_char, end_char), piece."""
    if not 1 <= overlap <= MAX_OVERLAP or overlap * 2 >= limit or span < 2 * limit:
        raise ValueError("overlap must be 1..200 and below half the limit, a span at least two limits long")
    big = chunks.where(F.length("text") > limit).select("chunk_id", "text")
    # long texts are few and may sit in one file split: spread them before the costly step, one row per id
    big = big.groupBy("chunk_id").agg(F.any_value("text").alias("text"))
    whole = big.where(F.length("text") <= span).select("chunk_id", F.lit(0).alias("start"), F.lit(0).alias("head"), "text").mapInArrow(_cut(limit, overlap), SCHEMA)
    parts = big.where(F.length("text") > span).mapInArrow(_to_spans(span, overlap), "chunk_id long, start int, head int, text string").repartition("chunk_id", "start")
    cut = parts.mapInArrow(_cut(limit, overlap), SCHEMA)
    of = W.partitionBy("chunk_id")  # the pieces of one text
    cut = cut.withColumn("piece_no", F.row_number().over(of.orderBy("end_char"))).withColumn("n_pieces", F.count("*").over(of).cast("int"))
    return whole.unionByName(cut)
