"""Problem 9: evaluation texts inside training texts.

Texts are reduced to their letters and digits (character escapes resolved, NFKC, lower case,
nothing else), so that spacing, punctuation and broken lines cannot hide a passage. A BM25
inverted index over letter grams of the evaluation items is queried with every passage of
every document. Retrieval skips by upper bounds as block-max WAND does, for all passages of a
batch at once: passages whose grams' greatest impacts sum to less than the threshold are
dropped before any list is opened; of the others the block maxima bound the score of every
block of items, and only the postings of blocks that can reach the threshold are read.
Retrieved pairs whose matches lie along one diagonal are verified on the answer, the item's
text, by chaining the common runs and counting its words that stay; for the question, the
item's prompt, the part of its letters that the document holds is given with it.

A document holds an item when it has at least 25 running words of it, with at most one word
in ten changed, added or missing. Null and blank texts hold nothing; rows delivered again
give the same pair once; an empty table gives an empty result. The index is built once, by
the driver, and broadcast; items of more than PART_CHARS characters are dealt out by hash to
several indexes, each searched with all documents.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import quality

GRAM = 12              # letters of an index term
RUN = 6                # letters of the shortest common run in the verification
WINDOW, STEP = 260, 120  # letters of a passage, and between the starts of passages
THRESHOLD = 80.0       # least BM25 score; impacts are no less than its IN_BAND-th part, so that it holds for any item table
BAND, IN_BAND = 64, 32  # letters by which edits may shift a passage, and terms that must lie in that band (25 short words with two changed keep 45)
STRETCH, COVERED = 75, 0.62  # letters of the item that MIN_WORDS words exceed, and the part of them in common runs
MIN_WORDS, ERRORS = 25, 0.1
BLOCK = 16             # items of an index block
PART_CHARS = 10_000_000  # characters of the items of one index

_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|\\[nrt]|%([0-9A-F]{2})")
_DROP = re.compile(r"[\W_]+")
_MARKS = re.compile(r"[^\w\s]+|_+")
_B = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str) -> str:
    """A text with escapes resolved, in NFKC and lower case."""
    if "&" in text:
        text = html.unescape(text)
    if "\\" in text or "%" in text:
        text = _ESCAPE.sub(lambda m: chr(int(m[1] or m[2] or m[3], 16)) if m[1] or m[2] or m[3] else " ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).replace("­", "")
    return text.lower()


def letters(text: str) -> str:
    return _DROP.sub("", plain(text))


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)


def _mul(p: int) -> np.uint64:
    return np.uint64(pow(int(_B), p, 2**64))


def gram_hashes(c: np.ndarray) -> np.ndarray:
    """Hash of the GRAM letters from each position (GRAM = 12)."""
    if len(c) < GRAM:
        return np.zeros(0, dtype=np.uint64)
    h2 = c[:-1] * _B + c[1:]
    h4 = h2[:-2] * _mul(2) + h2[2:]
    h8 = h4[:-4] * _mul(4) + h4[4:]
    h = h8[: len(c) - GRAM + 1] * _mul(4) + h4[8: 8 + len(c) - GRAM + 1]
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def run_hashes(c: np.ndarray) -> np.ndarray:
    """Hash of the RUN letters from each position (RUN = 6)."""
    if len(c) < RUN:
        return np.zeros(0, dtype=np.uint64)
    h2 = c[:-1] * _B + c[1:]
    return (h2[:-4] * _mul(2) + h2[2:-2]) * _mul(2) + h2[4:]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, k) of every k < counts[row]."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


class Index:
    """BM25 inverted index of items over letter grams, with block maxima."""

    def __init__(self, items: list[tuple], k1: float = 1.2, b: float = 0.5):
        """``items``: (item id, text) or (item id, text, prompt) each."""
        self.ids = np.array([x[0] for x in items], dtype=np.int64)
        self.texts = [letters(x[1]) for x in items]
        self.prompts = [np.unique(run_hashes(_codes(letters(x[2])))) if len(x) > 2 and x[2] else np.zeros(0, dtype=np.uint64) for x in items]
        self.words = [[len(w) for w in _MARKS.sub("", plain(x[1])).split()] for x in items]
        h, item, pos = [], [], []
        for i, t in enumerate(self.texts):
            g = gram_hashes(_codes(t))
            h.append(g)
            item.append(np.full(len(g), i))
            pos.append(np.arange(len(g)))
        h = np.concatenate([np.zeros(0, dtype=np.uint64), *h])
        item, pos = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (item, pos))
        order = np.lexsort((pos, item, h))
        h, item, pos = h[order], item[order].astype(np.int64), pos[order].astype(np.int64)
        self.terms, first, count = np.unique(h, return_index=True, return_counts=True)
        # places: every occurrence of a term, with its item and position
        self.place_from, self.place_n, self.place_item, self.place_pos = first, count, item, pos
        # postings: one entry per term and item
        term = np.repeat(np.arange(len(self.terms)), count)
        n_items = max(1, len(items))
        key, tf = np.unique(term * n_items + item, return_counts=True)
        p_term, p_item = key // n_items, key % n_items
        df = np.bincount(p_term, minlength=len(self.terms))
        size = np.array([max(1, len(t)) for t in self.texts] or [1], dtype=float)
        idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
        impact = idf[p_term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * size[p_item] / size.mean()))
        self.post_from = np.searchsorted(p_term, np.arange(len(self.terms)))
        impact = np.maximum(impact, THRESHOLD / IN_BAND)
        self.post_n, self.post_item, self.post_impact = df, p_item, impact
        # block entries: one per term and block of items, with the block maximum and its postings
        self.n_blocks = -(-n_items // BLOCK)
        bkey = p_term * self.n_blocks + p_item // BLOCK
        starts = np.flatnonzero(np.concatenate([[True], bkey[1:] != bkey[:-1]])) if len(bkey) else np.zeros(0, dtype=np.int64)
        self.block_max = np.maximum.reduceat(impact, starts) if len(starts) else impact
        self.block_post, self.block_posts = starts, np.diff(np.append(starts, len(bkey)))
        b_term = bkey[starts] // self.n_blocks
        self.block_no = bkey[starts] % self.n_blocks
        self.block_from = np.searchsorted(b_term, np.arange(len(self.terms)))
        self.block_n = np.bincount(b_term, minlength=len(self.terms))
        self.term_max = np.maximum.reduceat(impact, self.post_from) if len(self.terms) else impact
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.terms >> np.uint64(44)).astype(np.int64)] = True
        self._grams: dict[int, dict] = {}

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in h, term numbers) of the hashes that are terms."""
        at = np.flatnonzero(self.sieve[(h >> np.uint64(44)).astype(np.int64)])
        if not len(at) or not len(self.terms):
            return at[:0], at[:0]
        t = np.minimum(np.searchsorted(self.terms, h[at]), len(self.terms) - 1)
        ok = self.terms[t] == h[at]
        return at[ok], t[ok]

    def search(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passages, items) that score THRESHOLD or more; rows are a passage's terms."""
        self.read = (0, 0)  # block entries and postings opened
        none = np.zeros(0, dtype=np.int64)
        if not len(term):
            return none, none
        # passages are numbered without gaps, so sums over them are dense arrays
        promising = np.bincount(passage, self.term_max[term]) >= THRESHOLD
        some = promising[passage]
        passage, term = passage[some], term[some]
        row, k = _spread(self.block_n[term])
        entry = self.block_from[term[row]] + k
        at = passage[row] * self.n_blocks + self.block_no[entry]
        slots, inverse = np.unique(at, return_inverse=True)
        alive = np.bincount(inverse, self.block_max[entry], minlength=len(slots)) >= THRESHOLD
        live = alive[inverse] if len(slots) else np.zeros(0, dtype=bool)
        opened, row, entry = len(entry), row[live], entry[live]
        r, k = _spread(self.block_posts[entry])
        post = self.block_post[entry[r]] + k
        self.read = (opened, len(post))
        if not len(post):
            return none, none
        n = len(self.ids)
        ikey, inv = np.unique(passage[row[r]] * n + self.post_item[post], return_inverse=True)
        score = np.bincount(inv, self.post_impact[post])
        ikey = ikey[score >= THRESHOLD]
        return ikey // n, ikey % n

    # --- verification -----------------------------------------------------------------

    def _item_runs(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the item's RUN-letter grams, and their positions."""
        if i not in self._grams:
            h = run_hashes(_codes(self.texts[i]))
            order = np.argsort(h, kind="stable")
            self._grams[i] = (h[order], order)
        return self._grams[i]

    def runs(self, doc: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal common runs of at least RUN letters: doc starts, item starts, lengths. ``doc``: letter codes."""
        h, where = self._item_runs(i)
        g = run_hashes(doc)
        lo, hi = np.searchsorted(h, g, "left"), np.searchsorted(h, g, "right")
        d, k = _spread(hi - lo)
        j = where[lo[d] + k]
        order = np.lexsort((d, d - j))
        d, j = d[order], j[order]
        if not len(d):
            return d, j, d
        new = np.concatenate([[True], (np.diff(d) != 1) | (np.diff(d - j) != 0)])
        at = np.flatnonzero(new)
        n = np.diff(np.concatenate([at, [len(d)]])) + RUN - 1
        return d[at], j[at], n

    def _band(self, diag: np.ndarray, j: np.ndarray, n: np.ndarray, i: int) -> np.ndarray | None:
        """The runs of the fullest diagonal band, or None where they cover too little of every stretch of the item for a passage of MIN_WORDS."""
        order = np.argsort(diag, kind="stable")
        line, weight = diag[order], np.concatenate([[0], np.cumsum(n[order])])
        ends = np.searchsorted(line, line + 2 * BAND, "right")
        a = int((weight[ends] - weight[:-1]).argmax())
        mark = np.zeros(len(self.texts[i]) + 2, dtype=np.int32)
        inside = order[a:ends[a]]
        np.add.at(mark, j[inside], 1)
        np.add.at(mark, j[inside] + n[inside], -1)
        cover = np.concatenate([[0], np.cumsum(np.cumsum(mark) > 0)])
        if len(cover) <= STRETCH or int((cover[STRETCH:] - cover[:-STRETCH]).max()) < COVERED * STRETCH:
            return None
        # edits of a long passage may leave the band on either side
        return np.flatnonzero((diag >= line[a] - BAND) & (diag <= line[a] + 3 * BAND))

    def held_words(self, doc: np.ndarray, i: int, word_ends: np.ndarray) -> int:
        """Most running words of item i that ``doc`` (letter codes) holds with at most one error in ten; 0 if below MIN_WORDS.

        ``word_ends``: where the words of doc end, for counting the words that only the document has.
        """
        d, j, n = self.runs(doc, i)
        near = self._band(d - j, j, n, i) if len(d) else None
        if near is None:
            return 0
        near = near[np.argsort(d[near], kind="stable")]
        d, j, n = d[near], j[near], n[near]
        best, prev = n.astype(float), np.full(len(n), -1)
        for k in range(1, len(n)):
            # earlier runs that end (after trimming an overlap of less than their length) before this one starts
            over = np.maximum(0, np.maximum(d[:k] + n[:k] - d[k], j[:k] + n[:k] - j[k]))
            shift = np.abs((d[k] - j[k]) - (d[:k] - j[:k]))
            gain = best[:k] - over - 0.4 * shift - 2
            gain[(over >= n[:k]) | (over >= n[k]) | (d[:k] >= d[k]) | (j[:k] >= j[k])] = -1.0
            p = int(gain.argmax())
            if gain[p] > 0:
                best[k] += gain[p]
                prev[k] = p
        k = int(best.argmax())
        chain = []
        while k >= 0:
            chain.append(k)
            k = int(prev[k])
        chain.reverse()
        ends = np.cumsum(self.words[i])
        starts = ends - np.array(self.words[i])
        covered = np.zeros(len(self.texts[i]) + 1, dtype=bool)
        for k in chain:
            covered[j[k]:j[k] + n[k]] = True
        cum = np.concatenate([[0], np.cumsum(covered)])
        kept = cum[ends] - cum[starts] == ends - starts
        more = np.zeros(len(ends))  # words that stand before an item word in the document only
        word_starts = np.concatenate([[0], word_ends[:-1]])
        for p, k in zip(chain, chain[1:]):
            lo, hi = d[p] + n[p], d[k]
            w0, w1 = np.searchsorted(word_ends, lo, "right"), np.searchsorted(word_starts, hi, "left")
            inside = np.minimum(word_ends[w0:w1], hi) - np.maximum(word_starts[w0:w1], lo)
            only_doc = int((2 * inside > word_ends[w0:w1] - word_starts[w0:w1]).sum())
            a, e = np.searchsorted(ends, j[p] + n[p], "right"), np.searchsorted(starts, j[k], "left")
            only_doc -= int((~kept[a:e]).sum())
            if only_doc > 0:
                more[min(np.searchsorted(ends, j[k], "right"), len(more) - 1)] += only_doc
        wrong = np.where(kept, 0.0, 1.0) + more
        err = np.concatenate([[0.0], np.cumsum(wrong)])
        m, most = len(wrong), 0
        for a in range(m - MIN_WORDS + 1):
            if not kept[a]:
                continue
            length = np.arange(MIN_WORDS, m - a + 1)
            # an insertion before the first word is outside the passage
            ok = (err[a + length] - err[a] - more[a] <= ERRORS * length + 1e-9) & kept[a + length - 1]
            if ok.any():
                most = max(most, int(length[ok].max()))
        return most


def match(index: Index, ids: list[int], texts: list[str]) -> list[tuple[int, int, int, float]]:
    """(doc id, item id, held words, part of the prompt) of a batch."""
    streams = [letters(t) if t else "" for t in texts]
    sizes = np.fromiter(map(len, streams), dtype=np.int64, count=len(streams))
    sep = GRAM  # documents are kept apart by as many blanks as a gram is long, less one
    joined = (" " * (sep - 1)).join(streams)
    begin = np.concatenate([[0], np.cumsum(sizes + sep - 1)[:-1]]) if len(sizes) else sizes
    pos, term = index.lookup(gram_hashes(_codes(joined)))
    if not len(pos):
        return []
    doc = np.searchsorted(begin, pos, "right") - 1
    local = pos - begin[doc]
    # passages overlap: a position belongs to those that start at or before it; they are numbered through
    per = sizes // STEP + 1
    number = np.cumsum(per) - per
    k = np.arange(WINDOW // STEP + 1)
    w = (local // STEP)[:, None] - k[None, :]
    row = np.nonzero((w >= 0) & (local[:, None] - w * STEP + GRAM <= WINDOW))
    passage = (number[doc][:, None] + w)[row]
    hit = row[0]
    found_p, found_i = index.search(passage, term[hit])
    if not len(found_p):
        return []
    # places of the terms of the found pairs, their diagonals, and the fullest band of each pair
    n = len(index.ids)
    want = np.unique(found_p * n + found_i)
    some = np.isin(passage, found_p)
    passage, hit = passage[some], hit[some]
    r, k = _spread(index.place_n[term[hit]])
    entry = index.place_from[term[hit[r]]] + k
    key = passage[r] * n + index.place_item[entry]
    keep = np.isin(key, want)
    key, diag = key[keep], local[hit[r[keep]]] - index.place_pos[entry[keep]]
    big = np.int64(1 << 24)
    order = np.argsort(key * big + diag + (big >> 1), kind="stable")
    line = (key * big + diag + (big >> 1))[order]
    count = np.searchsorted(line, line + BAND, "right") - np.arange(len(line))
    good = np.unique(key[order][count >= IN_BAND])
    out: dict[tuple[int, int], int] = {}
    pairs: dict[tuple[int, int], list[int]] = {}
    docs_of = np.searchsorted(number, good // n, "right") - 1
    for x, dn in zip(good.tolist(), docs_of.tolist()):
        pairs.setdefault((dn, x % n), []).append(x // n - int(number[dn]))
    for (dn, i), ws in pairs.items():
        s = _codes(streams[dn])
        ends = np.cumsum([len(w) for w in _MARKS.sub("", plain(texts[dn])).split()])
        length = len(index.texts[i])
        for w0, w1 in _merge(sorted(ws), -(-length // STEP)):
            lo = max(0, w0 * STEP - length - WINDOW)
            hi = min(len(s), w1 * STEP + WINDOW + length + WINDOW)
            held = index.held_words(s[lo:hi], i, np.concatenate([np.clip(ends[(ends > lo) & (ends < hi)] - lo, 0, None), [hi - lo]]))
            if held:
                out[dn, i] = max(held, out.get((dn, i), 0))
    grams: dict[int, np.ndarray] = {}
    rows = []
    for (dn, i), held in out.items():
        prompt = index.prompts[i]
        if len(prompt) and dn not in grams:
            grams[dn] = np.unique(run_hashes(_codes(streams[dn])))
        rows.append((ids[dn], int(index.ids[i]), held, float(np.isin(prompt, grams[dn], assume_unique=True).mean()) if len(prompt) else 0.0))
    return rows


def _merge(ws: list[int], gap: int) -> list[tuple[int, int]]:
    """Runs of passage numbers no further apart than gap."""
    out: list[list[int]] = []
    for w in ws:
        if out and w - out[-1][1] <= gap:
            out[-1][1] = w
        else:
            out.append([w, w])
    return [tuple(x) for x in out]


_OUT = "doc_id long, item_id long, n_words int, prompt_part double"


def _search(docs: DataFrame, items: list[tuple]) -> DataFrame:
    """Rows of ``leaks`` for the items of one index, which is unpickled once in each worker."""
    index = docs.sparkSession.sparkContext.broadcast(Index(items))

    def run(batches):
        for b in quality.portions(batches):
            got = match(index.value, b.column(0).to_pylist(), b.column(1).to_pylist())
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.int64(), pa.int32(), pa.float64()))], names=["doc_id", "item_id", "n_words", "prompt_part"])

    return docs.mapInArrow(run, _OUT)


def leaks(docs: DataFrame, items: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(doc_id, item_id, n_words, prompt_part): every document and the items it holds, with the longest held passage in words and the held part of the prompt's letters."""
    items = items.select("item_id", "item_text", F.col("prompt") if "prompt" in items.columns else F.lit(None).cast("string").alias("prompt"))
    items = items.where("item_id is not null and item_text is not null").groupBy("item_id", "item_text").agg(F.min("prompt").alias("prompt"))
    chars = items.agg(F.coalesce(F.sum(F.length("item_text")), F.lit(0)).alias("n")).first().n
    parts = max(1, -(-chars // part_chars))
    full = docs.where("text is not null").select("doc_id", "text")
    out = None
    for k in range(parts):  # one part of the items is on the driver at a time
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(parts)) == k)
        rows = [(r.item_id, r.item_text, r.prompt) for r in own.orderBy("item_id", "item_text").collect()]
        found = _search(full, rows)
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"), F.max("prompt_part").alias("prompt_part"))
