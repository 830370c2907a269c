"""Problem 2: the same or almost the same record in the training and the evaluation splits.

Texts are reduced to their words in lower case, without their source's boilerplate lines.
Equal word sequences form one class, so a group of exact copies is searched once, however
large. Classes get minwise hashes of their three-word shingles; bands of them are the keys by
which evaluation classes meet training classes. Texts of one kind share so many shingles that
the pairs that meet grow with the square of the table, so they are never written down: an entry
of a band carries a histogram of its text's words, and only pairs whose lengths and histograms
leave room for the wanted share of common words leave the task in which they meet. A text is
sent once for every band, so an entry's histogram is narrow; the pairs that it leaves are sieved
again by histograms of twice the size, kept with the texts. Neither sieve loses a case. A group in
which entries meet is of one band, so what a text sends does not depend on how the bands are dealt
out. They are dealt with in ROUNDS, and a round's shuffle files are removed before the next, so that
the disk holds one round of them. The words verify: the share of the longer text that stands in
common passages alone decides.

By TESTDATA.md a case keeps at least four fifths of the longer text's words in passages of
the same order. Every fifth word replaced leaves passages of four words, no five-word shingle
and a three-word similarity of 0.25, so shingles are as long as the shortest passage, bands
have two rows. Shingles that stand in very many
texts would make candidates of unrelated texts in such bands: they are counted over all different
texts, and minwise hashes rank them behind all others. Texts made of them for a good part (as are the many changed copies of
one text) get further bands in which all shingles rank alike. Words keep their order within a
passage; the passages may have changed places (the tables hold such copies with moved paragraphs).

Texts without words, texts that are no prose (problem 3), null texts and null splits are no
case. Texts of fewer than three words have one shingle, the text itself. Rows delivered again
count once. An empty side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..session import cut_lineage, forget, shuffle_mark
from . import boilerplate, quality

SHINGLE, BANDS, ROWS = 3, 60, 2
KEEP = 0.8            # share of the longer text's words in common passages
EVEN_BANDS = 36       # bands of hashes in which all shingles rank alike, for texts with EVEN_SHARE of common shingles or more
EVEN_SHARE = 0.35
ROUNDS = 12           # at most, in which the bands are dealt with one after another
ROUND_BYTES = 256 << 20  # entries of bands that are worth a round of their own
BINS, LEVELS = 256, 4  # of the histogram of a text's words: a bit of a bin for each of its first words
WIDE, NARROW = BINS * LEVELS // 64, BINS * 2 // 64  # longs of a histogram with a text, and in an entry
GROUP_BYTES = 32 << 20  # entries of bands that meet in one group, about
PORTION_BYTES = 16 << 20  # of shingles hashed or counted at once
BLOCK = 1 << 15       # shingles ranked at once, which stay in the processor's cache
MEETINGS = 1 << 16    # pairs compared in one step
COMMON = 0.003        # share of all different texts, and
COMMON_LEAST = 60     # texts at least, that hold a common shingle
COMMON_MOST = 100_000  # common shingles at most
BROADCAST_ROWS = 500_000
REPRESENTATIVES = 100  # members that stand for a group of copies on either side
PASSAGE = 3           # words of the shortest passage
EVALUATION = ("validation", "test")

_rng = np.random.default_rng(20_240_501)
_A = (_rng.integers(1, 2**32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _fmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[list[str]]) -> np.ndarray:
    """64-bit hashes of all words, flat."""
    return pd.util.hash_array(np.array(list(chain.from_iterable(texts)), dtype=object)).astype(np.uint64)


def shingle_hashes(texts: list[list[str]], h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): 32-bit shingle hashes of lists of words, flat, and where each text begins; no text is empty. ``h``: their ``word_hashes``."""
    n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    h = word_hashes(texts) if h is None else h
    start = np.cumsum(n) - n
    acc = np.zeros(len(h), dtype=np.uint64)
    padded = np.concatenate([h, np.zeros(SHINGLE, dtype=np.uint64)])
    for k in range(SHINGLE):
        acc = _fmix(acc * _MIX + padded[k:k + len(h)])
    keep = np.ones(len(h), dtype=bool)  # no shingle begins in the last words of a text
    for k in range(1, SHINGLE):
        keep[(start + n - k)[n >= SHINGLE]] = False
        keep[(start + k)[(n < SHINGLE) & (n > k)]] = False
    for i in np.flatnonzero(n < SHINGLE).tolist():  # one shingle: the whole text
        acc[start[i]] = pd.util.hash_array(np.array([" ".join(texts[i])], dtype=object))[0]
    counts = np.maximum(n - SHINGLE + 1, 1)
    return (acc[keep] >> np.uint64(32)).astype(np.uint32), np.cumsum(counts) - counts


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th ranking of hashes that are mixed already: multiply and add."""
    x = h * _A[k]
    x += _B[k]
    return x


def minhashes(texts: list[list[str]]) -> np.ndarray:
    """(texts x BANDS*ROWS) minwise hashes in which all shingles rank alike."""
    h, starts = shingle_hashes(texts)
    return np.stack([np.minimum.reduceat(_mixed(h, k), starts) for k in range(BANDS * ROWS)], axis=1)


def _members(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which hashes are in ``common`` (sorted): a table of their leading bits first, then a comparison with those that begin alike."""
    out = np.zeros(len(h), dtype=bool)
    if len(common):
        lead = (common >> np.uint32(12)).astype(np.int64)
        alike = np.bincount(lead, minlength=1 << 20)
        first = np.where(alike > 0, np.cumsum(alike) - alike, -1).astype(np.int32)
        spot = first[h >> np.uint32(12)]
        at = np.flatnonzero(spot >= 0)
        own, spot = h[at], spot[at]
        hit = np.zeros(len(at), dtype=bool)
        for k in range(int(alike.max())):
            hit |= common[np.minimum(spot + k, len(common) - 1)] == own
        out[at] = hit
    return out


def signatures(h: np.ndarray, starts: np.ndarray, behind: np.ndarray, bands, even: bool) -> np.ndarray:
    """(texts x ROWS*bands) minwise hashes of these bands; shingles marked in ``behind`` rank behind all others, with ``even`` all rank alike."""
    out = np.empty((len(starts), ROWS * len(bands)), dtype=np.uint32)
    cuts = [*np.unique(np.searchsorted(starts, np.arange(0, len(h), BLOCK))).tolist(), len(starts)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        at = slice(starts[a], starts[b] if b < len(starts) else len(h))
        own, begin, top = h[at], starts[a:b] - starts[a], behind[at].astype(np.uint32) << np.uint32(31)
        for i, k in enumerate(ROWS * band + r for band in bands for r in range(ROWS)):
            x = _mixed(own, k)
            if not even:
                x >>= np.uint32(1)
                x |= top
            out[a:b, i] = np.minimum.reduceat(x, begin)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(texts x bands) 32-bit keys; a key holds within its band only."""
    s = sig.astype(np.uint64).reshape(len(sig), -1, ROWS)
    acc = np.zeros(s.shape[:2], dtype=np.uint64)
    for r in range(ROWS):
        acc = _fmix(acc * _MIX + s[:, :, r] + np.uint64(1))
    return (acc >> np.uint64(32)).astype(np.uint32).view(np.int32)


def words_of(text: str | None) -> list[str]:
    """The words of a prose text in lower case; none for other texts."""
    return [] if not text or quality.is_other(text) else quality.WORD_OR_NUMBER.findall(text.lower())


def _class_hashes(words: list[list[str]]) -> np.ndarray:
    return pd.util.hash_array(np.array([" ".join(w) for w in words], dtype=object)).view(np.int64)


def word_bits(n: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, over): of each text of ``n`` words, a bit for each of the first LEVELS words of each of BINS bins, and the number of all other words; ``h``: their hashes, flat."""
    bits, over = np.empty((len(n), WIDE), dtype=np.uint64), np.empty(len(n), dtype=np.int64)
    bins = ((h >> np.uint64(20)) % np.uint64(BINS)).astype(np.int64)
    ends = np.cumsum(n)
    for a in range(0, len(n), 512):
        own = n[a:a + 512]
        cells = np.repeat(np.arange(len(own)) * BINS, own) + bins[ends[a] - n[a]:ends[a + len(own) - 1]]
        count = np.bincount(cells, minlength=len(own) * BINS).reshape(-1, 1, BINS)
        bits[a:a + 512] = np.packbits(count > np.arange(LEVELS)[:, None], axis=2).reshape(len(own), -1).view(np.uint64)
        over[a:a + 512] = np.maximum(count - LEVELS, 0).sum(axis=(1, 2))
    return bits, over


def narrowed(bits: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, over) of half the size: a bit for the first word of each bin, and for the next two words of each two bins."""
    one, two, three = (bits[:, x * BINS // 64:(x + 1) * BINS // 64] for x in range(3))
    (a, b), (c, d) = np.split(two, 2, axis=1), np.split(three, 2, axis=1)
    out = np.concatenate([one, a | b, (a & b) | c | d], axis=1)
    return out, n - np.bitwise_count(out).sum(axis=1, dtype=np.int64)


def histograms(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(bits, over) of each text as its entries carry them."""
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return narrowed(word_bits(n, word_hashes(words))[0], n)


def room(x: np.ndarray, y: np.ndarray, over: np.ndarray) -> np.ndarray:
    """Words that pairs of texts can have in common at most, from their bits and the lesser number of their other words."""
    n = np.bitwise_count(x & y).view(np.uint64)  # a byte for every 64 bits; added in pairs of bytes, then in sums of two bytes each
    low = np.uint64(0x00FF00FF00FF00FF)
    n = ((n & low) + ((n >> np.uint64(8)) & low)).sum(axis=1)
    return ((n * np.uint64(0x0001000100010001)) >> np.uint64(48)).astype(np.int64) + over


def _features(batches):
    """A number of the row, class hash, number of words, histogram and shingle hashes of each prose text with words."""
    row = TaskContext.get().partitionId() << 40
    for b in quality.portions(batches):
        ids, texts, splits = (b.column(c).to_pylist() for c in ("chunk_id", "text", "split"))
        rows = [(i, s in EVALUATION, w) for i, t, s in zip(ids, texts, splits) if (w := words_of(t))]
        if not rows:
            continue
        words = [r[2] for r in rows]
        hashes = word_hashes(words)
        bits, over = word_bits(np.fromiter(map(len, words), dtype=np.int64, count=len(words)), hashes)
        h, starts = shingle_hashes(words, hashes)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(row, row + len(rows)), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()),
            pa.array(_class_hashes(words), pa.int64()), pa.array([len(w) for w in words], pa.int32()), pa.array(over, pa.int32()),
            pa.array([x.tobytes() for x in bits], pa.binary()), pa.array([x.tobytes() for x in np.split(h, starts[1:])], pa.binary())],
            names=["row", "chunk_id", "is_eval", "h", "n_words", "over", "bits", "shingles"])
        row += len(rows)


FEATURES = "row long, chunk_id long, is_eval boolean, h long, n_words int, over int, bits binary, shingles binary"
#: An entry of a band: band, key and number of words in one number, so that a band's texts lie by key and length; the words outside the narrow bits, twice, and 1 for the evaluation side.
ENTRY = np.dtype([("at", "<u8"), ("h", "<i8"), ("over", "<u4"), ("bits", "<u8", NARROW)])
LENGTH_BITS = np.uint64(24)
LENGTH_MOST = (1 << 24) - 1


def _slices(batches):
    """Arrow batches cut into slices of about PORTION_BYTES of shingles."""
    for b in batches:
        part = np.cumsum(pc.binary_length(b.column("shingles")).to_numpy(zero_copy_only=False).astype(np.int64)) // PORTION_BYTES
        at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
        yield from (b.slice(x, y - x) for x, y in zip(at, at[1:]) if y > x)


def _flat(a: pa.Array, kind) -> np.ndarray:
    """The values of a binary column without nulls, one after another, as numbers."""
    if not len(a):
        return np.zeros(0, dtype=kind)
    _, ends, values = a.buffers()
    ends = np.frombuffer(ends, dtype=np.int64 if pa.types.is_large_binary(a.type) else np.int32)[a.offset:a.offset + len(a) + 1]
    return np.frombuffer(memoryview(values)[ends[0]:ends[-1]], dtype=kind)


def _shingles(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) as ``shingle_hashes`` gave them."""
    n = pc.binary_length(b.column("shingles")).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    return _flat(b.column("shingles"), np.uint32), np.cumsum(n) - n


def _often(h: np.ndarray, rows: int) -> pa.RecordBatch:
    """The shingles of a block of ``rows`` texts that occur as often as in COMMON of its texts."""
    s, n = np.unique(h, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(s[n >= COMMON * rows - 1e-6].view(np.int32), pa.int32())], names=["s"])


def _locally_common(batches):
    """The shingles that are common in any block of a task's texts; what is so in no block is not so in the whole."""
    full, own, rows, size = None, [], 0, 0
    for b in _slices(batches):
        h, _ = _shingles(b)
        own, rows, size = [*own, h], rows + b.num_rows, size + h.nbytes
        if size >= PORTION_BYTES:
            if full:
                yield _often(*full)
            full, own, rows, size = (np.concatenate(own), rows), [], 0, 0
    if full:  # the rest is no block of its own: in a few texts everything is common
        own, rows = [full[0], *own], rows + full[1]
    if own:
        yield _often(np.concatenate(own), rows)


def _counted(listed: np.ndarray):
    """In how many texts of a task each of the ``listed`` (sorted) shingles stands."""
    def run(batches):
        total = np.zeros(len(listed), dtype=np.int64)
        for b in _slices(batches):
            h, starts = _shingles(b)
            text = np.repeat(np.arange(len(starts), dtype=np.uint64), np.diff(np.append(starts, len(h))))
            hit = _members(h, listed)
            pairs = np.unique((text[hit] << np.uint64(32)) | h[hit])
            total += np.bincount(np.searchsorted(listed, (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)), minlength=len(listed))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(listed[some].view(np.int32), pa.int32()), pa.array(total[some], pa.int64())], names=["s", "n"])
    return run


def common_shingles(feats: DataFrame) -> np.ndarray:
    """Hashes (sorted) of the shingles that stand in very many different texts, counted over all of them.

    A text delivered or copied again counts once, by the first row of its class. Shingles that are
    common in no block of texts are not common in the whole; all others are counted.
    """
    multi = _checked(feats.groupBy("h").agg(F.count("*").alias("n"), F.min("row").alias("first")).where("n > 1").drop("n"))
    once = feats.select("row", "h", "shingles").join(multi, "h", "left").where("first is null or first = row").select("shingles")
    least = max(COMMON_LEAST, COMMON * feats.select("h").distinct().count())
    listed = np.unique(np.array([r.s for r in once.mapInArrow(_locally_common, "s int").distinct().collect()], dtype=np.int32).view(np.uint32))
    found = once.mapInArrow(_counted(listed), "s int, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r.s for r in found.orderBy(F.desc("n"), "s").limit(COMMON_MOST).collect()], dtype=np.int32).view(np.uint32))


def _entries(common: np.ndarray, turn: int, rounds: int, groups: int):
    """The entries of the bands of one round, packed by the group in which equal keys meet; some ``groups`` in all, each of one band."""
    ranked, alike = range(turn, BANDS, rounds), range(turn, EVEN_BANDS, rounds)
    each = -(-groups // len(ranked))

    def run(batches):
        for b in _slices(batches):
            h, starts = _shingles(b)
            behind = _members(h, common)
            share = np.add.reduceat(behind.astype(np.int64), starts) / np.diff(np.append(starts, len(h)))
            even = np.flatnonzero(share >= EVEN_SHARE)
            keys = [(np.arange(len(starts)), ranked, band_keys(signatures(h, starts, behind, ranked, False)))]
            if len(even) and len(alike):
                own = np.repeat(share >= EVEN_SHARE, np.diff(np.append(starts, len(h))))
                n = np.diff(np.append(starts, len(h)))[even]
                keys.append((even, [BANDS + x for x in alike], band_keys(signatures(h[own], np.cumsum(n) - n, behind[own], alike, True))))
            text = np.concatenate([np.repeat(rows, len(bands)) for rows, bands, _ in keys])
            key = np.concatenate([(np.array(bands, dtype=np.uint64) << np.uint64(32)) + k.view(np.uint32) for _, bands, k in keys], axis=None)
            group = ((key >> np.uint64(32)) * np.uint64(each) + _fmix(key) % np.uint64(each)).astype(np.int32)
            order = np.argsort(group, kind="stable")
            text, key, group = text[order], key[order], group[order]
            column = lambda name: b.column(name).to_numpy(zero_copy_only=False)
            bits, over = narrowed(_flat(b.column("bits"), np.uint64).reshape(-1, WIDE), column("n_words"))
            out = np.empty(len(text), dtype=ENTRY)
            out["at"] = (key << LENGTH_BITS) + np.minimum(column("n_words"), LENGTH_MOST).astype(np.uint64)[text]
            out["h"] = column("h")[text]
            out["over"] = (over.astype(np.uint32) * 2 + column("is_eval"))[text]
            out["bits"] = bits[text]
            at = np.flatnonzero(np.diff(group, prepend=-1))
            yield pa.RecordBatch.from_arrays([
                pa.array(group[at], pa.int32()), pa.array([x.tobytes() for x in np.split(out, at[1:])], pa.binary())], names=["g", "entries"])
    return run


def meet(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes (e, t) of different texts with an equal key of which either's length and words leave room for the share KEEP."""
    def side(rows):
        rows = rows[np.lexsort((rows["h"], rows["at"]))]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows["at"][1:] != rows["at"][:-1]) | (rows["h"][1:] != rows["h"][:-1])
        return rows[new]  # copies of a text once

    of_eval = (entries["over"] & 1).astype(bool)
    e, t = side(entries[of_eval]), side(entries[~of_eval])
    n, key = (e["at"] & np.uint64(LENGTH_MOST)).astype(np.int64), e["at"] & ~np.uint64(LENGTH_MOST)
    least = np.where(n < LENGTH_MOST, np.ceil(n * KEEP - 1e-6), 0).astype(np.uint64)
    most = np.minimum(np.floor(n / KEEP + 1e-6), LENGTH_MOST).astype(np.uint64)
    lo, hi = np.searchsorted(t["at"], key + least, "left"), np.searchsorted(t["at"], key + most, "right")
    some = np.flatnonzero(hi > lo)
    ends = np.cumsum((hi - lo)[some])
    xs, ys = [], []
    ebits, tbits = np.ascontiguousarray(e["bits"]), np.ascontiguousarray(t["bits"])
    eover, tover = (e["over"] >> 1).astype(np.int64), (t["over"] >> 1).astype(np.int64)
    tn = (t["at"] & np.uint64(LENGTH_MOST)).astype(np.int64)
    for begin in range(0, int(ends[-1]) if len(ends) else 0, MEETINGS):
        k = np.arange(begin, min(begin + MEETINGS, int(ends[-1])))
        i = np.searchsorted(ends, k, "right")
        j = hi[some[i]] - (ends[i] - k)
        i = some[i]
        ok = room(ebits[i], tbits[j], np.minimum(eover[i], tover[j])) >= KEEP * np.maximum(n[i], tn[j]) - 1e-6
        ok &= e["h"][i] != t["h"][j]
        xs.append(e["h"][i[ok]])
        ys.append(t["h"][j[ok]])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *xs]), np.concatenate([none, *ys])


def _meet(group: pa.Table) -> pa.Table:
    e, t = meet(np.frombuffer(b"".join(group.column("entries").to_pylist()), dtype=ENTRY))
    return pa.table([pa.array(e, pa.int64()), pa.array(t, pa.int64())], names=["e", "t"])


def _words(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("h"), pa.array([" ".join(words_of(t)) for t in b.column("text").to_pylist()], pa.string())], names=["h", "words"])


def jaccard(a: list[str], b: list[str]) -> float:
    grams = lambda w: {tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))}
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


def kept_share(a: list[str], b: list[str]) -> float:
    """Share of the longer text's words in common passages, longest first, each word used once on either side."""
    if len(a) < len(b):
        a, b = b, a
    size, k = len(a), min(PASSAGE, len(b))
    kept = 0
    for end in (1, -1):  # equal beginnings and ends need no search
        n = next((i for i, (x, y) in enumerate(zip(a[::end], b[::end])) if x != y), len(b))
        if n >= k:
            a, b, kept = (a[n:], b[n:], kept + n) if end == 1 else (a[:len(a) - n], b[:len(b) - n], kept + n)
    where: dict[tuple, list[int]] = {}
    for j in range(len(b) - k + 1):
        where.setdefault(tuple(b[j:j + k]), []).append(j)
    free_a, free_b = [True] * len(a), [True] * len(b)
    runs = []
    for i in range(len(a) - k + 1):
        for j in where.get(tuple(a[i:i + k]), ()):
            if i and j and a[i - 1] == b[j - 1]:
                continue  # inside a longer run
            n = k
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            runs.append((-n, i, j))
    runs.sort()
    for n, i, j in runs:
        n = -n
        while n >= k:  # the free part of the run
            s = next((x for x in range(n) if free_a[i + x] and free_b[j + x]), None)
            if s is None:
                break
            e = s
            while e < n and free_a[i + e] and free_b[j + e]:
                e += 1
            if e - s >= k:
                kept += e - s
                free_a[i + s:i + e] = [False] * (e - s)
                free_b[j + s:j + e] = [False] * (e - s)
            i, j, n = i + e, j + e, n - e
    return kept / size


def most_kept(a: list[str], b: list[str]) -> float:
    """Share of the longer text's words in any passage that the shorter one holds too; no less than ``kept_share``."""
    if len(a) < len(b):
        a, b = b, a
    k = min(PASSAGE, len(b))
    grams = lambda w: zip(*(w[i:] for i in range(k)))
    n = upto = 0
    for i, hit in enumerate(map(set(grams(b)).__contains__, grams(a))):
        if hit:
            n += i + k - max(i, upto)
            upto = i + k
    return n / len(a)


@F.arrow_udf(T.StructType([T.StructField("jaccard", T.DoubleType()), T.StructField("kept", T.DoubleType())]))
def _verify(a: pa.Array, b: pa.Array) -> pa.Array:
    js, ks = [], []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        x, y = x.split(" "), y.split(" ")
        near = most_kept(x, y) >= KEEP
        js.append(jaccard(x, y) if near else None)
        ks.append(kept_share(x, y) if near else 0.0)
    return pa.StructArray.from_arrays([pa.array(js, pa.float64()), pa.array(ks, pa.float64())], names=["jaccard", "kept"])


def _checked(df: DataFrame) -> DataFrame:
    """Materialised ``df``, to be broadcast while it has at most BROADCAST_ROWS rows (of a few longs), else left to a shuffle."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def features(rows: DataFrame, arrays: DataFrame) -> DataFrame:
    """FEATURES of every row that has words and is prose, materialised."""
    return cut_lineage(boilerplate.strip(rows, arrays).select("chunk_id", "text", "split").mapInArrow(_features, FEATURES))


@F.arrow_udf(T.BooleanType())
def _has_room(x: pa.Array, y: pa.Array, over: pa.Array, longer: pa.Array) -> pa.Array:
    number = lambda a: a.to_numpy(zero_copy_only=False).astype(np.int64)
    bits = lambda a: _flat(a, np.uint64).reshape(len(a), WIDE)
    return pa.array(room(bits(x), bits(y), number(over)) >= KEEP * number(longer) - 1e-6)


def sieved(met: DataFrame, feats: DataFrame) -> DataFrame:
    """The pairs (e, t) of ``met``, materialised, whose whole histograms leave room for the share KEEP."""
    ends = _checked(met.select(F.col("e").alias("h")).unionByName(met.select(F.col("t").alias("h"))).distinct())
    own = feats.select("h", "n_words", "over", "bits").join(ends, "h").groupBy("h").agg(F.any_value(F.struct("n_words", "over", "bits")).alias("o"))
    side = lambda name: own.select(F.col("h").alias(name), F.col("o").alias("o" + name))
    return met.join(side("e"), "e").join(side("t"), "t").where(
        _has_room("oe.bits", "ot.bits", F.least("oe.over", "ot.over"), F.greatest("oe.n_words", "ot.n_words"))).select("e", "t")


def candidates(feats: DataFrame, common: np.ndarray) -> DataFrame:
    """(e, t): classes with an equal band that may keep the share KEEP; the shuffle files of one round of bands at a time."""
    size = feats.count() * BANDS * ENTRY.itemsize
    rounds = min(ROUNDS, 1 + size // ROUND_BYTES)
    groups = 24 + size // rounds // GROUP_BYTES
    found = None
    for turn in range(rounds):
        mark = shuffle_mark(feats.sparkSession)
        met = cut_lineage(feats.mapInArrow(_entries(common, turn, rounds, groups), "g int, entries binary").groupBy("g").applyInArrow(_meet, "e long, t long").distinct())
        found = met if found is None else found.unionByName(met)
        forget(feats.sparkSession, mark)
    return sieved(cut_lineage(found.distinct()), feats)


def linked_classes(chunks: DataFrame):
    """(members, pairs): chunk_id, is_eval, h; and pairs of different classes (e, t, jaccard, kept), e on the evaluation and t on the training side."""
    arrays = boilerplate.node_arrays(boilerplate.nodes(chunks))
    rows = chunks.where("split is not null and text is not null").select("chunk_id", "source_dataset", "text", "split")
    feats = features(rows, arrays)
    forget(chunks.sparkSession)
    near = cut_lineage(candidates(feats, common_shingles(feats)))
    members = cut_lineage(feats.select("chunk_id", "is_eval", "h").distinct())
    del feats
    forget(chunks.sparkSession)
    ends = _checked(near.select(F.col("e").alias("h")).unionByName(near.select(F.col("t").alias("h"))).distinct())
    ids = _checked(members.join(ends, "h").groupBy("h").agg(F.min("chunk_id").alias("chunk_id")))
    texts = boilerplate.strip(chunks.select("chunk_id", "source_dataset", "text").join(ids, "chunk_id"), arrays)
    words = cut_lineage(texts.select("h", "text").mapInArrow(_words, "h long, words string").groupBy("h").agg(F.any_value("words").alias("words")))
    side = lambda name: words.select(F.col("h").alias(name), F.col("words").alias("w" + name))
    pairs = near.join(side("e"), "e").join(side("t"), "t").withColumn("v", _verify("we", "wt")).select("e", "t", "v.jaccard", "v.kept")
    return members, pairs.where(F.col("kept") >= KEEP)


def _links(chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, near, links): links (e, t) of evaluation and training classes, near ones and, where a class has both sides, the class itself."""
    members, near = linked_classes(chunks)
    both = members.groupBy("h").agg(F.max("is_eval").alias("x"), F.min("is_eval").alias("y")).where("x and not y")
    return members, near, cut_lineage(near.select("e", "t").unionByName(both.select(F.col("h").alias("e"), F.col("h").alias("t"))))


def _small(df: DataFrame, numbers: int) -> DataFrame:
    """``df`` to be broadcast while it holds at most ``numbers`` longs."""
    return F.broadcast(df) if numbers <= 4 * BROADCAST_ROWS else df


def overlaps(chunks: DataFrame, representatives: int = REPRESENTATIVES) -> DataFrame:
    """p2_found: (chunk_id_1, chunk_id_2) of every evaluation chunk and training chunk with the same or almost the same text.

    A group of exact copies is represented by its first ``representatives`` chunk_ids on either
    side; every member is paired with all representatives of the groups that its own is linked
    with. So pairs are complete where either group is no larger than that, and grow with the
    members, not with their square, beyond; ``class_members`` gives the groups.
    """
    members, _, links = _links(chunks)
    ends = _checked(links.select(F.col("e").alias("h")).unionByName(links.select(F.col("t").alias("h"))).distinct())
    linked = cut_lineage(members.join(ends, "h"))
    first = F.row_number().over(W.partitionBy("h", "is_eval").orderBy("chunk_id"))  # the limit is applied before the shuffle
    reps = linked.withColumn("k", first).where(F.col("k") <= representatives).groupBy("h", "is_eval").agg(F.collect_list("chunk_id").alias("reps"))
    of = lambda flag, name: reps.where(flag).select(F.col("h").alias(name), F.col("reps").alias("r" + name))
    wide = cut_lineage(links.join(of("is_eval", "e"), "e").join(of("not is_eval", "t"), "t"))
    size = wide.agg(F.coalesce(F.sum(F.size("re") + F.size("rt") + 2), F.lit(0)).alias("n")).first().n
    x = linked.where("is_eval").select(F.col("h").alias("e"), F.col("chunk_id").alias("x"))
    y = linked.where("not is_eval").select(F.col("h").alias("t"), F.col("chunk_id").alias("y"))
    rows = x.join(_small(wide.select("e", "rt"), size), "e").select("x", F.explode("rt").alias("y"))
    beyond = y.join(_small(wide.select("t", "re", "rt"), size), "t").where(~F.array_contains("rt", F.col("y"))).select(F.explode("re").alias("x"), "y")
    return rows.unionByName(beyond).where("x <> y").select(F.least("x", "y").alias("chunk_id_1"), F.greatest("x", "y").alias("chunk_id_2")).distinct()


def class_members(chunks: DataFrame) -> DataFrame:
    """(chunk_id, split_side, class_id, n_links): every chunk that has an overlap, its group of exact copies and the chunks of the other side it is linked with."""
    members, _, links = _links(chunks)
    n = cut_lineage(members.groupBy("h").agg(F.min("chunk_id").alias("class_id"), F.count_if("is_eval").alias("n_eval"), F.count_if(~F.col("is_eval")).alias("n_train")))
    of = lambda own, other, count: links.join(n.select(F.col("h").alias(other), count), other).groupBy(F.col(own).alias("h")).agg(F.sum(count).alias("n_links"))
    sums = of("e", "t", "n_train").withColumn("is_eval", F.lit(True)).unionByName(of("t", "e", "n_eval").withColumn("is_eval", F.lit(False)))
    per = _checked(sums.join(n.select("h", "class_id"), "h"))
    return members.join(per, ["h", "is_eval"]).select(
        "chunk_id", F.when(F.col("is_eval"), "evaluation").otherwise("train").alias("split_side"), "class_id", "n_links")


def report(chunks: DataFrame) -> DataFrame:
    """Per split and source_dataset of the evaluation chunks: chunks with an equal or near text in train, without expanding pairs."""
    members, pairs = linked_classes(chunks)
    exact = members.where("not is_eval").select("h").distinct().withColumn("exact", F.lit(1))
    near = pairs.select(F.col("e").alias("h")).distinct().withColumn("near", F.lit(1))
    hit = members.where("is_eval").join(exact, "h", "left").join(near, "h", "left").where("exact = 1 or near = 1").select("chunk_id", "exact", "near")
    where = chunks.select("chunk_id", "split", "source_dataset").distinct()
    return hit.join(where, "chunk_id").groupBy("split", "source_dataset").agg(
        F.count("*").alias("n_chunks"), F.count("exact").alias("n_exact"), F.count("near").alias("n_near"))
