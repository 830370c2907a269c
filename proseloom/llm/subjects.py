"""Problem 10: the subject areas of each document.

Complement naive Bayes: a word's weight for a subject is the log of its share among the
subject's words over its share among all other words (the complement). The weights are first
taken from the labelled documents, then refined by expectation-maximization over all documents:
a pass gives every sentence the posterior of each subject, the expected word counts are
summed over the whole corpus, and new weights follow from them, until they hardly change. A
sentence's posterior is drawn by the document's own share of the subject, itself estimated by
EM over its sentences, so that one word in passing makes no subject. Each subject has its own
posterior; a sentence may be about two. A fifth of the labelled documents, chosen by hash,
stays out of the training and calibrates the subjects' document posteriors: logistic curves of
the share, one for each subject, drawn towards that of all subjects.

A document gets every subject that at least a quarter of its sentences is about: none, one
or several. Null, blank and wordless texts get none. Repeated labels count once; a wrong
label is outvoted. Rows delivered again give the same result once. Without labels the result
is empty.

Words are 64-bit hashes from the first step on. Bounds: the weights sent to the workers are
those of the TOP words of each subject and what the FREQUENT most frequent words say against
subjects. All labels train or calibrate, and the counts cover all documents.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage
from . import quality

SHARE = 0.25
HELD_OUT = 5           # every so many labelled documents calibrate instead of training
TOP, BUCKETS = 2_000, 64  # words of a subject that keep a weight; parts of the vocabulary that are ranked apart first
ROUNDS, TOLERANCE = 6, 0.05  # most EM passes over all documents; mean change of the weights, against their mean, at which they end
LEAST_WEIGHT = 1.8     # weights below carry no sign of a subject
FREQUENT = 3_000       # most frequent words that may speak against a subject
AGAINST, CAP_AGAINST, AGAINST_COUNT = -1.0, 1.5, 20
LEAST_DOCS, LEAST_PART = 2, 0.01  # labelled documents of a subject, and part of all of these, that a first sign stands in
LEAST_COUNT = 4.0      # expected occurrences in a subject's sentences below which a word gets no weight
CAP = 5.0              # most that one word can say
PRIOR, STRENGTH = 0.01, 20.0  # share of a subject expected beforehand, and its weight in sentences
MAX_SUBJECTS = 1_000
BINS, DRAWN = 40, 4.0  # of the share in calibration; weight of the curve of all subjects
BROADCAST_LABELS = 500_000

SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»)]*\s+|\n\s*\n")
WORD = quality.WORD


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence of at least two words."""
    return [w for part in SENTENCE.split(text.lower()) if len(w := WORD.findall(part)) > 1]


TOKENS = "doc_id long, words array<long>, sizes array<int>"


def _tokens(batches):
    for b in quality.portions(batches):
        ids, words, sizes, ends = [], [], [], [0]
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            own = sentences(t)
            if own:
                ids.append(i)
                sizes.append([len(s) for s in own])
                for s in own:
                    words.extend(s)
                ends.append(len(words))
        if ids:
            codes, names = pd.factorize(np.array(words, dtype=object))
            flat = pd.util.hash_array(names).view(np.int64)[codes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(sizes, pa.list_(pa.int32()))], names=["doc_id", "words", "sizes"])


def tokens(docs: DataFrame) -> DataFrame:
    """Word hashes of each document, and the sizes of its sentences; materialised, as every pass reads them."""
    return cut_lineage(docs.where("text is not null").select("doc_id", "text").mapInArrow(_tokens, TOKENS))


class Batch:
    """Arrays of a batch of ``tokens``: ids, document of each sentence, sentence sizes and starts, word codes, distinct words."""

    def __init__(self, b: pa.RecordBatch):
        sizes = b.column("sizes")
        self.ids = np.asarray(b.column("doc_id"))
        self.n = np.asarray(sizes.value_lengths()).astype(np.int64)
        self.sizes = np.asarray(sizes.flatten()).astype(np.int64)
        self.heads = np.cumsum(self.n) - self.n
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.codes, self.words = pd.factorize(np.asarray(b.column("words").flatten()))


class Weights:
    """Rows of weights (words x subjects) by sorted word hash."""

    def __init__(self, rows: dict[int, np.ndarray], k: int):
        self.words = np.array(sorted(rows), dtype=np.int64)
        self.rows = np.array([rows[w] for w in self.words.tolist()]).reshape(len(rows), k)

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros((len(words), self.rows.shape[1]))
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return self.rows[at] * (self.words[at] == words)[:, None]

    def change(self, other: "Weights") -> float:
        """Mean difference of all weights of both, against the mean of this one's."""
        words = np.union1d(self.words, other.words)
        return float(np.abs(self.of(words) - other.of(words)).sum() / max(np.abs(self.rows).sum(), 1e-9))


def posteriors(weights: Weights, b: Batch, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """(sentences x subjects) posteriors, each subject for itself, and (words x subjects) weights of the batch."""
    table = weights.of(b.words)
    score = np.add.reduceat(table[b.codes], b.starts, axis=0)
    share = np.full((len(b.n), table.shape[1]), PRIOR)
    for _ in range(rounds):
        odds = np.log(share / (1 - share))
        p = np.where(score > 0, 1 / (1 + np.exp(-np.clip(score + odds[b.doc], -30, 60))), 0.0)
        share = np.clip((np.add.reduceat(p, b.heads, axis=0) + PRIOR * STRENGTH) / (b.n[:, None] + STRENGTH), 1e-6, 1 - 1e-6)
    return p, table


COUNTS = "word long, s int, c double, d long"


def _rows_of(words: np.ndarray, columns: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows (word, s, c, d) where c is above zero."""
    at = {s: np.flatnonzero(c > 0) for s, (c, _) in columns.items()}
    join = lambda parts, t: pa.array(np.concatenate(parts), t)
    return pa.RecordBatch.from_arrays([
        join([words[x] for x in at.values()], pa.int64()), join([np.full(len(x), s) for s, x in at.items()], pa.int32()),
        join([columns[s][0][x] for s, x in at.items()], pa.float64()), join([columns[s][1][x] for s, x in at.items()], pa.int64())], names=["word", "s", "c", "d"])


def _labelled(k: int):
    """Counts of all words (s = -1) and of those of each subject's documents, with the number of documents."""
    def run(batches):
        for raw in batches:
            b = Batch(raw)
            of_word = np.repeat(b.doc, b.sizes)
            total = np.bincount(b.codes, minlength=len(b.words)).astype(float)
            columns = {-1: (total, total.astype(np.int64))}
            subs = raw.column("subs").to_pylist()
            for s in sorted({x for own in subs for x in own}):
                on = np.array([s in own for own in subs])[of_word]
                c = np.bincount(b.codes[on], minlength=len(b.words)).astype(float)
                pairs = np.unique(b.codes[on].astype(np.int64) * len(b.n) + of_word[on]) // len(b.n)
                columns[s] = (c, np.bincount(pairs, minlength=len(b.words)))
            yield _rows_of(np.asarray(b.words), columns)
    return run


def _expected(bc):
    """Counts of all words (s = -1), and of each subject the counts expected in its sentences; d is not used."""
    def run(batches):
        for raw in batches:
            b = Batch(raw)
            p, table = posteriors(bc.value, b)
            zero = np.zeros(len(b.words), dtype=np.int64)
            columns = {-1: (np.bincount(b.codes, minlength=len(b.words)).astype(float), zero)}
            sent = np.repeat(np.arange(len(b.sizes)), b.sizes)
            signs = np.add.reduceat((table > 0)[b.codes].astype(np.int32), b.starts, axis=0)
            p = np.where(signs > 1, p, 0.0)  # one word alone teaches nothing
            for s in np.flatnonzero(p.any(axis=0)).tolist():
                at = (p[:, s] > TEACHES)[sent]
                columns[s] = (np.bincount(b.codes[at], p[sent[at], s], minlength=len(b.words)), zero)
            yield _rows_of(np.asarray(b.words), columns)
    return run


TEACHES = 0.05         # posteriors below are taken for none in the expected counts


def _weights(counts: DataFrame, k: int, docs: dict[int, int] | None = None) -> Weights:
    """Weights from counts (word, s, c, d): log share in the subject, less what few occurrences or documents prove, over log share elsewhere.

    With ``docs``, the labelled documents of each subject, a sign must stand in LEAST_DOCS and LEAST_PART of
    them: a few wrong labels, as on documents in a language that labels seldom cover, must not make
    that language's words signs. Else it must have LEAST_COUNT expected occurrences.
    """
    counts = cut_lineage(counts.groupBy("word", "s").agg(F.sum("c").alias("c"), F.sum("d").alias("d")))
    sums = {r.s: r for r in counts.groupBy("s").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()}  # a row per subject
    if -1 not in sums or len(sums) < 2:
        return Weights({}, k)
    n, v = sums[-1].c, sums[-1].v
    size = F.create_map(*[x for s, r in sums.items() for x in (F.lit(s), F.lit(float(r.c)))])
    total = counts.where("s = -1").select("word", F.col("c").alias("c0"))
    own = counts.where("s >= 0")
    if docs:
        of = F.create_map(*[x for s, n_docs in docs.items() for x in (F.lit(s), F.lit(max(LEAST_DOCS, LEAST_PART * n_docs)))])
        own = own.where(F.col("d") >= of[F.col("s")])
    else:
        own = own.where(F.col("c") >= LEAST_COUNT)
    low = F.col("c") * (1 - F.pow("d", F.lit(-0.5))) if docs else F.greatest(F.col("c") - F.sqrt("c"), F.lit(0.0))
    cs = size[F.col("s")]
    x = F.log((low + 0.5) / (cs + 0.5 * v)) - F.log((F.greatest(F.col("c0") - F.col("c"), F.lit(0.0)) + 0.5) / (n - cs + 0.5 * v))
    signs = own.join(total, "word").select("word", "s", x.alias("x")).where(F.col("x") >= LEAST_WEIGHT)
    # ranked in parts of the vocabulary, then the best of all parts
    part = F.row_number().over(W.partitionBy("s", F.pmod("word", F.lit(BUCKETS))).orderBy(F.desc("x"), "word"))
    rank = F.row_number().over(W.partitionBy("s").orderBy(F.desc("x"), "word"))
    top = signs.withColumn("k", part).where(F.col("k") <= TOP).withColumn("k", rank).where(F.col("k") <= TOP).select("word", "s", "x").collect()
    out: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(k))
    for r in top:
        out[r.word][r.s] = min(CAP, r.x)
    common = total.where(F.col("c0") >= AGAINST_COUNT).orderBy(F.desc("c0"), "word").limit(FREQUENT)
    rows = counts.where("s >= 0").join(F.broadcast(common), "word", "right").select("word", "c0", "s", "c").collect()  # at most FREQUENT words of each subject
    c0 = {r.word: r.c0 for r in rows}
    c = {(r.word, r.s): r.c for r in rows if r.s is not None}
    for word, all_ in c0.items():  # words that a subject avoids
        for s in range(k):
            if s in sums and out.get(word, np.zeros(k))[s] <= 0:
                have = c.get((word, s), 0.0)
                y = np.log((have + 0.5) / (sums[s].c + 0.5 * v)) - np.log((max(all_ - have, 0.0) + 0.5) / (n - sums[s].c + 0.5 * v))
                if y <= AGAINST:
                    out[word][s] = max(-CAP_AGAINST, y)
    return Weights(dict(out), k)


def _bins(bc, k: int):
    """(s, bin of the share, whether labelled) of every held-out document and subject, counted."""
    def run(batches):
        for raw in batches:
            b = Batch(raw)
            share = _shares(posteriors(bc.value, b)[0], b)
            at = np.minimum((share * BINS).astype(np.int64), BINS - 1)
            said = np.zeros(share.shape, dtype=np.int64)
            for i, own in enumerate(raw.column("subs").to_pylist()):
                said[i, own] = 1
            key = (np.arange(k)[None, :] * BINS + at) * 2 + said
            keys, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys // 2 // BINS, pa.int32()), pa.array(keys // 2 % BINS, pa.int32()), pa.array(keys % 2, pa.int32()), pa.array(n, pa.int64())], names=["s", "bin", "said", "n"])
    return run


def _shares(p: np.ndarray, b: Batch) -> np.ndarray:
    """(documents x subjects) share of the sentences that are about a subject."""
    return np.add.reduceat((p >= 0.5).astype(float), b.heads, axis=0) / b.n[:, None]


def _curve(x: np.ndarray, yes: np.ndarray, no: np.ndarray, drawn: np.ndarray, force: float) -> np.ndarray:
    """(slope, offset) of the logistic curve of counted outcomes, drawn towards a curve; Newton steps."""
    w = drawn.astype(float).copy()
    a = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (yes - (yes + no) * q) - force * (w - drawn)
        step = np.linalg.solve((a * ((yes + no) * q * (1 - q))[:, None]).T @ a + (force + 1e-6) * np.eye(2), grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrate(counts: list[tuple[int, int, int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(subjects x 2) curves and (subjects x BINS x 2) counts from rows (s, bin, said, n)."""
    table = np.zeros((k, BINS, 2))
    for s, i, said, n in counts:
        table[s, i, said] += n
    x = (np.arange(BINS) + 0.5) / BINS
    start = np.array([16.0, -16.0 * SHARE])  # without held-out labels: even odds at the share that makes a case
    pooled = _curve(x, table[:, :, 1].sum(axis=0), table[:, :, 0].sum(axis=0), start, 0.1)
    curves = [_curve(x, table[s, :, 1], table[s, :, 0], pooled, DRAWN) for s in range(k)]
    return np.array(curves).reshape(k, 2), table


def _posterior(curves: np.ndarray, share: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(share * curves[:, 0] + curves[:, 1], -30, 30)))


class Model:
    def __init__(self, names, weights, curves, table, passes, change):
        self.names, self.weights, self.curves, self.table, self.passes, self.change = names, weights, curves, table, passes, change


def fit(toks: DataFrame, subjects: DataFrame, labels: DataFrame) -> Model:
    """The model from the tokens of all documents and the labels of some."""
    names = [r.subject for r in subjects.where("subject is not null").select("subject").distinct().orderBy("subject").limit(MAX_SUBJECTS + 1).collect()]
    if len(names) > MAX_SUBJECTS:
        raise ValueError(f"more than {MAX_SUBJECTS} subjects")
    k = len(names)
    spark = toks.sparkSession
    number = F.create_map(*[x for i, s in enumerate(names) for x in (F.lit(s), F.lit(i))]) if names else F.create_map().cast("map<string,int>")
    said = labels.where("doc_id is not null").select("doc_id", F.try_element_at(number, F.col("subject")).alias("s"))
    said = cut_lineage(said.groupBy("doc_id").agg(F.sort_array(F.collect_set("s")).alias("subs")))
    known = cut_lineage(toks.join(F.broadcast(said) if said.count() <= BROADCAST_LABELS else said, "doc_id"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    train = known.where(~held)
    n_docs = {r.s: r.n for r in train.select("doc_id", F.explode("subs").alias("s")).groupBy("s").agg(F.count_distinct("doc_id").alias("n")).collect()}
    weights = _weights(train.mapInArrow(_labelled(k), COUNTS), k, n_docs) if n_docs else Weights({}, k)
    passes, change = 0, 0.0
    while len(weights.words) and passes < ROUNDS:
        bc = spark.sparkContext.broadcast(weights)
        new = _weights(toks.mapInArrow(_expected(bc), COUNTS), k)
        passes, change, weights = passes + 1, weights.change(new), new
        if change <= TOLERANCE:
            break
    bins = known.where(held).mapInArrow(_bins(spark.sparkContext.broadcast(weights), k), "s int, bin int, said int, n long")
    rows = bins.groupBy("s", "bin", "said").agg(F.sum("n").alias("n")).collect() if k else []  # at most 2 x BINS rows a subject
    curves, table = calibrate([tuple(r) for r in rows], k)
    return Model(names, weights, curves, table, passes, change)


def about(docs: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, subject, share, confidence): every subject with a part in a document; share of its sentences, calibrated posterior of the subject."""
    toks = tokens(docs)
    model = fit(toks, subjects, labels)
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = bc.value
        for raw in batches:
            b = Batch(raw)
            if not len(b.n) or not m.names:
                continue
            share = _shares(posteriors(m.weights, b)[0], b)
            d, s = np.nonzero(share)
            yield pa.RecordBatch.from_arrays([
                pa.array(b.ids[d], pa.int64()), pa.array([m.names[x] for x in s], pa.string()), pa.array(share[d, s]), pa.array(_posterior(m.curves, share)[d, s])],
                names=["doc_id", "subject", "share", "confidence"])

    return toks.mapInArrow(run, "doc_id long, subject string, share double, confidence double").distinct()


def calibration(docs: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    """(subject, n_held_out, n_labelled, expected, error, em_passes, last_change): of each subject the held-out documents, those labelled with it, those expected by the calibrated posteriors, and the mean gap between posterior and outcome over the bins of the share."""
    m = fit(tokens(docs), subjects, labels)
    x = (np.arange(BINS) + 0.5) / BINS
    rows = []
    for s, name in enumerate(m.names):
        yes, n = m.table[s, :, 1], m.table[s].sum(axis=1)
        q = 1 / (1 + np.exp(-np.clip(m.curves[s, 0] * x + m.curves[s, 1], -30, 30)))
        rows.append((name, int(n.sum()), int(yes.sum()), float((n * q).sum()), float(np.abs(yes - n * q).sum() / max(n.sum(), 1)), m.passes, m.change))
    return docs.sparkSession.createDataFrame(rows, "subject string, n_held_out long, n_labelled long, expected double, error double, em_passes int, last_change double")


def composition(docs: DataFrame, subjects: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents and their sources by subject."""
    found = about(docs, subjects, labels).where(F.col("share") >= SHARE)
    return found.join(docs.select("doc_id", "source").distinct(), "doc_id").groupBy("subject", "source").agg(F.count_distinct("doc_id").alias("n_docs"))
