"""Problem 7: the language of each text and of each stretch in another language.

Cross-parsing: one suffix automaton is built over running labelled text of all languages,
with the languages of each state, so that one walk over a segment yields its longest match
with every language ending at every letter. From these lengths the segment is parsed into
longest phrases, across word borders, and the language that needs the fewest phrases a word
wins. The confidence is the winner's relative saving of phrases against the next language.

Training takes at most PER_LABEL labelled texts of each label, DEFAULTS unlabelled ones (both
chosen by hash, up to MAX_TRAIN_CHARS each), and CHARS characters of each language, TOTAL_CHARS
of all. Labels are partly wrong, so every training segment is parsed with the other half
of the texts: a label whose segments the other languages explain nearly as well (less than
FOREIGN times the phrases) is no language of its own, the one needed least first, and a segment
teaches the language that most of its text is in. A label needs texts in both halves, two at least.

Null, blank and wordless texts get no language. Rows delivered again count once. Labels in
two- or three-letter codes, with region, or as English names are the same; null, empty and
unknown labels state nothing. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from . import boilerplate, quality

PER_LABEL, DEFAULTS, MAX_TRAIN_CHARS = 300, 900, 8_000
CHARS, TOTAL_CHARS = 30_000, 300_000  # running text of one language, and of all, in the automaton
OWN = 0.5                   # relative frequency of a language's strings against the language that uses them most
FIRST_LONGEST = 5           # letters of the longest phrase while training: short strings are frequent enough to tell own from foreign ones
FOLD = 0.5                  # part of these in the automata that training parses with
FOREIGN = 1.12              # phrases without a label's own text over those with it, below which it is no language
CLEAR, SLACK = 0.15, 1.35   # confidence from which a segment counts for its text's main language; phrases, against the best language, with which it teaches that one
LETTERS, BLOCKS = 120, 24   # most frequent letters with a column of their own in the tables, and columns that all others share
LONGEST = 250               # letters of the longest phrase
DEFAULT = "en"
SHARE = 0.25                # a text is written in every language with at least this share of its words
SEGMENT_WORDS = 24          # longer segments are cut
WEAK, WEAK_WORDS = 0.15, 3  # confidence and words below which a segment follows its neighbours

# Three-letter codes and English names of languages, by two-letter code.
SPELLINGS = {
    "en": "eng english", "de": "deu ger german", "fr": "fra fre french", "es": "spa spanish", "it": "ita italian",
    "nl": "nld dut dutch", "pt": "por portuguese", "ru": "rus russian", "ro": "ron rum romanian", "da": "dan danish",
    "ca": "cat catalan", "sv": "swe swedish", "no": "nor norwegian", "fi": "fin finnish", "pl": "pol polish",
    "cs": "ces cze czech", "el": "ell gre greek", "tr": "tur turkish", "uk": "ukr ukrainian", "hu": "hun hungarian",
    "bg": "bul bulgarian", "hr": "hrv croatian", "sk": "slk slovak", "sl": "slv slovenian", "ar": "ara arabic",
    "he": "heb hebrew", "hi": "hin hindi", "ja": "jpn japanese", "ko": "kor korean", "zh": "zho chi chinese",
    "la": "lat latin", "et": "est estonian", "lv": "lav latvian", "lt": "lit lithuanian", "vi": "vie vietnamese",
}

WORD = quality.WORD
SEGMENT = re.compile(r"[.!?…]+[\"'”’»)]*\s+|\n\s*\n|\n(?=[«„“\"])")


def language_code(c):
    """Two-letter code of a label in any spelling; null for labels that name no language."""
    base = F.regexp_extract(F.lower(F.trim(c)), r"^([a-z]+)(?:[-_][a-z0-9]+)*$", 1)
    out = F.when(base.isin(list(SPELLINGS)), base)
    for code, names in SPELLINGS.items():
        out = out.when(base.isin(names.split()), code)
    return out


def stated(log: DataFrame) -> DataFrame:
    """(chunk_id, stated): the latest label of each chunk in the log; ties in time take the greater label."""
    last = F.max(F.struct("logged_at", F.coalesce("language", F.lit("")).alias("language")))["language"]
    return log.where("chunk_id is not null").groupBy("chunk_id").agg(last.alias("label")).select("chunk_id", language_code(F.col("label")).alias("stated"))


def _children(order_key: np.ndarray, parents: np.ndarray, order: np.ndarray) -> np.ndarray:
    """All states whose link is among ``parents``; ``order`` sorts the states by link."""
    lo, hi = np.searchsorted(order_key, parents, "left"), np.searchsorted(order_key, parents, "right")
    n = hi - lo
    return order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _levels(link: np.ndarray) -> list[np.ndarray]:
    """The states of a suffix automaton by their depth in the tree of links, root first."""
    order = np.argsort(link, kind="stable")
    key = link[order]
    out, level = [], np.array([0])
    while len(level):
        out.append(level)
        level = _children(key, level, order)
    return out


class Automaton:
    """Suffix automaton of the running texts of several languages.

    A string belongs to a language where it is at least ``own`` times as frequent as in any
    other (counts less two deviations), so that a few foreign segments teach nothing.
    """

    def __init__(self, samples: dict[str, list[str]], own: float = OWN):
        self.languages = sorted(samples)
        letters = Counter(chain.from_iterable(t for ts in samples.values() for t in ts))
        self.alphabet = "".join(sorted(c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]))
        self.blocks = BLOCKS if len(letters) > LETTERS else 0  # the other letters go by their place in Unicode
        code = {c: len(self.alphabet) + 1 + (ord(c) >> 7) % BLOCKS for c in letters} | {c: i + 1 for i, c in enumerate(self.alphabet)}
        go: list[dict] = [{}]
        link, length = [-1], [0]
        ends, per = [], []
        for language in self.languages:
            per.append(sum(map(len, samples[language])))
            for text in samples[language]:
                last = 0
                for ch in text:
                    c = code[ch]
                    p, q = last, go[last].get(c)
                    if q is None:
                        cur = len(go)
                        go.append({})
                        link.append(0)
                        length.append(length[last] + 1)
                        while p >= 0 and c not in go[p]:
                            go[p][c] = cur
                            p = link[p]
                        q = go[p][c] if p >= 0 else None
                    else:  # this text has been read before up to here
                        cur = None
                    if q is not None and length[q] != length[p] + 1:
                        twin = len(go)
                        go.append(dict(go[q]))
                        link.append(link[q])
                        length.append(length[p] + 1)
                        while p >= 0 and go[p].get(c) == q:
                            go[p][c] = twin
                            p = link[p]
                        link[q] = twin
                        q = twin
                    if cur is None:
                        cur = q
                    elif q is not None:
                        link[cur] = q
                    last = cur
                    ends.append(last)
        self.link = np.array(link, dtype=np.int32)
        self.length = np.array(length, dtype=np.int32)
        count = np.zeros((len(go), len(per)), dtype=np.float32)  # occurrences of each state's strings
        np.add.at(count, (np.array(ends, dtype=np.int64), np.repeat(np.arange(len(per)), per)), 1)
        for level in _levels(self.link)[:0:-1]:
            np.add.at(count, self.link[level], count[level])
        total = np.maximum(np.array(per, dtype=np.float32), 1)
        sure = ((count - 2 * np.sqrt(count)) / total).max(axis=1, keepdims=True) if len(per) else count
        held = (count > 0) & (count / total >= own * sure)
        self.mark = (held.astype(np.uint64) << np.arange(len(per), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        n = np.fromiter(map(len, go), dtype=np.int64, count=len(go))
        self.edge_from = np.repeat(np.arange(len(go), dtype=np.int32), n)
        self.edge_code = np.fromiter((c for g in go for c in g), dtype=np.uint8, count=int(n.sum()))
        self.edge_to = np.fromiter((t for g in go for t in g.values()), dtype=np.int32, count=int(n.sum()))


class Parser:
    """Phrase counts of segments under every language, from dense tables of an automaton.

    ``move`` leads from a state and a letter to the state of the longest suffix that occurs;
    ``keep`` is how much of the match before that letter is kept; ``longest`` is, for each
    state and language, the longest suffix of the state that occurs in the language.
    """

    def __init__(self, a: Automaton, longest: int = LONGEST):
        self.languages, k = a.languages, len(a.languages)
        self.letters = len(a.alphabet) + 1 + a.blocks
        self.code = np.zeros(0x110000, dtype=np.uint8)
        if a.blocks:
            self.code[:] = len(a.alphabet) + 1 + (np.arange(0x110000) >> 7) % a.blocks
        for i, c in enumerate(a.alphabet):
            self.code[ord(c)] = i + 1
        size = len(a.link)
        length = np.minimum(a.length, LONGEST).astype(np.uint8)
        levels = _levels(a.link)
        depth = np.zeros(size, dtype=np.int32)
        for d, level in enumerate(levels):
            depth[level] = d
        by = np.argsort(depth[a.edge_from], kind="stable")
        cut = np.searchsorted(depth[a.edge_from][by], np.arange(len(levels) + 1))
        self.move = np.zeros((size, self.letters), dtype=np.int32)
        self.keep = np.zeros((size, self.letters), dtype=np.uint8)
        self.longest = np.zeros((size, k), dtype=np.uint8)
        bits = np.uint64(1) << np.arange(k, dtype=np.uint64)
        for d, level in enumerate(levels):
            if d:
                up = a.link[level]
                self.move[level], self.keep[level], self.longest[level] = self.move[up], self.keep[up], self.longest[up]
            e = by[cut[d]:cut[d + 1]]
            self.move[a.edge_from[e], a.edge_code[e]] = a.edge_to[e]
            self.keep[a.edge_from[e], a.edge_code[e]] = length[a.edge_from[e]]
            own = (a.mark[level][:, None] & bits) > 0
            self.longest[level] = np.where(own, length[level][:, None], self.longest[level])
        np.minimum(self.longest, longest, out=self.longest)

    def matches(self, codes: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(letters x languages) length of the longest match that ends at each letter; all segments take a step at once."""
        order = np.argsort(-n, kind="stable")
        start, n = start[order], n[order]
        state, had = np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.uint8)
        states, lengths = np.zeros(len(codes), dtype=np.int32), np.zeros(len(codes), dtype=np.uint8)
        move, keep = self.move.ravel(), self.keep.ravel()
        active = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), "left")  # segments longer than t
        for t, k in enumerate(active.tolist()):
            at = start[:k] + t
            spot = state[:k] * self.letters + codes[at]
            to = move[spot]
            m = np.minimum(had[:k], keep[spot])
            m += np.uint8(1)
            m *= to > 0
            state[:k], had[:k] = to, m
            states[at], lengths[at] = to, m
        return np.minimum(self.longest[states], lengths[:, None])

    def phrases(self, segments: list[str]) -> np.ndarray:
        """(segments x languages) least number of phrases; a letter that a language never has is a phrase."""
        k = len(self.languages)
        n = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        raw = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = self.code[raw]
        start = np.cumsum(n) - n
        match = np.maximum(self.matches(codes, start, n), 1)
        count = np.zeros((len(n), k), dtype=np.int32)
        some = np.flatnonzero(n > 0).astype(np.int32)
        begin, last = start[some].astype(np.int32), (start + n)[some].astype(np.int32) - 1
        for x in range(k):  # from the end of all segments at once, a phrase a step
            step = np.ascontiguousarray(match[:, x])
            lane, first, at, taken = some, begin, last, 0
            while len(lane):
                taken += 1
                at = at - step.take(at)
                on = np.flatnonzero(at >= first)
                if len(on) < len(lane):
                    count[lane, x] = taken  # those that go on are counted again
                    lane, first, at = lane.take(on), first.take(on), at.take(on)
        return count


def segments(text: str) -> list[list[str]]:
    """Words of each sentence-like segment, long ones cut."""
    out = []
    for part in SEGMENT.split(text.lower()):
        words = WORD.findall(part)
        if len(words) > SEGMENT_WORDS:
            k = -(-len(words) // SEGMENT_WORDS)
            step = -(-len(words) // k)
            out.extend(words[i:i + step] for i in range(0, len(words), step))
        elif words:
            out.append(words)
    return out


def placed_segments(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of each of ``segments``, by its place in the text."""
    out, at = [], 0
    for end, after in [*((m.start(), m.end()) for m in SEGMENT.finditer(text)), (len(text), len(text))]:
        words = list(WORD.finditer(text, at, end))
        if words:
            k = -(-len(words) // SEGMENT_WORDS)
            step = -(-len(words) // k)
            for i in range(0, len(words), step):
                some = words[i:i + step]
                out.append((some[0].start(), some[-1].end(), [w.group().lower() for w in some]))
        at = after
    return out


def running(words: list[str]) -> str:
    return f" {' '.join(words)} "


def scores(parser: Parser, flat: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes in words, phrases a word of every language, confidence of the best) of segments."""
    sizes = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
    total = parser.phrases([running(w) for w in flat]) / np.maximum(sizes, 1)[:, None]
    if total.shape[1] > 1 and len(flat):
        two = np.partition(total, 1, axis=1)
        return sizes, total, (two[:, 1] - two[:, 0]) / two[:, 1]
    return sizes, total, np.ones(len(flat))


def parse(parser: Parser, owner: np.ndarray, flat: list[list[str]]):
    """(sizes, language index, confidence) of segments; ``owner`` tells their texts, in order."""
    sizes, total, sure = scores(parser, flat)
    best = total.argmin(axis=1) if len(flat) else np.zeros(0, dtype=np.int64)
    # short or undecided segments follow the segment before them in the same text, else the one after
    weak = (sure < WEAK) | (sizes < WEAK_WORDS)
    idx = np.where(~weak, np.arange(len(best)), -1)
    before = np.maximum.accumulate(idx)
    before = np.where((before >= 0) & (owner[np.maximum(before, 0)] == owner), before, -1)
    rev = np.where(~weak, np.arange(len(best)), len(best))
    after = np.minimum.accumulate(rev[::-1])[::-1]
    after = np.where((after < len(best)) & (owner[np.minimum(after, len(best) - 1)] == owner), after, -1)
    return sizes, best[np.where(before >= 0, before, np.where(after >= 0, after, np.arange(len(best))))], sure


def _filled(by: dict[str, list[list[str]]], part: float) -> dict[str, list[str]]:
    """Running text of each language up to its bound, whole segments from all over its texts, so that no few of them decide."""
    most = part * min(CHARS, TOTAL_CHARS / max(1, len(by)))
    out = {}
    for x, segs in by.items():
        taken, kept = 0, []
        step = max(1, int(sum(len(w) + 1 for s in segs for w in s) / most))
        for s in map(running, chain.from_iterable(segs[i::step] for i in range(step))):
            if taken + len(s) > most:
                break
            kept.append(s)
            taken += len(s)
        if kept:
            out[x] = kept
    return out


def train(rows: list[tuple[str, str]]) -> Automaton:
    """The automaton from (label, text) rows whose labels are partly wrong."""
    place: dict[str, int] = defaultdict(int)
    labels, folds, texts, flat = [], [], [], []
    for i, (label, text) in enumerate(rows):
        place[label] += 1
        for s in segments(text):
            labels.append(label)
            folds.append(place[label] % 2)
            texts.append(i)
            flat.append(s)
    names = sorted({x for x, n in place.items() if n > 1})
    if not names:
        return Automaton({DEFAULT: [" the "]})
    labels, folds = np.array(labels, dtype=object), np.array(folds)

    def crossed(of: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(segments x names) phrases a word under the texts of the other half that ``of`` gives to each name; and sizes."""
        out, sizes = np.full((len(flat), len(names)), np.inf), np.zeros(len(flat), dtype=np.int64)
        for fold in (0, 1):
            by: dict[str, list] = {x: [] for x in names}
            for i in np.flatnonzero(folds != fold):
                if of[i] in by:
                    by[of[i]].append(flat[i])
            sample = _filled(by, FOLD)
            mine = np.flatnonzero(folds == fold)
            if sample and len(mine):
                parser = Parser(Automaton(sample), longest)
                sizes[mine], total, _ = scores(parser, [flat[i] for i in mine])
                out[np.ix_(mine, [names.index(x) for x in parser.languages])] = total
        return out, sizes

    cost, sizes = crossed(labels, FIRST_LONGEST)
    live = list(range(len(names)))
    own = {j: np.flatnonzero(labels == x) for j, x in enumerate(names)}

    def needed(j: int) -> float:
        """Phrases of a label's segments without its own text over those with it."""
        rest = [i for i in live if i != j]
        with_it = (cost[np.ix_(own[j], live)].min(axis=1) * sizes[own[j]]).sum()
        without = (cost[np.ix_(own[j], rest)].min(axis=1) * sizes[own[j]]).sum()
        return without / with_it if np.isfinite(with_it) and with_it else 0.0  # a half may have no text of the label

    while others := [j for j in live if names[j] != DEFAULT and len(live) > 1 and len(own[j])]:
        # two labels on one language explain each other: the one that is needed least goes, which is the mixed one, and then the other is needed
        least, j = min((needed(j), j) for j in others)
        if least >= FOREIGN:
            break
        live = [i for i in live if i != j]
    names = [names[j] for j in live]
    texts = np.array(texts)
    cost = cost[:, live]
    for again in (True, False):  # the texts' main languages, then once more with the automata these give
        best = cost.argmin(axis=1)
        words = np.zeros((len(rows), len(names)))
        clear = cost.min(axis=1) < (1 - CLEAR) * np.partition(cost, 1, axis=1)[:, 1] if len(names) > 1 else np.ones(len(flat), dtype=bool)
        np.add.at(words, (texts[clear], best[clear]), sizes[clear])
        main = words.argmax(axis=1)[texts]
        teaches = (words.max(axis=1) >= 0.5 * np.maximum(words.sum(axis=1), 1))[texts] & (cost[np.arange(len(flat)), main] <= SLACK * cost.min(axis=1))
        labels = np.array([names[x] if t else None for x, t in zip(main, teaches)], dtype=object)
        if again:
            cost, sizes = crossed(labels, FIRST_LONGEST)
    by: dict[str, list] = {x: [] for x in names}
    for x, s in zip(labels, flat):
        if x is not None:
            by[x].append(s)
    return Automaton(_filled(by, 1.0) or {DEFAULT: [" the "]})


def training_rows(chunks: DataFrame, log: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample, prose only: at most PER_LABEL rows of each label of SPELLINGS and DEFAULTS others, of at most MAX_TRAIN_CHARS characters each."""
    labels = stated(log)
    fits = F.col("text").isNotNull() & (F.length("text") <= MAX_TRAIN_CHARS)
    order = F.xxhash64("chunk_id")
    # ids are chosen first, so that no text is shuffled for it; the limit per label is applied before the shuffle
    rank = F.row_number().over(W.partitionBy("stated").orderBy(order, "chunk_id"))
    known = labels.where("stated is not null").withColumn("k", rank).where(F.col("k") <= PER_LABEL).drop("k")
    other = chunks.where(fits).select("chunk_id").join(labels, "chunk_id", "left_anti").distinct().orderBy(order, "chunk_id").limit(DEFAULTS)
    picked = known.unionByName(other.withColumn("stated", F.lit(DEFAULT)))
    some = chunks.where(fits).select("chunk_id", "text").join(F.broadcast(picked), "chunk_id").select(order.alias("o"), "chunk_id", "stated", "text").collect()
    rows = {(r.o, r.chunk_id): (r.stated, r.text) for r in some}
    return [(label, text) for _, (label, text) in sorted(rows.items()) if not quality.is_other(text)]


def _broadcast(chunks: DataFrame, log: DataFrame):
    """(broadcast automaton of at most 2 x TOTAL_CHARS states, its languages)."""
    automaton = train(training_rows(chunks, log))
    return chunks.sparkSession.sparkContext.broadcast(_Shared(automaton)), automaton.languages


class _Shared:
    """An automaton with a name of its own, so that a worker knows which tables it has built."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.key = automaton, hash((automaton.link.tobytes(), automaton.edge_to.tobytes()))


_parsers: dict[int, Parser] = {}


def _tables(shared: _Shared) -> Parser:
    if shared.key not in _parsers:
        _parsers.clear()
        _parsers[shared.key] = Parser(shared.automaton)
    return _parsers[shared.key]


def _partial(bc, langs):
    def run(batches):
        parser = _tables(bc.value)
        for b in quality.portions(batches):
            d = b.to_pydict()
            owner, flat = [], []
            for i, t in enumerate(d["text"]):
                own = segments(t)
                owner.extend([i] * len(own))
                flat.extend(own)
            owner = np.array(owner, dtype=np.int64)
            sizes, lang, sure = parse(parser, owner, flat)
            n, k = len(d["text"]), len(langs)
            words = np.zeros((n, k), dtype=np.int64)
            np.add.at(words, (owner, lang), sizes)
            weight = np.zeros((n, k))
            np.add.at(weight, (owner, lang), sizes * sure)
            yield pa.RecordBatch.from_arrays(
                [b.column("chunk_id"), b.column("piece"), *quality.partial_arrays(d, True),
                 pa.array(words.tolist(), pa.list_(pa.int64())), pa.array(weight.tolist(), pa.list_(pa.float64()))],
                names=["chunk_id", "piece", "totals", "head", "tail", "through", "words", "weight"])

    return run


def labelled(chunks: DataFrame, log: DataFrame) -> DataFrame:
    """Rows (chunk_id, verdict, language, share, confidence): every language with a share of the chunk's words."""
    arrays = boilerplate.node_arrays(boilerplate.nodes(chunks))
    bc, langs = _broadcast(chunks, log)
    parts = quality.pieces(chunks, arrays).mapInArrow(_partial(bc, langs), quality.PARTIAL + ", words array<long>, weight array<double>")
    whole = quality.merge(parts, words=len(langs), weight=len(langs))
    total = sum(F.col(f"words{i}") for i in range(len(langs)))
    rows = F.array(*[F.struct(F.lit(x).alias("language"), F.col(f"words{i}").alias("w"), F.col(f"weight{i}").alias("c")) for i, x in enumerate(langs)])
    verdicts = quality.verdict(whole.select("chunk_id", *quality.Counts.NAMES, total.alias("all_words"), rows.alias("rows")), "all_words", "rows")
    return verdicts.where("all_words > 0").select("chunk_id", "verdict", "all_words", F.explode(F.filter("rows", lambda r: r["w"] > 0)).alias("r")).select(
        "chunk_id", "verdict", "r.language", (F.col("r.w") / F.col("all_words")).alias("share"), (F.col("r.c") / F.col("r.w")).alias("confidence"))


def unstated(chunks: DataFrame, log: DataFrame) -> DataFrame:
    """p7_found: (chunk_id, language) written in but not stated; texts that are no prose are no case."""
    said = stated(log).withColumn("logged", F.lit(True))
    written = labelled(chunks, log).where((F.col("verdict") == "prose") & (F.col("share") >= SHARE))
    both = written.join(said, "chunk_id", "left")
    claim = F.when(F.col("logged"), F.col("stated")).otherwise(F.lit(DEFAULT))
    return both.where(~F.col("language").eqNullSafe(claim)).select("chunk_id", "language")


def stretches(chunks: DataFrame, log: DataFrame) -> DataFrame:
    """(chunk_id, piece, segment_no, start_char, end_char, n_words, language, confidence) of every run of segments in one language.

    Characters are counted in the text without boilerplate lines (p4_clean); a run ends at the end of a piece of a very long text.
    """
    arrays = boilerplate.node_arrays(boilerplate.nodes(chunks))
    bc, langs = _broadcast(chunks, log)

    def run(batches):
        parser = _tables(bc.value)
        for b in quality.portions(batches):
            ids, pcs, begin = (b.column(c).to_pylist() for c in ("chunk_id", "piece", "start"))
            rows = [(i, *s) for i, t in enumerate(b.column("text").to_pylist()) for s in placed_segments(t)]
            if not rows:
                continue
            owner = np.array([r[0] for r in rows], dtype=np.int64)
            first, end = (np.array([r[c] + begin[r[0]] for r in rows], dtype=np.int64) for c in (1, 2))
            sizes, lang, sure = parse(parser, owner, [r[3] for r in rows])
            at = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (lang[1:] != lang[:-1])]))
            stop = np.append(at[1:], len(owner)) - 1
            n = np.add.reduceat(sizes, at)
            conf = np.add.reduceat(sizes * sure, at) / n
            own = owner[at]
            head = np.concatenate([[True], own[1:] != own[:-1]])
            no = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0)) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in own], pa.int64()), pa.array([pcs[i] for i in own], pa.int32()), pa.array(no, pa.int32()),
                pa.array(first[at], pa.int64()), pa.array(end[stop], pa.int64()), pa.array(n, pa.int64()), pa.array([langs[x] for x in lang[at]]), pa.array(conf, pa.float64())],
                names=["chunk_id", "piece", "segment_no", "start_char", "end_char", "n_words", "language", "confidence"])

    return quality.pieces(chunks, arrays).mapInArrow(run, "chunk_id long, piece int, segment_no int, start_char long, end_char long, n_words long, language string, confidence double").distinct()
