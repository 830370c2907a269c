"""Problem 3: per-document text quality statistics and the verdict prose or not.

A long text is cut into pieces at line ends (inside a longer line at a space), each piece
gives additive counts of words, symbols, lines and common words, and the counts of a text
are summed by a two-level aggregation. A line that had to be cut leaves its raw line
features as boundary state at the piece's ends; they are joined before that line is judged.

Each line is judged prose, other or open from its features; open lines follow the larger
part of the text. A text is "other" when more than half of its characters are. Null and
blank texts are not judged (verdict null). Redelivered rows of a chunk_id count once.
Languages not among the common-word lists are prose unless digits, symbols, lists or
malformed words speak against it.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

PIECE = 65_536

# Common words of eight languages.
COMMON = {
    "en": "the a an of and to in is was it that he she his her with for as on at by had not but be they them your my this from which who were so no nor what when where there if",
    "de": "der die das und ein eine einen dem den des von im in mit nicht auf für sich ist es an zu bei vor neben unter war er sie seinen aber dann noch ohne",
    "fr": "le la les et un une des de du dans pour avec ne pas sur est que qui sa son ce cette à au près mais en par il elle derrière",
    "es": "el la los las y un una de del en con por que su no se al era pero para a lo como mientras aunque junto sin",
    "it": "il lo la gli le di del della dei che e un una in nel nella con per non sul si alla ma da suo sua al sotto",
    "nl": "de het een en van in op met niet voor aan was zijn haar dat die bij naar te maar ook toen tot zonder naast achter",
    "pt": "o a os as um uma de do da em no na com por que não se ao mas para seu sua era à dos das debaixo sem",
    "ru": "и в на не что с из за под для у к по от он она но как это перед после до рядом вместе потому когда хотя без свою свой эту",
}
ALL_COMMON = frozenset(w for ws in COMMON.values() for w in ws.split())
# Marks that belong to running text.
PLAIN_MARKS = ".,;:!?'\"-()…—–«»„“”‘’‹›¿¡"

WORD = re.compile(r"[^\W\d_]+")
WORD_OR_NUMBER = re.compile(r"[^\W_]+")
NUMBER = re.compile(r"\d+")
LEADER = re.compile(r"\.{4,}|(?:\. ){4,}|_{4,}")
LABEL = re.compile(r"^\W*[^\W\d_][\w' ]{0,30}:\s+\S")
SYMBOL = re.compile("[^\\w\\s" + re.escape(PLAIN_MARKS) + "]|_")
#: a letter beside a digit, or a capital after a small letter
INNER_CAPITAL = re.compile(r"[a-z][A-Z]")
BROKEN_WORD = re.compile(r"\d(?:[^\W\d_]|(?<=[^\W\d_]\d))|[A-Z](?<=[a-z][A-Z])")

# positions in a line's additive feature vector
CHARS, WORDS, LETTERS, COMMON_WORDS, NUMBERS, SYMBOLS, TOKENS, BROKEN, LONG, COMMAS, LEADERS, LABELS, ENDED = range(13)


LONG_TOKEN, LIST_COMMAS = 32, 0.45  # letters of an overlong token; commas a word in a list
NO_TRAITS = (False, False, False, False)
_marks: dict[str, int] = {}


def _mark(c: str) -> int:
    """1 for a digit, 2 for a symbol, else 0; remembered, as texts use few different characters."""
    m = _marks.get(c)
    if m is None:
        m = 1 if NUMBER.match(c) else 2 if SYMBOL.match(c) else 0
        if len(_marks) < 200_000:
            _marks[c] = m
    return m


def traits(text: str) -> tuple[bool, bool, bool, bool]:
    """Whether a text has numbers, symbols, malformed words and overlong tokens anywhere; its lines skip what it has not."""
    seen = set(map(_mark, set(text)))
    number, symbol = 1 in seen, 2 in seen
    broken = (BROKEN_WORD if number else INNER_CAPITAL).search(text) is not None
    return number, symbol, broken, max(map(len, text.split()), default=0) > LONG_TOKEN


def plainly_prose(text: str) -> bool:
    """Whether ``Counts.of`` would judge no line of a text other, found without the features of most lines.

    Lines without numbers, symbols, malformed words, overlong tokens and leaders are only other
    as comma lists or as labels. Every token of letters alone has a word, so a line with too few
    commas for those is no list; lines that may be either are judged. With no other characters
    at all the verdict is prose, however the lines fall between prose and open.
    """
    if any(map(_mark, set(text))) or ".." in text or ". ." in text or INNER_CAPITAL.search(text):
        return False
    for line in text.split("\n"):
        tokens = line.split()
        if tokens and max(map(len, tokens)) > LONG_TOKEN:
            return False
        commas = line.count(",")
        if commas > 1 and commas >= LIST_COMMAS * sum(map(str.isalpha, tokens)) or ":" in line and LABEL.match(line.strip()):
            if judge(line_features(line, NO_TRAITS)) == 1:
                return False
    return True


def is_other(text: str) -> bool:
    """The verdict of ``Counts.of`` on a whole text: more than half of its characters are no prose.

    Lines are judged from the longest down until neither side can be overtaken.
    """
    if plainly_prose(text):
        return False
    has = traits(text)
    lines = sorted((x for x in text.split("\n") if x.strip()), key=len, reverse=True)
    total = sum(map(len, lines)) + len(lines)
    other = prose = 0
    for line in lines:
        kind = judge(line_features(line, has))
        if kind == 1:
            other += len(line) + 1
            if other * 2 > total:
                return True
        elif kind == 0:
            prose += len(line) + 1
            if prose * 2 >= total:
                return False
    return other > prose  # the open lines follow the larger part, so it has more than half


def line_features(line: str, has: tuple = (True, True, True, True)) -> list[int]:
    s = line.strip()
    words = WORD.findall(s.lower())
    broken = long = n_tokens = 0
    if has[2] or has[3]:
        tokens = s.split()
        n_tokens = len(tokens)
        if has[3] and tokens and max(map(len, tokens)) > LONG_TOKEN:
            long = sum(len(t) for t in tokens if len(t) > LONG_TOKEN and (len(WORD.findall(t)) < 2 or not any(c in t for c in "-—….")))
        if has[2] and BROKEN_WORD.search(s):
            broken = sum(1 for t in tokens if BROKEN_WORD.search(t))
    return [
        len(line) + 1, len(words), sum(map(len, words)), sum(map(ALL_COMMON.__contains__, words)), len(NUMBER.findall(s)) if has[0] else 0,
        len(SYMBOL.findall(s)) if has[1] else 0, n_tokens, broken, long, s.count(","),
        len(LEADER.findall(s)) if ".." in s or ". ." in s or "__" in s else 0,
        1 if ":" in s and LABEL.match(s) else 0, 1 if s and s[-1] in ".!?…\"'”’»;,-—:" else 0,
    ]


def judge(f) -> int:
    """1 other, 0 prose, -1 open, from a line's summed features."""
    words, common, n = f[WORDS], f[COMMON_WORDS], f[CHARS]
    units = words + f[NUMBERS]
    if f[LONG] > 0.4 * n or f[LEADERS] or f[SYMBOLS] > 0.12 * n and units:
        return 1
    if f[TOKENS] >= 3 and f[BROKEN] > 0.35 * f[TOKENS]:
        return 1
    if f[SYMBOLS] > 0.6 * n:
        return -1
    share = common / words if words else 0.0
    if units >= 2 and f[NUMBERS] >= 0.2 * units and share < 0.34:
        return 1
    if words >= 4 and f[COMMAS] >= LIST_COMMAS * words and share <= 0.1:
        return 1
    if f[LABELS] and words <= 6 and common == 0:
        return 1
    if words >= 4 and share >= 0.12:
        return 0
    return -1


class Counts:
    """Additive counts of one piece, with the open lines at its two ends."""

    NAMES = ["n_chars", "n_words", "n_letters", "n_common", "n_symbols", "n_digits_runs", "n_lines", "n_ended", "other_chars", "prose_chars", "open_chars"]

    @staticmethod
    def of(text: str, cut_left: bool, cut_right: bool):
        """(totals, head, tail, through): head and tail are the features of lines cut at the piece's ends; through: the piece is the middle of one line."""
        totals = [0] * 11
        lines = text.split("\n")
        head = tail = None
        last = len(lines) - 1
        has = traits(text)
        for i, line in enumerate(lines):
            f = line_features(line, has)
            if i == 0 and cut_left:
                head = f
            elif i == last and cut_right:
                tail = f
            else:
                Counts.add(totals, f, line.strip() != "")
        return totals, head, tail, last == 0 and cut_left and cut_right

    @staticmethod
    def add(totals, f, filled=True):
        totals[0] += f[CHARS]
        totals[1] += f[WORDS]
        totals[2] += f[LETTERS]
        totals[3] += f[COMMON_WORDS]
        totals[4] += f[SYMBOLS]
        totals[5] += f[NUMBERS]
        if filled:
            totals[6] += 1
            totals[7] += f[ENDED]
            kind = judge(f)
            totals[8 if kind == 1 else 9 if kind == 0 else 10] += f[CHARS]


def cut(text: str, size: int = PIECE):
    """(piece, cut_left, cut_right) of a text: at line ends where possible, else at a space, else anywhere."""
    n, at, left = len(text), 0, False
    while n - at > size:
        end = text.rfind("\n", at, at + size)
        if end > at:
            yield text[at:end], left, False
            at, left = end + 1, False
            continue
        end = text.rfind(" ", at, at + size)
        end = end + 1 if end > at else at + size
        yield text[at:end], left, True
        at, left = end, True
    yield text[at:], left, False


def split_long(batches):
    for b in batches:
        rows = b.to_pydict()
        out = {"chunk_id": [], "piece": [], "start": [], "cut_left": [], "cut_right": [], "text": []}
        for cid, text in zip(rows["chunk_id"], rows["text"]):
            start = 0
            for k, (piece, left, right) in enumerate(cut(text)):
                for name, v in zip(out, (cid, k, start, left, right, piece)):
                    out[name].append(v)
                start += len(piece) + (not right)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("chunk_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("cut_left", pa.bool_()), ("cut_right", pa.bool_()), ("text", pa.string())]))


#: Characters that one step of vectorised work takes at once; its arrays hold several numbers for each.
PORTION = 2_000_000


def portions(batches, column: str = "text"):
    """Arrow batches cut into slices of about PORTION characters (single texts stay whole), so that memory does not follow the batch size."""
    for b in batches:
        texts = b.column(column)
        ends = pc.cumulative_sum(pc.fill_null(pc.utf8_length(texts), 0).cast(pa.int64())).to_pylist()
        begin, taken = 0, 0
        for i, e in enumerate(ends):
            if i > begin and e - taken > PORTION:
                yield b.slice(begin, i - begin)
                begin, taken = i, ends[i - 1]
        if begin < len(ends):
            yield b.slice(begin)


PIECES = "chunk_id long, piece int, start long, cut_left boolean, cut_right boolean, text string"


def pieces(chunks: DataFrame, arrays: DataFrame | None = None) -> DataFrame:
    """Texts, without the boilerplate lines of ``arrays``, as pieces of at most PIECE characters; only longer texts go through the cutter and are spread.

    Lines only make a text shorter, so the second pass over the table for the long texts frees
    no others of their lines.
    """
    from . import boilerplate

    def clean(rows):
        rows = rows if arrays is None else boilerplate.strip(rows, arrays)
        return rows.select("chunk_id", "text").where(F.col("text").rlike(r"(?U)\S"))  # neither null nor blank

    rows = chunks.select("chunk_id", "source_dataset", "text")
    short = clean(rows).where(F.length("text") <= PIECE).select(
        "chunk_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(False).alias("cut_left"), F.lit(False).alias("cut_right"), "text")
    long = clean(rows.where(F.length("text") > PIECE)).where(F.length("text") > PIECE).mapInArrow(split_long, PIECES).repartition("chunk_id", "piece")
    return short.unionByName(long)


_F = pa.list_(pa.int64())
PARTIAL = "chunk_id long, piece int, totals array<long>, head array<long>, tail array<long>, through boolean"


def partial_arrays(d: dict, verdict_only: bool = False) -> list:
    """Columns totals, head, tail, through; with ``verdict_only`` an uncut text has its characters on the side of its verdict, and no other counts."""
    def one(t, left, right):
        if not verdict_only or left or right:
            return Counts.of(t, left, right)
        other = is_other(t)
        return [0] * 8 + [(len(t) + 1) * other, (len(t) + 1) * (not other), 0], None, None, False

    got = [one(t, l, r) for t, l, r in zip(d["text"], d["cut_left"], d["cut_right"])]
    return [pa.array([g[0] for g in got], _F), pa.array([g[1] for g in got], _F), pa.array([g[2] for g in got], _F), pa.array([g[3] for g in got], pa.bool_())]


def _partial(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("chunk_id"), b.column("piece"), *partial_arrays(b.to_pydict())], names=["chunk_id", "piece", "totals", "head", "tail", "through"])


def fold_cut_lines(parts: list[dict]) -> list[int]:
    """Counts of the lines that pieces cut, from the pieces' boundary states in order."""
    totals, state = [0] * 11, None
    for p in parts:
        if p["head"] is not None:
            state = p["head"] if state is None else [x + y for x, y in zip(state, p["head"])]
            if not p["through"]:
                Counts.add(totals, state)
                state = None
        if p["tail"] is not None:
            state = p["tail"]
    if state is not None:
        Counts.add(totals, state)
    return totals


@F.arrow_udf(T.ArrayType(T.LongType()))
def _seam(parts: pa.Array) -> pa.Array:
    return pa.array([fold_cut_lines(p) if p else None for p in parts.to_pylist()], _F)


def partials(pieces_df: DataFrame) -> DataFrame:
    return pieces_df.mapInArrow(_partial, PARTIAL)


def merge(parts: DataFrame, **arrays: int) -> DataFrame:
    """Counts per chunk_id, and element-wise sums of further array columns (name=length).

    Pieces delivered twice count once; cut lines are joined in piece order. One pass over the
    texts: the boundary states ride along and are empty for all but the longest texts.
    """
    extra = list(arrays)
    # dealt out by text once, which serves both groupings; pieces of one text are few
    one = parts.repartition("chunk_id").groupBy("chunk_id", "piece").agg(*[F.any_value(c).alias(c) for c in ("totals", "head", "tail", "through", *extra)])
    ends = F.when(F.col("head").isNotNull() | F.col("tail").isNotNull(), F.struct("piece", "head", "tail", "through"))
    sums = [F.sum(F.element_at("totals", i + 1)).alias(n) for i, n in enumerate(Counts.NAMES)]
    sums += [F.sum(F.element_at(c, i + 1)).alias(f"{c}{i}") for c, n in arrays.items() for i in range(n)]
    per = one.groupBy("chunk_id").agg(*sums, F.sort_array(F.collect_list(ends)).alias("parts")).withColumn("seam", _seam("parts"))
    return per.select(
        "chunk_id", *[(F.col(n) + F.coalesce(F.element_at("seam", i + 1), F.lit(0))).alias(n) for i, n in enumerate(Counts.NAMES)],
        *[f"{c}{i}" for c, n in arrays.items() for i in range(n)])


def verdict(counts: DataFrame, *more: str) -> DataFrame:
    """Ratios and verdict from the counts; open characters follow the larger judged part."""
    other = F.col("other_chars") + F.when(F.col("other_chars") > F.col("prose_chars"), F.col("open_chars")).otherwise(F.lit(0))
    total = F.col("other_chars") + F.col("prose_chars") + F.col("open_chars")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return counts.select(
        "chunk_id", "n_chars", "n_words", "n_lines",
        ratio(F.col("n_letters"), F.col("n_words")).alias("mean_word_length"),
        ratio(F.col("n_symbols"), F.col("n_chars")).alias("symbol_ratio"),
        ratio(F.col("n_ended"), F.col("n_lines")).alias("ended_lines_ratio"),
        ratio(F.col("n_common"), F.col("n_words")).alias("common_words_ratio"),
        ratio(other, total).alias("other_ratio"),
        F.when(total == 0, None).when(other * 2 > total, "other").otherwise("prose").alias("verdict"), *more,
    )


def stats(chunks: DataFrame, arrays: DataFrame) -> DataFrame:
    """Statistics and verdict of every chunk with text left, its source's boilerplate lines (``arrays``) left out."""
    return verdict(merge(partials(pieces(chunks, arrays))))


def every_chunk(chunks: DataFrame, arrays: DataFrame) -> DataFrame:
    """As ``stats``, and a row with zero counts and a null verdict for every chunk that has none there: text null or empty, or so without boilerplate."""
    rows = chunks.select("chunk_id").distinct().join(stats(chunks, arrays), "chunk_id", "left")
    return rows.na.fill(0, [c for c in rows.columns if c not in ("chunk_id", "verdict")])
