"""Text expressions: every function takes and gives Columns, so they stay inside the JVM and are optimised by Catalyst.

A null text counts as empty unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: White space as Unicode knows it; written out so that Java and RE2 agree.
SPACE = r"\s\x0B\x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Line ends as Unicode knows them.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}]"
#: Curly and angle quotes, and the plain quotes that replace them.
CURLY, PLAIN = "“”„«»‘’‚‹›", "\"\"\"\"\"'''''"
#: The marks stripped from tokens, and those counted as punctuation.
TOKEN_MARKS, PUNCTUATION = ".,!?;:\"'()[]{}-", ".,!?;:-"


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with further columns that are computed once per row.

    The optimizer copies a projected expression into every place that uses it; a generator
    over one element is a border it does not cross.
    """
    name = "_once_" + next(iter(cols))
    out = df.withColumn(name, F.explode(F.array(F.struct(*[v.alias(k) for k, v in cols.items()]))))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in cols], *[F.col(f"{name}.{k}").alias(k) for k in cols])


def text_of(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """Both ends freed of any white space."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def words(c: Column) -> Column:
    """Runs of non-space characters."""
    return F.filter(F.split(c, rf"[{SPACE}]+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def sentences(c: Column) -> Column:
    """Parts between an end mark and a capital or quote; the whole text if there is no such border; empty for blank texts."""
    parts = F.split(strip(c), rf"(?<=[.!?])[{SPACE}]+(?=[A-Z\"'])")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def lines(c: Column) -> Column:
    """Stripped lines that are not empty."""
    return F.filter(F.transform(F.split(c, LINE_END), strip), lambda s: s != "")


def normalize_whitespace(c: Column) -> Column:
    """LF line ends, no blanks at line ends, at most one empty line in a row, stripped."""
    lf = F.regexp_replace(c, r"\r\n?", "\n")
    return strip(F.regexp_replace(F.regexp_replace(lf, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))


def normalize_quotes(c: Column) -> Column:
    return F.translate(c, CURLY, PLAIN)


#: What counts as markup.
TAG, ENTITY = r"<[^>]+>", r"&(?:nbsp|amp|lt|gt|quot|#39);"


def strip_html(c: Column) -> Column:
    """Tags and six entities give way to a space, white space is squeezed."""
    bare = F.regexp_replace(F.regexp_replace(c, TAG, " "), ENTITY, " ")
    return strip(F.regexp_replace(bare, rf"[{SPACE}]+", " "))


def html_ratio(c: Column) -> Column:
    """Share of a text's characters that are markup; 0 for an empty text."""
    rest = F.length(F.regexp_replace(c, TAG, ""))
    tags = F.length(c) - rest
    entities = F.length(c) - F.length(F.regexp_replace(c, ENTITY, ""))
    return F.when(F.length(c) > 0, (tags + entities) / F.length(c)).otherwise(0.0)


def slug(c: Column, fallback: str = "untitled", cut: int | None = None) -> Column:
    """Lower case, runs of other characters as one underscore; ``fallback`` when nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(text_of(c)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    if cut:
        s = F.regexp_replace(F.substring(s, 1, cut), r"_+$", "")
    return F.when(s == "", fallback).otherwise(s)


def author_slug(c: Column) -> Column:
    """Slug of a name; "Last, First" is turned round; unknown_author when nothing is left."""
    c = text_of(c)
    turned = F.when(
        F.contains(c, F.lit(",")),
        F.concat_ws(" ", F.trim(F.regexp_extract(c, r"^[^,]*,(.*)$", 1)), F.trim(F.regexp_extract(c, r"^([^,]*),", 1))),
    ).otherwise(c)
    return slug(turned, "unknown_author")


def genres(c: Column) -> Column:
    """A list from a text split at comma, semicolon, slash or bar: trimmed, lower case, blanks as underscores."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[,;/|]"), lambda g: F.replace(F.lower(F.trim(g)), F.lit(" "), F.lit("_")))
    return F.filter(parts, lambda g: g != "")


def genres_of_list(c: Column) -> Column:
    """The same of a list of texts, flattened; null gives the empty list."""
    return F.flatten(F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull()), genres))


def genres_of_flags(c: Column) -> Column:
    """Names of a map's flags that are set: 1, true or True."""
    on = F.map_filter(c, lambda k, v: v.cast("string").isin("1", "true", "True"))
    return F.transform(F.map_keys(on), lambda k: F.regexp_replace(F.lower(F.trim(k)), "[- ]", "_"))


def first_text(*cols: Column) -> Column:
    """The first column that is not blank, trimmed."""
    return F.coalesce(*[F.when(strip(c) != "", strip(c)) for c in cols])


def rounded(c: Column, digits: int) -> Column:
    """Half up at ``digits``, by floor, so that engines agree."""
    k = 10.0 ** digits
    return F.floor(c * k + 0.5) / k


def fixed_chunks(c: Column, size: int = 500, overlap: int = 50) -> Column:
    """Windows of ``size`` words, each sharing ``overlap`` with the one before; a text of up to ``size`` words stays as it is."""
    w = words(c)
    n = F.size(w)
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((n - size) / F.lit(float(step))).cast("int"))
    return F.when(n <= size, F.array(c)).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(w, i * step + 1, size), " ")))


def reflow(c: Column) -> Column:
    """Wrapped lines joined within paragraphs; a hyphen at a line end joins without space.

    A paragraph that is a lone capital, or a capitalised word of up to 12 letters, joins the
    next paragraph if that starts in lower case (a capital without a space); pairs only.
    """
    lf = F.regexp_replace(c, r"\r\n?", "\n")
    paragraphs = F.filter(F.transform(F.split(lf, rf"\n[{SPACE}]*\n"), strip), lambda p: p != "")
    letter, word, small = "^[A-Z]$", "^[A-Z][a-z']{1,11}$", r"^\p{Ll}"

    def glue(a: Column, b: Column) -> Column:
        return F.when(a.rlike(letter), F.concat(a, b)).otherwise(F.concat(a, F.lit(" "), b))

    def merges(a: Column, b: Column) -> Column:
        return (a.rlike(letter) | a.rlike(word)) & b.rlike(small)

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("held"))

    def step(acc, p):
        hold = acc["held"].isNotNull()
        joins = hold & merges(acc["held"], p)
        out = F.when(joins, F.concat(acc["out"], F.array(glue(acc["held"], p)))).when(hold, F.concat(acc["out"], F.array(acc["held"]))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.when(~joins, p).alias("held"))

    merged = F.aggregate(paragraphs, start, step, lambda a: F.when(a["held"].isNotNull(), F.concat(a["out"], F.array(a["held"]))).otherwise(a["out"]))

    def one(p: Column) -> Column:
        ls = F.filter(F.transform(F.split(p, "\n"), strip), lambda x: x != "")
        first, second = F.element_at(ls, 1), F.try_element_at(ls, F.lit(2))
        dropcap = (F.size(ls) >= 2) & merges(first, second)
        ls = F.when(dropcap, F.concat(F.array(glue(first, second)), F.slice(ls, 3, F.size(ls)))).otherwise(ls)
        return F.aggregate(
            F.slice(ls, 2, F.size(ls)), F.element_at(ls, 1),
            lambda out, x: F.when(out.endswith("-"), F.concat(F.substring(out, F.lit(1), F.length(out) - 1), x)).otherwise(F.concat(out, F.lit(" "), x)))

    return F.array_join(F.transform(merged, one), "\n\n")
