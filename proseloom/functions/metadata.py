"""Metadata read from texts, titles and addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import text as T

# Keyword buckets, in order.
CATEGORY = {
    "paranormal": ("vampire", "werewolf", "shifter", "supernatural", "witch"),
    "classic": ("duke", "earl", "lord", "lady", "regency", "victorian", "historical"),
    "billionaire": ("billionaire", "millionaire", "ceo", "tycoon", "mogul"),
    "gothic": ("gothic", "haunted", "mansion", "mystery"),
}
HEAT = {
    "explicit": ("explicit", "graphic", "hardcore", "bdsm", "kink", "penetration"),
    "steamy": ("steamy", "sensual", "erotic", "pleasure", "intimate", "body", "naked"),
    "sweet": ("sweet", "clean", "innocent", "chaste", "kiss"),
    "mild": ("mild", "tasteful", "suggestion"),
}


def first_bucket(c: Column, buckets: dict, other: str) -> Column:
    out = None
    for name, keys in buckets.items():
        hit = c.rlike("|".join(keys))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


def sql_case(c: str, buckets: dict, other: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{'|'.join(keys)}') THEN '{name}'" for name, keys in buckets.items()) + f" ELSE '{other}' END"


def category(title: Column, text: Column) -> Column:
    return first_bucket(F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")))), CATEGORY, "contemporary")


def heat(text: Column) -> Column:
    return first_bucket(F.lower(F.coalesce(text, F.lit(""))), HEAT, "moderate")


def url_leaf(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def url_slug(url: Column) -> Column:
    """struct(author, title) from ``..._ebook-first-last-the-title``: of three or more parts the first two name the author, of two the first."""
    raw = F.regexp_extract(url_leaf(F.coalesce(url, F.lit(""))), r"(?i)_ebook-(.+)$", 1)
    parts = F.transform(F.filter(F.split(F.try_url_decode(raw), "-"), lambda p: p != ""), F.initcap)
    n = F.size(parts)
    join = lambda a: F.array_join(a, " ")
    author = F.when(n >= 3, join(F.slice(parts, 1, 2))).when(n == 2, F.element_at(parts, 1))
    title = F.when(n >= 3, join(F.slice(parts, 3, F.greatest(n - 2, F.lit(1))))).when(n == 2, F.element_at(parts, 2)).when(n == 1, F.element_at(parts, 1))
    return F.struct(F.when(raw != "", author).alias("author"), F.when(raw != "", title).alias("title"))


def header(text: Column) -> Column:
    """struct(author, title) from a text's first line: cut at three spaces and at a chapter mark; the first two capitalised words name the author."""
    line = T.strip(F.element_at(F.split(F.replace(F.substring(text, 1, 400), F.lit("\r\n"), F.lit("\n")), "\n"), 1))
    line = T.strip(F.element_at(F.split(line, r"\s{3,}"), 1))
    at = F.regexp_instr(line, F.lit(r"(?i)\b(?:chapter|prologue|contents|entry in)\b"))
    line = F.when(at > 11, T.strip(F.substring(line, F.lit(1), at - 1))).otherwise(line)
    w = T.words(line)
    named = (F.size(w) >= 3) & F.try_element_at(w, F.lit(1)).rlike(r"^\p{Lu}") & F.try_element_at(w, F.lit(2)).rlike(r"^\p{Lu}")
    title = F.btrim(F.array_join(F.slice(w, 3, F.greatest(F.size(w), F.lit(1))), " "), F.lit(" ."))
    ok = named & (title != "")
    return F.struct(F.when(ok, F.array_join(F.slice(w, 1, 2), " ")).alias("author"), F.when(ok, title).alias("title"))


def book_metadata(url: Column, text: Column) -> Column:
    """struct(author, title, url): the header wins, the address fills what it lacks."""
    h, u = header(F.coalesce(text, F.lit(""))), url_slug(url)
    return F.struct(F.coalesce(h["author"], u["author"]).alias("author"), F.coalesce(h["title"], u["title"]).alias("title"), F.nullif(url, F.lit("")).alias("url"))


# Titles and body marks of plays and novels.
NOVEL = r"(?i)\b(?:novel|novelized|romance|stories|tales|novelette)\b"
PLAY_TITLE = r"(?i)\bThe Tragedy of\b|\bThe Comedy of\b|: A Comedy\b|: A Tragedy\b|: A Play\b|\bA Comedy for\b|\b(?:Three|Four|Five)-Act (?:Play|Comedy|Tragedy|Drama)\b"
PLAY_BODY = (
    r"(?mi)^\s*DRAMATIS PERSONAE\s*$", r"(?mi)^\s*ACT\s+(?:I|1|ONE)(?:[\.\s:\-]|$)",
    r"(?mi)^\s*SCENE\s+(?:I|1|ONE)(?:[\.\s:\-]|$)", r"(?mi)^\s*\[(?:Enter|Exit|Exeunt|Aside)\b")


def play(title: Column, text: Column, sample: int = 15_000) -> Column:
    """Why a work looks like a play: title, body, stage_directions; null if it does not."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, sample)
    marks = sum(head.rlike(p).cast("int") for p in PLAY_BODY)
    title = F.coalesce(title, F.lit(""))
    return F.when(title.rlike(NOVEL), None).when(title.rlike(PLAY_TITLE), "title").when(marks >= 3, "body").when(F.regexp_count(head, F.lit(PLAY_BODY[3])) >= 20, "stage_directions")
