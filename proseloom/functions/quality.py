"""Classifiers over one text: prose, fiction quality, language, transcription quality. All are Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import text as T

# --- Fixed values: patterns of the prose classifier (Java and RE2 read them alike) ---------
PROSE_PATTERNS = {
    "transcriber": r"(?i)(?:^|\n)(?:Produced by|E-text prepared by|Prepared by)[^\n]{0,200}(?:Distributed Proofreading|Online Distributed Proofreading|pgdp\.net|Internet Archive \(http?://www\.archive\.org\))",
    "license": r"(?i)Project Gutenberg(?: EBook| License)?|www\.gutenberg\.org(?:/license)?",
    "metadata": r"(?im)^(?:Title|Author|Translator|Editor|Release Date|Posting Date|Language|Character set encoding|EBook #|EBook No\.|Credits|Updated)\s*:",
    "toc": r"(?im)^(?:Table of Contents|Contents|CONTENTS(?:\s+OF\s+VOL[^\n]*)?)\s*$",
    "illustrations": r"(?im)^(?:LIST OF ILLUSTRATIONS|ILLUSTRATIONS)\s*$",
    "divider": r"\*\s+\*\s+\*\s+\*",
    "wiki": r"=[^\n]+?=",
    "price": r"(?i)\b(?:post|crown|square|small)?\s*8vo\b|\bcloth(?:\s+(?:extra|limp|boards))?\b|\billustrated boards\b|\b\d+s\.(?:\s*\d+d\.)?",
    "works_by": r"(?i)\bWorks by\b",
    "toc_entry": r"(?m)^[ \t]*(?:[IVXLC]+\.|CHAPTER\s+[IVXLC\d]+|[A-Z][A-Z \.'\-]{3,60})\s+\d+\s*$",
    "toc_dotted": r"(?m)\.{3,}\s*\d+\s*$",
    "catalog_sentence": r"(?i)\b8vo\b|=\s*[^\n]+?=\s*|Works by|\*\s+\*\s+\*|\b\d+s\.\s*\d*d\.|cloth extra|illustrated boards",
    "catalog_line": r"(?i)\b8vo\b|=\s*[^\n]+?=\s*|Works by|\*\s+\*\s+\*|\b\d+s\.\s*\d*d\.|^[\w\s,\.'\-]{3,50}\s+\d+\s*$",
    "narrative_line": r"^[a-z].*[a-z][.!?][\"'\)]?\s*$|^[A-Z][a-z]+(?:\s+[a-z]+){4,}.*[.!?][\"'\)]?\s*$",
    "errata_header": r"(?im)^CORRECTIONS\s*$|page\s+original\s+text\s+correction",
    "errata_row": r"(?m)^\s*\d{1,4}\s+\S.{5,}\s+\S",
    "verse": r"(?i)_(?:I{1,3}|IV|VI{0,3}|IX|X{0,3}|XI{0,3}|XII{0,3}|XIII|XIV|XV|XVI|XVII|XVIII|XIX|XX|XXI|XXII|XXIII|XXIV|XXV|XXX|XL|L)\._",
    "the_end": r"(?i)\bTHE END\.?\b",
}
# Word counts and shares of the prose rules.
MIN_WORDS, NARRATIVE = 30, 0.45


def java(p: str) -> str:
    """Line anchors and dots as in the other engines: only LF ends a line."""
    return "(?d)" + p


def _has(c: Column, name: str) -> Column:
    return c.rlike(java(PROSE_PATTERNS[name]))


def _hits(c: Column, name: str) -> Column:
    return F.regexp_count(c, F.lit(java(PROSE_PATTERNS[name])))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def narrative_words(c: Column) -> Column:
    """Words in sentences of eight or more words with a small letter that are no catalogue entries; words are counted once."""
    parts = F.transform(F.split(c, rf"(?<=[.!?])[{T.SPACE}]+"), lambda s: F.struct(s.alias("s"), T.word_count(s).alias("n")))
    told = F.filter(parts, lambda p: (p["n"] >= 8) & p["s"].rlike("[a-z]"))
    return F.aggregate(told, F.lit(0), lambda n, p: n + F.when(T.strip(p["s"]).rlike(java(PROSE_PATTERNS["catalog_sentence"])), 0).otherwise(p["n"]))


def prose(df: DataFrame, text: str, out: str = "prose", min_words: int = MIN_WORDS) -> DataFrame:
    """Adds ``out``: struct(keep, reason, narrative_ratio, narrative_word_ratio, signals).

    Features are projected first, so each is computed once; the verdict is one ordered chain
    of conditions over them.
    """
    c = F.col("_t")
    base = df.withColumn("_t", T.strip(T.text_of(text)))
    base = T.once(base, _t=c)
    base = T.once(base, _w=T.word_count(c), _l=T.lines(c))
    long = F.col("_w") >= min_words
    feats = {n: _has(c, n) for n in ("transcriber", "license", "toc", "illustrations", "divider", "works_by", "errata_header", "the_end")}
    feats |= {n: _hits(c, n) for n in ("metadata", "wiki", "price", "toc_entry", "toc_dotted", "errata_row", "verse")}
    feats["nw"] = _share(narrative_words(c), F.col("_w"))
    feats["nl"] = _share(F.size(F.filter("_l", lambda x: x.rlike(java(PROSE_PATTERNS["narrative_line"])))), F.size("_l"))
    feats["cl"] = _share(F.size(F.filter("_l", lambda x: x.rlike(java(PROSE_PATTERNS["catalog_line"])))), F.size("_l"))
    feats["caps"] = F.size(F.filter("_l", lambda x: (F.length(x) > 20) & x.rlike(r"\p{Lu}") & ~x.rlike(r"\p{Ll}")))
    base = T.once(base, _f=F.struct(*[v.alias(k) for k, v in feats.items()]))
    f = lambda n: F.col(f"_f.{n}")
    nw, w = f("nw"), F.col("_w")
    catalog = (nw < 0.35) & (
        ((f("price") >= 2) & ((f("wiki") >= 1) | f("works_by") | f("divider")))
        | ((f("price") >= 1) & f("divider") & (f("wiki") >= 1)) | (f("works_by") & (f("price") >= 1)) | ((f("cl") >= 0.45) & (f("price") >= 1)))
    entries = f("toc_entry") + f("toc_dotted")
    front = (nw < 0.15) & (w < 250)
    reason = (
        F.when(~long, "too_short")
        .when(f("errata_header") | (f("errata_row") >= 4), "errata_corrections")
        .when(f("verse") >= 3, "verse_appendix")
        .when(f("the_end") & (f("errata_row") >= 2), "errata_corrections")
        .when(nw >= NARRATIVE, None)
        .when(catalog, "publisher_catalog")
        .when(f("transcriber") & front, "transcriber_credits")
        .when(f("license") & front, "gutenberg_license")
        .when(f("toc") & (entries >= 4) & (nw < 0.2), "table_of_contents")
        .when(f("illustrations") & (nw < 0.2), "illustration_index")
        .when((entries >= 8) & (nw < 0.15), "table_of_contents")
        .when((f("caps") >= 6) & (nw < 0.1) & (w < 400), "structural_index")
        .when((f("metadata") >= 3) & (nw < 0.12) & (w < 200), "metadata_block"))
    seen = F.array_compact(F.array(*[F.when(cond, name) for cond, name in (
        (f("transcriber"), "transcriber_credits"), (f("license"), "gutenberg_license"), (f("metadata") >= 3, "metadata_block"),
        (f("toc"), "table_of_contents"), (f("illustrations"), "illustration_index"), (f("divider"), "asterisk_divider"),
        (f("price") > 0, "publisher_pricing"), (f("wiki") > 0, "wiki_markup"))]))
    structural = F.when(~long, F.array(F.lit("too_short"))).when(f("errata_header") | (f("errata_row") >= 4), F.array(F.lit("errata_table"))).when(
        f("verse") >= 3, F.array(F.lit("verse_stanzas"))).when(f("the_end") & (f("errata_row") >= 2), F.array(F.lit("the_end_errata")))
    signals = F.when(structural.isNotNull(), structural).when(nw >= NARRATIVE, F.array().cast("array<string>")).otherwise(seen)
    r4 = lambda x: T.rounded(F.when(long, x).otherwise(0.0), 4)
    return T.once(base, **{out: F.struct(
        reason.isNull().alias("keep"), reason.alias("reason"), r4(f("nl")).alias("narrative_ratio"),
        r4(nw).alias("narrative_word_ratio"), signals.alias("signals"))}).drop("_t", "_w", "_l", "_f")


# --- Language ----------------------------------------------------------------------------
# Scripts that are not Latin, and common English words.
OTHER_SCRIPTS = r"[\x{0600}-\x{06FF}\x{0900}-\x{097F}\x{0400}-\x{04FF}\x{4E00}-\x{9FFF}\x{0E00}-\x{0E7F}\x{0590}-\x{05FF}]"
ENGLISH = (
    "the|and|to|of|a|in|that|it|was|for|on|is|with|as|he|she|you|her|his|not|but|they|had|at|be|my|this|have|from|or|one|by|love|said|what|when|we|were|been|would"
)


def other_script(c: Column, sample: int = 4_000) -> Column:
    return F.substring(c, 1, sample).rlike(OTHER_SCRIPTS)


def english_ratio(c: Column, most: int = 500) -> Column:
    """Share of the first words that start with a common English word at a word border."""
    w = F.slice(T.words(F.lower(c)), 1, most)
    return _share(F.size(F.filter(w, lambda x: x.rlike(rf"^(?:{ENGLISH})(?:$|[^\p{{L}}\p{{N}}_])"))), F.size(w))


def language(c: Column, detected: Column | None = None) -> Column:
    """en, non_en or unknown: by script, else by a detector's code where there is one, else by the share of common English words."""
    out = F.when(other_script(c), "non_en")
    if detected is not None:
        out = out.when(detected == "en", "en").when(detected.isNotNull(), "non_en")
    return out.when(english_ratio(c) >= 0.04, "en").otherwise("unknown")


def english_only(df: DataFrame, text: str, *keys: str, detected: Column | None = None) -> DataFrame:
    """``keys`` and language, word_count, kept, reason of every row: kept are the English ones, others carry why they are skipped; texts are classified once."""
    c = T.text_of(text)
    rows = T.once(df.withColumn("_d", detected if detected is not None else F.lit(None).cast("string")), _class=language(c, F.col("_d")))
    why = F.when(F.col("_class") == "non_en", "non_english").when(F.col("_class") == "unknown", "unknown_language")
    return rows.select(*keys, F.when(F.col("_class") == "en", "en").otherwise(F.coalesce("_d", "_class")).alias("language"), T.word_count(c).alias("word_count"), why.isNull().alias("kept"), why.alias("reason"))


# --- Fiction quality ---------------------------------------------------------------------
# Patterns, penalties and tiers of the fiction score.
DISCLAIMER = r"(?i)\b(?:all characters (?:are|were) (?:18|of legal age)|this story contains fictional depictions|do not read if (?:offended|underage)|standard disclaimer)\b"
FORUM = r"(?i)\b(?:please rate and review|comments appreciated|follow me on|patreon\.com|onlyfans)\b"
HARD = ["non_english", "too_short", "garbled", "errata_corrections", "verse_appendix", "publisher_catalog", "disclaimer_only"]
SOFT = ["low_vocab", "repetitive", "fragmentary", "html_heavy", "short"]


def top_bigram_ratio(w: Column) -> Column:
    """Share of the commonest pair of neighbouring words, lower case; 0 below 50 words. One pass over the sorted pairs of the row."""
    low = F.transform(w, F.lower)
    n = F.size(w)
    pairs = F.array_sort(F.zip_with(F.slice(low, 1, n - 1), F.slice(low, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b)))
    zero = F.struct(F.lit("").alias("p"), F.lit(0).alias("k"), F.lit(0).alias("best"))

    def step(a, p):
        k = F.when(a["p"] == p, a["k"] + 1).otherwise(1)
        return F.struct(p.alias("p"), k.alias("k"), F.greatest(a["best"], k).alias("best"))

    return F.when(n >= 50, F.aggregate(pairs, zero, step, lambda a: a["best"]) / (n - 1)).otherwise(0.0)


def mean_sentence_words(c: Column) -> Column:
    counts = F.filter(F.transform(F.split(c, "[.!?]+"), T.word_count), lambda n: n >= 3)
    return _share(F.aggregate(counts, F.lit(0), lambda a, n: a + n), F.size(counts))


def fiction(df: DataFrame, text: str, out: str = "fiction") -> DataFrame:
    """Adds ``out``: struct(tier, score, reasons, word_count, unique_word_ratio, top_bigram_ratio, avg_sentence_words, html_char_ratio, language)."""
    base = T.once(T.once(df, _raw=T.strip(T.text_of(text))), _c=T.strip_html(F.col("_raw")))
    base = prose(base, "_c", "_p", min_words=200)
    c = F.col("_c")
    base = T.once(T.once(base, _words=T.words(c)), _q=F.struct(
        F.size("_words").alias("n"), _share(F.size(F.array_distinct(F.transform("_words", F.lower))), F.size("_words")).alias("uniq"),
        top_bigram_ratio(F.col("_words")).alias("big"), mean_sentence_words(c).alias("sent"), T.html_ratio(F.col("_raw")).alias("html"),
        _share(F.length(F.regexp_replace(c, rf"[^\p{{L}}{T.SPACE}]", "")), F.length(c)).alias("alpha"), language(c).alias("lang")))
    q = lambda n: F.col(f"_q.{n}")
    n = q("n")
    rules = [
        (q("lang") != "en", F.lit("non_english"), 0.5), (F.col("_p.reason").isNotNull(), F.col("_p.reason"), 0.4),
        (n < 200, F.lit("too_short"), 0.5), ((n >= 200) & (n < 500), F.lit("short"), 0.15), (q("alpha") < 0.78, F.lit("garbled"), 0.35),
        (q("uniq") < 0.30, F.lit("low_vocab"), 0.25), (q("big") > 0.07, F.lit("repetitive"), 0.25), (q("html") > 0.12, F.lit("html_heavy"), 0.1),
        (F.substring("_raw", 1, 500).rlike(DISCLAIMER) & (n < 500), F.lit("disclaimer_only"), 0.2), (F.col("_raw").rlike(FORUM) & (n < 800), F.lit("forum_boilerplate"), 0.15),
        ((q("sent") < 4.0) & (n > 300), F.lit("fragmentary"), 0.15)]
    base = T.once(base, _r=F.array_compact(F.array(*[F.when(cond, name) for cond, name, _ in rules])))
    # hundredths keep the sum exact
    lost = sum(F.when(cond, F.lit(round(p * 100))).otherwise(0) for cond, _, p in rules)
    score = (F.lit(100) - lost) / 100.0
    any_of = lambda names: F.arrays_overlap("_r", F.array(*map(F.lit, names)))
    tier = F.when(any_of(HARD), "drop").when(any_of(SOFT), F.when(score >= 0.40, "review").otherwise("drop")).when(score >= 0.75, "keep").when(score >= 0.45, "review").otherwise("drop")
    r = T.rounded
    return T.once(base, **{out: F.struct(
        tier.alias("tier"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"), F.col("_r").alias("reasons"), n.alias("word_count"),
        r(q("uniq"), 4).alias("unique_word_ratio"), r(q("big"), 4).alias("top_bigram_ratio"), r(q("sent"), 2).alias("avg_sentence_words"),
        r(q("html"), 4).alias("html_char_ratio"), q("lang").alias("language"))}).drop("_raw", "_c", "_p", "_words", "_q", "_r")


def tier_emits(tier: Column, keep_tier: str | None) -> Column:
    """keep lets only keep pass; review and keep+review let all but drop pass; none lets all pass."""
    if keep_tier is None:
        return F.lit(True)
    return tier == "keep" if keep_tier == "keep" else tier != "drop"


# --- Transcription quality -----------------------------------------------------------------
# Phrases of a model talking about its task, and planning openers.
META = [
    "i need to transcribe", "let's start by", "lets start by", "so we need to", "in markdown", "the instruction says", "wait, but", "let me think",
    "let's check", "lets check", "let's verify", "following the given rules", "output only markdown", "return only"]
PLANNING = r"(?i)^(?:first|next|then|now|so|also|wait|okay|ok)\s*,?\s+(?:the|we|i|let's|lets)\b"


def most_common_share(w: Column) -> Column:
    """Occurrences of the commonest element."""
    zero = F.struct(F.lit("").alias("p"), F.lit(0).alias("k"), F.lit(0).alias("best"), F.lit("").alias("top"))

    def step(a, p):
        k = F.when(a["p"] == p, a["k"] + 1).otherwise(1)
        return F.struct(p.alias("p"), k.alias("k"), F.greatest(a["best"], k).alias("best"), F.when(k > a["best"], p).otherwise(a["top"]).alias("top"))

    return F.aggregate(F.array_sort(w), zero, step, lambda a: F.struct(a["best"].alias("n"), a["top"].alias("top")))


def page_quality(df: DataFrame, text: str, out: str = "page") -> DataFrame:
    """Adds ``out``: struct(ok, issues, word_count, unique_word_ratio); issues are codes."""
    c = F.col("_t")
    base = T.once(T.once(df, _t=T.strip(T.text_of(text))), _w=F.regexp_extract_all(F.lower(c), F.lit("[a-z']+"), F.lit(0)), _k=T.words(c))
    tokens = F.col("_k")
    n3 = F.size(tokens)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n3 - 2, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, 3), " "))
    base = T.once(base, _m=F.struct(
        F.size("_w").alias("n"), _share(F.size(F.array_distinct("_w")), F.size("_w")).alias("uniq"), most_common_share(F.col("_w"))["n"].alias("dom"),
        F.when(n3 >= 12, most_common_share(grams)).alias("gram"),
        sum(F.contains(F.lower(c), F.lit(p)).cast("int") for p in META).alias("meta"),
        F.size(F.filter(T.lines(c), lambda x: x.rlike(PLANNING))).alias("plan")))
    m = lambda n: F.col(f"_m.{n}")
    issues = F.array_compact(F.array(
        F.when(m("n") < 8, "too_short"), F.when((m("n") >= 8) & (m("uniq") < 0.12), "low_variety"),
        F.when((m("n") >= 10) & (m("dom") > 0.35 * m("n")), "repetitive_token"),
        F.when((m("gram.n") >= 4) & (F.length(m("gram.top")) * m("gram.n") > 0.25 * F.length(c)), "repeated_phrase"),
        F.when((m("meta") > 2) | (m("plan") >= 4), "model_reasoning"), F.when(c.rlike(r"(?:\b\d+\b[\s,]){12,}"), "numeric_spam")))
    return T.once(base, _i=issues).withColumn(out, F.struct((F.size("_i") == 0).alias("ok"), F.col("_i").alias("issues"), m("n").alias("word_count"), T.rounded(m("uniq"), 4).alias("unique_word_ratio"))).drop("_t", "_w", "_k", "_m", "_i")
