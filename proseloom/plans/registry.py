"""Queries of the general operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C, metadata as M, quality as Q, style as S, text as T
from ..operators import chunking, labels, pairs, records, retrieval, runs, sampling, segments
from ..session import spread, table
from ..streaming import resume
from . import sql as X

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return add


def docs(spark, d):
    return spread(table(spark, d, "documents"))


def chunks(spark, d):
    return spread(table(spark, d, "chunks"))


D = "SELECT *, coalesce(text, '') AS t FROM documents"

# --- Text ---------------------------------------------------------------------------------


@query("doc_word_stats", f"""
WITH d AS ({D}), s AS (SELECT doc_id, {X.wc('t')} AS n_words, len({X.sents('t')}) AS n_sentences FROM d)
SELECT *, CASE WHEN n_sentences > 0 THEN {X.rnd('n_words / n_sentences', 4)} ELSE 0 END AS mean_words FROM s""")
def doc_word_stats(spark, d):
    c = T.text_of("text")
    s = docs(spark, d).select("doc_id", T.word_count(c).alias("n_words"), F.size(T.sentences(c)).alias("n_sentences"))
    return s.withColumn("mean_words", F.when(F.col("n_sentences") > 0, T.rounded(F.col("n_words") / F.col("n_sentences"), 4)).otherwise(0.0))


_TOK = f"list_filter(list_transform(w, lambda x: trim(lower(x), '{X.esc(T.TOKEN_MARKS)}')), lambda x: x <> '')"


@query("style_metrics", f"""
WITH d AS ({D}), a AS (SELECT doc_id, t, {X.words('t')} AS w, list_transform({X.sents('t')}, lambda s: {X.wc('s')}) AS s FROM d),
b AS (SELECT *, {_TOK} AS k, len(w) AS n, greatest(len(s), 1) AS ns, list_filter(regexp_split_to_array(t, '\\n{{2,}}'), lambda p: {X.strip('p')} <> '') AS par,
  coalesce(list_sum(s), 0) AS s1, coalesce(list_sum(list_transform(s, lambda x: x * x)), 0) AS s2 FROM a)
SELECT doc_id, n AS word_count, ns AS sentence_count, {X.rnd('n / ns', 2)} AS sentence_length_mean,
  CASE WHEN len(s) > 1 THEN {X.rnd('sqrt((s2 * len(s) - s1 * s1) / (len(s) * (len(s) - 1)))', 2)} ELSE 0 END AS sentence_length_std,
  coalesce(list_min(s), 0) AS sentence_length_min, coalesce(list_max(s), 0) AS sentence_length_max,
  {X.rnd('len(list_distinct(k)) / greatest(len(k), 1)', 4)} AS type_token_ratio,
  {X.rnd('coalesce(list_sum(list_transform(k, lambda x: length(x))), 0) / greatest(len(k), 1)', 2)} AS avg_word_length,
  {X.rnd("(length(t) - length(translate(t, '" + T.PUNCTUATION + "', ''))) / n", 4)} AS punctuation_density,
  {X.rnd("coalesce(list_sum(list_transform(regexp_extract_all(t, '" + S.DIALOGUE + "'), lambda x: length(x))), 0) / greatest(length(t), 1)", 4)} AS dialogue_ratio,
  len(par) AS paragraph_count, {X.rnd('n / greatest(len(par), 1)', 2)} AS avg_paragraph_length
FROM b WHERE n >= 20""")
def style_metrics(spark, d):
    return S.metrics(docs(spark, d).select("doc_id", "text"), "text").where("style is not null").select("doc_id", "style.*")


_SY = "list_transform(regexp_extract_all(lower(t), '[a-z'']+'), lambda x: greatest(1, len(regexp_extract_all(regexp_replace(x, 'e$', ''), '[aeiouy]+'))))"


@query("readability", f"""
WITH d AS ({D}), a AS (SELECT doc_id, {_SY} AS y, greatest(len({X.sents('t')}), 1) AS s FROM d), b AS (SELECT doc_id, len(y) AS n, s, list_sum(y) AS y, len(list_filter(y, lambda x: x >= 3)) AS h FROM a)
SELECT doc_id, CASE WHEN n > 0 THEN {X.rnd('206.835e0 - 1.015e0 * n / s - 84.6e0 * y / n', 2)} END AS flesch_reading_ease, CASE WHEN n > 0 THEN {X.rnd('0.39e0 * n / s + 11.8e0 * y / n - 15.59e0', 2)} END AS flesch_kincaid_grade,
CASE WHEN n > 0 THEN {X.rnd('0.4e0 * (n / s + 100 * h / n)', 2)} END AS gunning_fog FROM b""")
def readability(spark, d):
    return S.flesch(docs(spark, d).select("doc_id", "text"), "text").select("doc_id", "readability.*")


@query("quotes_normalized", f"""
WITH c AS (SELECT DISTINCT chunk_id, translate(text, '{T.CURLY}', '{X.esc(T.PLAIN)}') AS q, text FROM chunks WHERE text IS NOT NULL)
SELECT chunk_id, md5(q) AS hash, q <> text AS changed FROM c""")
def quotes_normalized(spark, d):
    c = chunks(spark, d).where("text is not null").select("chunk_id", "text", T.normalize_quotes(F.col("text")).alias("q"))
    return c.select("chunk_id", F.md5(F.col("q").cast("binary")).alias("hash"), (F.col("q") != F.col("text")).alias("changed")).distinct()


@query("whitespace_normalized", f"""
WITH d AS ({D}) SELECT doc_id, md5({X.strip("regexp_replace(regexp_replace(regexp_replace(t, '\\r\\n?', chr(10), 'g'), '[ \\t]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")}) AS hash FROM d""")
def whitespace_normalized(spark, d):
    return docs(spark, d).select("doc_id", F.md5(T.normalize_whitespace(T.text_of("text")).cast("binary")).alias("hash"))


_MERGE = lambda a, b: f"coalesce((regexp_matches({a}, '^[A-Z]$') OR regexp_matches({a}, '^[A-Z][a-z'']{{1,11}}$')) AND regexp_matches({b}, '^\\p{{Ll}}'), false)"
_GLUE = lambda a, b: f"{a} || CASE WHEN regexp_matches({a}, '^[A-Z]$') THEN '' ELSE ' ' END || {b}"
_REFLOW = f"""
p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(t, '\\r\\n?', chr(10), 'g'), '\\n{X.WS}*\\n'), lambda x: {X.strip('x')}), lambda x: x <> '') AS ps FROM d),
u AS (SELECT doc_id, i, ps[i] AS a, ps[i + 1] AS b FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p)),
m AS (SELECT *, {_MERGE('a', 'b')} AS m FROM u),
k AS (SELECT *, m AND (i - coalesce(max(CASE WHEN NOT m THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) % 2 = 1 AS joins FROM m),
s AS (SELECT doc_id, i, CASE WHEN joins THEN {_GLUE('a', 'b')} ELSE a END AS x, lag(joins, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS gone FROM k),
l AS (SELECT doc_id, i, list_filter(list_transform(string_split(x, chr(10)), lambda y: {X.strip('y')}), lambda y: y <> '') AS ls FROM s WHERE NOT gone),
q AS (SELECT doc_id, i, CASE WHEN len(ls) >= 2 AND {_MERGE('ls[1]', 'ls[2]')} THEN list_concat([{_GLUE('ls[1]', 'ls[2]')}], list_slice(ls, 3, len(ls))) ELSE ls END AS ls FROM l),
reflowed AS (SELECT d.doc_id, coalesce(string_agg(replace(replace(array_to_string(ls, chr(1)), '-' || chr(1), ''), chr(1), ' '), chr(10) || chr(10) ORDER BY i), '') AS text FROM d LEFT JOIN q USING (doc_id) GROUP BY d.doc_id)"""


@query("reflowed_docs", f"WITH d AS ({D}), {_REFLOW} SELECT doc_id, length(text) AS n_chars, {X.wc('text')} AS n_words, md5(text) AS hash FROM reflowed")
def reflowed_docs(spark, d):
    r = docs(spark, d).select("doc_id", T.reflow(T.text_of("text")).alias("text"))
    return r.select("doc_id", F.length("text").alias("n_chars"), T.word_count(F.col("text")).alias("n_words"), F.md5(F.col("text").cast("binary")).alias("hash"))


@query("normalize_chain")
def normalize_chain(spark, d):
    """Whitespace, reflow, front matter, titles, dedications, licences, quotes, in that order."""
    t = docs(spark, d).select("doc_id", T.reflow(T.normalize_whitespace(T.text_of("text"))).alias("t"))
    c = T.once(t, c=C.clean(F.col("t")))
    return c.select("doc_id", F.md5(T.normalize_quotes(F.col("c.text")).cast("binary")).alias("hash"), T.word_count(F.col("c.text")).alias("n_words"), F.col("c.reasons").alias("reasons"))


@query("archive_books")
def archive_books(spark, d):
    b = C.split_archives(docs(spark, d).where("text is not null"), "doc_id", "text")
    return b.select("doc_id", "book_no", "title", "author", T.word_count(F.col("text")).alias("n_words"))


def _greedy(name: str, src: str, glue: int, keys: str = "doc_id") -> str:
    """Recursive greedy packing of lengths n in order k."""
    same = " AND ".join(f"g.{x.strip()} IS NOT DISTINCT FROM s.{x.strip()}" for x in keys.split(","))
    own = ", ".join(f"s.{x.strip()}" for x in keys.split(","))
    return f"""{name} AS (SELECT {keys}, k, n, 0 AS part, n AS held FROM {src} WHERE k = 1
  UNION ALL SELECT {own}, s.k, s.n, CASE WHEN g.held + {glue} + s.n > 3500 THEN g.part + 1 ELSE g.part END, CASE WHEN g.held + {glue} + s.n > 3500 THEN s.n ELSE g.held + {glue} + s.n END
  FROM {name} g JOIN {src} s ON {same} AND s.k = g.k + 1)"""


@query("packed_paragraphs", f"""
WITH RECURSIVE d AS ({D}), p AS (SELECT doc_id, i, ps[i] AS p FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(t, '\\n{X.WS}*\\n'), lambda x: {X.strip('x')}), lambda x: x <> '') AS ps FROM d))),
f AS (SELECT doc_id, i, string_split(regexp_replace(p, '([.!?]){X.WS}+', '\\1' || chr(1), 'g'), chr(1)) AS fs FROM p WHERE length(p) > 3500),
e AS (SELECT doc_id, i, j AS k, length(fs[j]) AS n FROM (SELECT doc_id, i, fs, unnest(range(1, len(fs) + 1)) AS j FROM f)),
{_greedy('ge', 'e', 1, 'doc_id, i')},
units AS (SELECT doc_id, i, part, sum(n) + count(*) - 1 AS n FROM ge GROUP BY ALL UNION ALL SELECT doc_id, i, 0, length(p) FROM p WHERE length(p) <= 3500),
un AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id ORDER BY i, part) AS k FROM units),
{_greedy('gu', 'un', 2)}
SELECT doc_id, part, CAST(sum(n) + 2 * (count(*) - 1) AS INTEGER) AS n_chars FROM gu GROUP BY doc_id, part""")
def packed_paragraphs(spark, d):
    return chunking.packed(docs(spark, d), "doc_id", "text").select("doc_id", "part", F.length("piece").alias("n_chars"))


@query("default_labels", f"SELECT doc_id, unnest([{', '.join(repr(f) for f in sorted(labels.FAST))}]) AS dimension, 'moderate' AS label, CAST(NULL AS VARCHAR) AS error FROM documents WHERE text IS NOT NULL")
def default_labels(spark, d):
    dims = [{"id": f, "values": ["low", "moderate", "high"]} for f in labels.FAST]
    score = labels.default_scorer(dims)
    return labels.annotate(docs(spark, d), "doc_id", "text", score, score([""])[0]).select("doc_id", F.explode("labels").alias("dimension", "label"), "error")


_TITLES = """['admiral', 'brother', 'captain', 'chief', 'col', 'colonel', 'commander', 'consul', 'councillor', 'count', 'countess', 'doctor', 'dr', 'duchess', 'duke', 'elder', 'emperor', 'empress', 'ensign',
'father', 'gen', 'general', 'governor', 'judge', 'king', 'lady', 'lieutenant', 'lord', 'lt', 'madam', 'madame', 'major', 'marshal', 'master', 'miss', 'mr', 'mrs', 'ms', 'mother', 'officer', 'president',
'prince', 'princess', 'prof', 'professor', 'queen', 'regent', 'reverend', 'rev', 'senator', 'sergeant', 'sgt', 'sheriff', 'sir', 'sister', 'specialist', 'sultan', 'vizier', 'warden']"""
_W = "string_split(n, ' ')"
_NAMES = f"""WITH a AS (SELECT DISTINCT story_id, source, author FROM stories),
b AS (SELECT *, lower(trim(regexp_replace(coalesce(author, ''), '\\s+', ' ', 'g'))) AS n FROM a), c AS (SELECT *, {_W} AS w FROM b),
e AS (SELECT *, coalesce(list_filter(w, lambda p: NOT list_contains({_TITLES}, regexp_replace(p, '[^\\w]', '', 'g')))[1], w[-1]) AS f,
  CASE WHEN len(w) >= 3 AND w[-2] = 'of' THEN w[-3] ELSE w[-1] END AS l FROM c)"""


@query("name_gate", f"""{_NAMES}
SELECT story_id, author, CASE WHEN n = '' THEN 'empty' WHEN f IN ('ordra', 'vista') THEN 'overused_first' WHEN l IN ('wennalis') THEN 'overused_last'
WHEN min(story_id) OVER (PARTITION BY source, n) < story_id THEN 'duplicate' WHEN min(story_id) OVER (PARTITION BY source, f) < story_id THEN 'duplicate_first' ELSE 'ok' END AS code FROM e""")
def name_gate(spark, d):
    s = table(spark, d, "stories").select("story_id", "source", "author").distinct()
    return labels.name_gate(s, "author", "source", "story_id", ["ordra", "vista"], ["wennalis"]).select("story_id", "author", "code")


@query("html_strip", f"""
WITH d AS ({D}) SELECT doc_id, md5({X.html('t')}) AS hash,
CASE WHEN length(t) > 0 THEN {X.rnd(f"(2 * length(t) - length(regexp_replace(t, '{T.TAG}', '', 'g')) - length(regexp_replace(t, '{T.ENTITY}', '', 'g'))) / length(t)", 6)} ELSE 0 END AS html_ratio FROM d""")
def html_strip(spark, d):
    c = T.text_of("text")
    return docs(spark, d).select("doc_id", F.md5(T.strip_html(c).cast("binary")).alias("hash"), T.rounded(T.html_ratio(c), 6).alias("html_ratio"))


@query("sentences_exploded", f"""
WITH d AS ({D}), s AS (SELECT doc_id, {X.sents('t')} AS s FROM d)
SELECT doc_id, i - 1 AS pos, md5(s[i]) AS hash, {X.wc('s[i]')} AS n_words FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM s)""")
def sentences_exploded(spark, d):
    s = docs(spark, d).select("doc_id", F.posexplode(T.sentences(T.text_of("text"))).alias("pos", "s"))
    return s.select("doc_id", "pos", F.md5(F.col("s").cast("binary")).alias("hash"), T.word_count(F.col("s")).alias("n_words"))


@query("author_slugs", """
WITH s AS (SELECT DISTINCT author FROM stories),
t AS (SELECT author, coalesce(author, '') AS a FROM s),
u AS (SELECT author, CASE WHEN contains(a, ',') THEN concat_ws(' ', trim(regexp_extract(a, '^[^,]*,(.*)$', 1)), trim(regexp_extract(a, '^([^,]*),', 1))) ELSE a END AS b FROM t),
v AS (SELECT author, regexp_replace(regexp_replace(lower(b), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM u)
SELECT author, CASE WHEN slug = '' THEN 'unknown_author' ELSE slug END AS slug FROM v""")
def author_slugs(spark, d):
    return table(spark, d, "stories").select("author").distinct().withColumn("slug", T.author_slug(F.col("author")))


@query("title_slugs", """
WITH v AS (SELECT DISTINCT title, regexp_replace(substring(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80), '_+$', '', 'g') AS s FROM stories)
SELECT title, CASE WHEN s = '' THEN 'untitled' ELSE s END AS slug FROM v""")
def title_slugs(spark, d):
    return table(spark, d, "stories").select("title").distinct().withColumn("slug", T.slug(F.col("title"), cut=80))


@query("genre_counts", """
WITH s AS (SELECT DISTINCT story_id, genres FROM stories), g AS (SELECT story_id, unnest(genres) AS g FROM s),
n AS (SELECT DISTINCT story_id, replace(lower(trim(x)), ' ', '_') AS genre FROM (SELECT story_id, unnest(regexp_split_to_array(g, '[,;/|]')) AS x FROM g))
SELECT genre, count(*) AS n_stories FROM n WHERE genre <> '' GROUP BY genre""")
def genre_counts(spark, d):
    s = table(spark, d, "stories").select("story_id", F.explode(F.array_distinct(T.genres_of_list(F.col("genres")))).alias("genre")).distinct()
    return s.groupBy("genre").agg(F.count("*").alias("n_stories"))


@query("category_infer", f"""
WITH d AS ({D}), l AS (SELECT doc_id, lower(concat_ws(' ', coalesce(title, ''), t)) AS a, lower(t) AS b FROM d)
SELECT doc_id, {M.sql_case('a', M.CATEGORY, 'contemporary')} AS category, {M.sql_case('b', M.HEAT, 'moderate')} AS heat FROM l""")
def category_infer(spark, d):
    return docs(spark, d).select("doc_id", M.category(F.col("title"), F.col("text")).alias("category"), M.heat(F.col("text")).alias("heat"))


_HEAD = r"\b(?:chapter|prologue|contents|entry in)\b"


@query("header_metadata", f"""
WITH d AS ({D}), a AS (SELECT doc_id, {X.strip("string_split(replace(substring(t, 1, 400), chr(13) || chr(10), chr(10)), chr(10))[1]")} AS l FROM d),
b AS (SELECT doc_id, {X.strip("regexp_split_to_array(l, '\\s{3,}')[1]")} AS l FROM a),
c AS (SELECT doc_id, CASE WHEN regexp_matches(l, '(?i){_HEAD}') AND length(regexp_extract(l, '(?i)^(.*?){_HEAD}', 1)) >= 11 THEN {X.strip(f"regexp_extract(l, '(?i)^(.*?){_HEAD}', 1)")} ELSE l END AS l FROM b),
w AS (SELECT doc_id, {X.words('l')} AS w FROM c), k AS (SELECT doc_id, w, trim(array_to_string(list_slice(w, 3, len(w)), ' '), ' .') AS title FROM w),
o AS (SELECT *, coalesce(len(w) >= 3 AND regexp_matches(w[1], '^\\p{{Lu}}') AND regexp_matches(w[2], '^\\p{{Lu}}') AND title <> '', false) AS ok FROM k)
SELECT doc_id, CASE WHEN ok THEN w[1] || ' ' || w[2] END AS author, CASE WHEN ok THEN title END AS title FROM o""")
def header_metadata(spark, d):
    return docs(spark, d).select("doc_id", M.header(T.text_of("text")).alias("h")).select("doc_id", "h.*")


@query("url_metadata", """
SELECT DISTINCT url, regexp_replace(list_last(string_split(rtrim(url, '/'), '/')), '^$', '') AS leaf FROM skipped_non_english WHERE url IS NOT NULL""")
def url_metadata(spark, d):
    u = table(spark, d, "skipped_non_english").where("url is not null").select("url").distinct()
    return u.withColumn("leaf", M.url_leaf(F.col("url")))


# --- Classifiers --------------------------------------------------------------------------
_P = f"WITH src AS (SELECT doc_id, source, text AS raw FROM documents), {X.prose_features('src')}"


@query("prose_verdicts", f"""{_P}
SELECT doc_id, reason IS NULL AS keep, reason, CASE WHEN w >= 30 THEN {X.rnd('nl', 4)} ELSE 0 END AS narrative_ratio, CASE WHEN w >= 30 THEN {X.rnd('nw', 4)} ELSE 0 END AS narrative_word_ratio FROM p""")
def prose_verdicts(spark, d):
    return Q.prose(docs(spark, d).select("doc_id", "text"), "text").select("doc_id", "prose.keep", "prose.reason", "prose.narrative_ratio", "prose.narrative_word_ratio")


@query("prose_reason_counts", f"{_P} SELECT coalesce(reason, 'prose') AS reason, count(*) AS n FROM p GROUP BY ALL")
def prose_reason_counts(spark, d):
    p = Q.prose(docs(spark, d).select("doc_id", "text"), "text").select(F.coalesce("prose.reason", F.lit("prose")).alias("reason"))
    return p.groupBy("reason").agg(F.count("*").alias("n"))


_F = f"WITH src AS (SELECT doc_id, source, text AS raw0 FROM documents), {X.fiction('src')}"


def fiction(spark, d):
    return Q.fiction(docs(spark, d).select("doc_id", "source", "text"), "text").select("doc_id", "source", "fiction.*")


@query("fiction_quality", f"""{_F} SELECT doc_id, source, tier, score, reasons, n AS word_count, {X.rnd('uniq', 4)} AS unique_word_ratio, {X.rnd('big', 4)} AS top_bigram_ratio,
{X.rnd('sent', 2)} AS avg_sentence_words, {X.rnd('html', 4)} AS html_char_ratio, lang AS language FROM q""")
def fiction_quality(spark, d):
    return fiction(spark, d)


@query("fiction_tier_by_source", f"{_F} SELECT source, tier, count(*) AS n FROM q GROUP BY ROLLUP (source, tier)")
def fiction_tier_by_source(spark, d):
    return fiction(spark, d).rollup("source", "tier").agg(F.count("*").alias("n"))


@query("fiction_reason_histogram", f"{_F} SELECT r AS reason, count(*) AS n FROM (SELECT unnest(reasons) AS r FROM q) GROUP BY r")
def fiction_reason_histogram(spark, d):
    return fiction(spark, d).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("tier_gate", f"{_F} SELECT doc_id, tier FROM q WHERE tier <> 'drop'")
def tier_gate(spark, d):
    return fiction(spark, d).where(Q.tier_emits(F.col("tier"), "keep+review")).select("doc_id", "tier")


@query("language_fallback", f"WITH d AS ({D}) SELECT doc_id, {X.rnd(X.english_ratio('t'), 4)} AS english_ratio, {X.language('t')} AS language FROM d")
def language_fallback(spark, d):
    c = T.text_of("text")
    return docs(spark, d).select("doc_id", T.rounded(Q.english_ratio(c), 4).alias("english_ratio"), Q.language(c).alias("language"))


_META = " + ".join(f"CASE WHEN contains(lower(t), '{X.esc(m)}') THEN 1 ELSE 0 END" for m in Q.META)


@query("page_quality", f"""
WITH d AS (SELECT doc_id, {X.strip("coalesce(text, '')")} AS t FROM documents), a AS (SELECT doc_id, t, regexp_extract_all(lower(t), '[a-z'']+') AS w, {X.words('t')} AS k FROM d),
b AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0 END AS u, CASE WHEN len(w) > 0 THEN list_max(map_values(list_aggregate(w, 'histogram'))) ELSE 0 END AS dom,
  list_transform(range(1, greatest(len(k) - 1, 1)), lambda i: k[i] || ' ' || k[i + 1] || ' ' || k[i + 2]) AS g FROM a),
g1 AS (SELECT doc_id, p, count(*) AS c FROM (SELECT doc_id, unnest(g) AS p FROM b WHERE len(k) >= 12) GROUP BY ALL),
g2 AS (SELECT doc_id, max(c) AS c, min_by(p, (-c, p)) AS p FROM g1 GROUP BY doc_id),
m AS (SELECT b.*, ({_META}) AS meta, len(list_filter({X.lines('t')}, lambda x: regexp_matches(x, '{X.esc(Q.PLANNING)}'))) AS plan, g2.c AS gc, g2.p AS gp FROM b LEFT JOIN g2 USING (doc_id)),
i AS (SELECT doc_id, n, u, list_filter([CASE WHEN n < 8 THEN 'too_short' END, CASE WHEN n >= 8 AND u < 0.12 THEN 'low_variety' END, CASE WHEN n >= 10 AND dom > 0.35 * n THEN 'repetitive_token' END,
  CASE WHEN gc >= 4 AND length(gp) * gc > 0.25 * length(t) THEN 'repeated_phrase' END, CASE WHEN meta > 2 OR plan >= 4 THEN 'model_reasoning' END,
  CASE WHEN regexp_matches(t, '(?:\\b\\d+\\b[\\s,]){{12,}}') THEN 'numeric_spam' END], lambda x: x IS NOT NULL) AS issues FROM m)
SELECT doc_id, len(issues) = 0 AS ok, issues, n AS word_count, {X.rnd('u', 4)} AS unique_word_ratio FROM i""")
def page_quality(spark, d):
    return Q.page_quality(docs(spark, d).select("doc_id", "text"), "text").select("doc_id", "page.*")


_PB = " + ".join(f"CASE WHEN regexp_matches(h, '{X.esc(p)}') THEN 1 ELSE 0 END" for p in M.PLAY_BODY)


@query("play_detect", f"""
WITH a AS (SELECT doc_id, coalesce(title, '') AS t, substring(coalesce(text, ''), 1, 15000) AS h FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, '{M.NOVEL}') THEN NULL WHEN regexp_matches(t, '{M.PLAY_TITLE}') THEN 'title' WHEN {_PB} >= 3 THEN 'body'
WHEN len(regexp_extract_all(h, '{X.esc(M.PLAY_BODY[3])}')) >= 20 THEN 'stage_directions' END AS play FROM a""")
def play_detect(spark, d):
    return docs(spark, d).select("doc_id", M.play(F.col("title"), F.col("text")).alias("play"))


@query("kb_categories", f"""
WITH b AS (SELECT item_id, lower(concat_ws(' ', prompt, substring(item_text, 1, 800))) AS b FROM eval_items),
h AS (SELECT item_id, list_filter([{', '.join(f"CASE WHEN {' OR '.join(f'contains(b, {chr(39)}{k}{chr(39)})' for k in ks)} THEN '{n}' END" for n, ks in retrieval.CATEGORIES.items())}], lambda x: x IS NOT NULL) AS c FROM b)
SELECT item_id, CASE WHEN len(c) > 0 THEN c ELSE ['general'] END AS categories FROM h""")
def kb_categories(spark, d):
    return table(spark, d, "eval_items").select("item_id", retrieval.categories(F.col("prompt"), F.col("item_text")).alias("categories"))


# --- Chunks and segments ------------------------------------------------------------------
@query("sentence_chunks", f"""
WITH RECURSIVE d AS ({D}), a AS (SELECT doc_id, t, {X.sents('t')} AS s, {X.wc('t')} AS n FROM d),
b AS (SELECT doc_id, t, s, n, list_transform(s, lambda x: {X.wc('x')}) AS c FROM a WHERE len(s) > 0),
r AS (SELECT doc_id, i, unnest(range(i + 1, len(c) + 1)) AS e, c, len(c) AS m FROM (SELECT doc_id, c, unnest(range(0, len(c))) AS i FROM b WHERE n > 750)),
nx AS (SELECT doc_id, i, m, coalesce(min(e) FILTER (WHERE list_sum(list_slice(c, i + 1, e)) >= 500), m) AS e FROM r GROUP BY doc_id, i, m),
w AS (SELECT doc_id, i, e, m FROM nx WHERE i = 0
      UNION ALL SELECT nx.doc_id, nx.i, nx.e, nx.m FROM w JOIN nx ON nx.doc_id = w.doc_id AND w.e < w.m AND nx.i = greatest(w.i + 1, w.e - 2)),
k AS (SELECT w.doc_id, w.i, array_to_string(list_slice(b.s, w.i + 1, w.e), ' ') AS chunk FROM w JOIN b USING (doc_id)),
l AS (SELECT doc_id, i, chunk FROM k WHERE {X.wc('chunk')} >= 30 UNION ALL SELECT doc_id, 0, {X.strip('t')} FROM b WHERE n <= 750)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_index, count(*) OVER (PARTITION BY doc_id) AS total_chunks, md5(chunk) AS hash, {X.wc('chunk')} AS word_count FROM l""")
def sentence_chunks(spark, d):
    c = chunking.sentence_chunks(docs(spark, d), "doc_id", "text")
    return c.select("doc_id", "chunk_index", "total_chunks", F.md5(F.col("chunk").cast("binary")).alias("hash"), "word_count")


@query("fixed_chunks", f"""
WITH d AS ({D}), a AS (SELECT doc_id, t, {X.words('t')} AS w FROM d), b AS (SELECT * FROM a WHERE len(w) > 0),
c AS (SELECT doc_id, 0 AS chunk_index, t AS chunk FROM b WHERE len(w) <= 500
      UNION ALL SELECT doc_id, i, array_to_string(list_slice(w, i * 450 + 1, i * 450 + 500), ' ') FROM (SELECT doc_id, w, unnest(range(0, CAST(ceil((len(w) - 500) / 450.0) AS INTEGER) + 1)) AS i FROM b WHERE len(w) > 500))
SELECT doc_id, chunk_index, md5(chunk) AS hash FROM c""")
def fixed_chunks(spark, d):
    return chunking.fixed_chunks(docs(spark, d), "doc_id", "text").select("doc_id", "chunk_index", F.md5(F.col("chunk").cast("binary")).alias("hash"))


@query("byte_segments", """
WITH RECURSIVE s AS (SELECT source, doc_id, strlen(coalesce(text, '')) + 1 AS bytes, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
r AS (SELECT source, doc_id, bytes, k, 0 AS segment, bytes AS held FROM s WHERE k = 1
      UNION ALL SELECT s.source, s.doc_id, s.bytes, s.k, CASE WHEN r.held > 0 AND r.held + s.bytes > 50000 THEN r.segment + 1 ELSE r.segment END,
        CASE WHEN r.held > 0 AND r.held + s.bytes > 50000 THEN s.bytes ELSE r.held + s.bytes END FROM r JOIN s ON s.source = r.source AND s.k = r.k + 1)
SELECT source, doc_id, bytes, segment FROM r""")
def byte_segments(spark, d):
    rows = docs(spark, d).select("source", "doc_id", (F.octet_length(T.text_of("text")) + 1).alias("bytes"))
    return chunking.byte_segments(rows, "source", "doc_id", "bytes", 50_000)


_STATE = """WITH s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, corpus DESC NULLS LAST, segment_index DESC NULLS LAST, input_path DESC NULLS LAST, styled_path DESC NULLS LAST, bytes DESC NULLS LAST) AS rn
FROM segment_records), l AS (SELECT * FROM s WHERE rn = 1)"""


def state(spark, d):
    return segments.latest(table(spark, d, "segment_records"))


@query("ledger_summary", f"""{_STATE} SELECT corpus, count(*) AS n_segments, count(*) FILTER (WHERE classification_status = 'pending') AS n_pending,
count(*) FILTER (WHERE classification_status = 'in_progress') AS n_in_progress, count(*) FILTER (WHERE classification_status = 'classified') AS n_classified,
count(*) FILTER (WHERE training_status = 'available') AS n_available, count(*) FILTER (WHERE training_status = 'allocated') AS n_allocated, count(*) FILTER (WHERE training_status = 'trained') AS n_trained,
sum(CASE WHEN training_status = 'available' THEN bytes ELSE 0 END) AS available_bytes, sum(CASE WHEN training_status = 'trained' THEN bytes ELSE 0 END) AS trained_bytes FROM l GROUP BY corpus""")
def ledger_summary(spark, d):
    return segments.summary(state(spark, d))


@query("budget_pick", f"""{_STATE}, p AS (SELECT corpus, id, bytes, sum(bytes) OVER w AS running_bytes, row_number() OVER w AS n FROM l WHERE bytes > 0
WINDOW w AS (PARTITION BY corpus ORDER BY segment_index, id ROWS UNBOUNDED PRECEDING)) SELECT corpus, id, bytes, running_bytes FROM p WHERE running_bytes <= 50000000 OR n = 1""")
def budget_pick(spark, d):
    s = state(spark, d).where("bytes > 0").withColumn("k", F.struct("segment_index", "id"))
    return segments.budget_prefix(s, "corpus", "k", "bytes", 50_000_000).select("corpus", "id", "bytes", "running_bytes")


@query("next_pending", f"""{_STATE}, p AS (SELECT corpus, id, row_number() OVER (PARTITION BY corpus ORDER BY CASE classification_status WHEN 'in_progress' THEN 0 ELSE 1 END, segment_index, id) AS n
FROM l WHERE classification_status IN ('in_progress', 'pending')) SELECT corpus, id FROM p WHERE n = 1""")
def next_pending(spark, d):
    return segments.next_pending(state(spark, d), "corpus", "segment_index")


# --- Records ------------------------------------------------------------------------------
@query("dedup_last_wins", """
WITH k AS (SELECT concat_ws('|', source, chunk_index, substring(coalesce(text, ''), 1, 60)) AS k, chunk_id, ingested_at FROM chunks)
SELECT md5(k) AS key, max(ingested_at) AS ingested_at, max_by(chunk_id, (ingested_at, chunk_id)) AS chunk_id, min(ingested_at) AS first_seen FROM k GROUP BY k""")
def dedup_last_wins(spark, d):
    k = chunks(spark, d).select(F.md5(records.record_key(F.col("source"), F.col("chunk_index"), F.col("text")).cast("binary")).alias("key"), "ingested_at", "chunk_id")
    return records.last_wins(k, ["key"], ["ingested_at"])


@query("duplicate_keys", "SELECT chunk_id, count(*) AS n FROM chunks GROUP BY chunk_id HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return records.duplicate_keys(chunks(spark, d), ["chunk_id"])


@query("resume_pending", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM subject_labels)")
def resume_pending(spark, d):
    return records.pending(docs(spark, d).select("doc_id", "source"), table(spark, d, "subject_labels"), ["doc_id"])


@query("corpus_validation", f"""
WITH c AS (SELECT DISTINCT chunk_id, source, text, split, word_count FROM chunks)
SELECT source, count(*) AS n, count(*) FILTER (WHERE text IS NULL) AS n_null_text, count(*) FILTER (WHERE split IS NULL) AS n_null_split,
count(*) FILTER (WHERE word_count <> {X.wc("coalesce(text, '')")}) AS n_stale_counts FROM c GROUP BY source""")
def corpus_validation(spark, d):
    c = chunks(spark, d).select("chunk_id", "source", "split", "word_count", F.col("text").isNull().alias("no_text"), T.word_count(T.text_of("text")).alias("n")).distinct()
    return c.groupBy("source").agg(F.count("*").alias("n"), F.count_if("no_text").alias("n_null_text"), F.count_if(F.col("split").isNull()).alias("n_null_split"),
                                   F.count_if(F.col("word_count") != F.col("n")).alias("n_stale_counts"))


@query("record_labels", "SELECT DISTINCT story_id, concat_ws(' | ', nullif(title, ''), nullif(author, ''), nullif(pub_month, '')) AS label FROM stories")
def record_labels(spark, d):
    s = table(spark, d, "stories")
    return s.select("story_id", records.record_label(F.col("title"), F.col("author"), F.col("pub_month")).alias("label")).distinct()


@query("running_headers", f"""
WITH l AS (SELECT story_id, {X.lines("coalesce(text, '')")}[1] AS line FROM chunks)
SELECT story_id, line, count(*) AS n FROM l WHERE line IS NOT NULL GROUP BY ALL HAVING count(*) >= 3""")
def running_headers(spark, d):
    return records.first_line_repeats(chunks(spark, d), "story_id", "text")


@query("author_index", "SELECT author_slug, split, count(DISTINCT chunk_id) AS n FROM chunks GROUP BY GROUPING SETS ((author_slug), (split))")
def author_index(spark, d):
    one = chunks(spark, d).select("chunk_id", "author_slug", "split").distinct()
    return one.groupingSets([["author_slug"], ["split"]], "author_slug", "split").agg(F.count("*").alias("n")).select("author_slug", "split", "n")


@query("union_batch", "SELECT source, split, count(*) AS n FROM (SELECT * FROM chunks WHERE split = 'train' UNION ALL SELECT * FROM chunks WHERE split = 'test') GROUP BY ALL")
def union_batch(spark, d):
    c = chunks(spark, d)
    return c.where("split = 'train'").unionByName(c.where("split = 'test'")).groupBy("source", "split").agg(F.count("*").alias("n"))


@query("expansion_inventory", f"""
WITH d AS ({D}), s AS (SELECT source, {X.wc('t')} AS n FROM d)
SELECT source, count(*) AS rows_in, CAST(sum(greatest(1, CAST(ceil((n - 500) / 450.0) AS INTEGER) + 1)) AS BIGINT) AS rows_out, count(*) FILTER (WHERE n > 500) AS rows_split, CAST(floor(avg(n)) AS BIGINT) AS mean_words
FROM s WHERE n > 0 GROUP BY ROLLUP (source)""")
def expansion_inventory(spark, d):
    n = F.col("n")
    out = F.greatest(F.lit(1), F.ceil((n - 500) / F.lit(450.0)).cast("int") + 1)
    s = docs(spark, d).select("source", T.word_count(T.text_of("text")).alias("n")).where(n > 0)
    return s.rollup("source").agg(F.count("*").alias("rows_in"), F.sum(out).alias("rows_out"), F.count_if(n > 500).alias("rows_split"), F.floor(F.avg(n)).alias("mean_words"))


@query("unified_records")
def unified_records(spark, d):
    u = records.unified(docs(spark, d), "text", "source", "source", author="lang", title="title", record_index="doc_id")
    return u.select(F.md5(F.col("text").cast("binary")).alias("hash"), "metadata")


# --- Samples, pairs ------------------------------------------------------------------------
@query("sample_k", "SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100")
def sample_k(spark, d):
    return sampling.sample(docs(spark, d).select("doc_id"), "doc_id", 100)


@query("train_val_split", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN k <= floor(n * 0.1) THEN 'validation' ELSE 'train' END AS part FROM r""")
def train_val_split(spark, d):
    return sampling.split_by_fraction(docs(spark, d).select("doc_id"), "doc_id", 0.1)


_PICK = lambda seed, key: f"CAST('0x' || substring(md5('{seed}|' || {key}), 1, 8) AS BIGINT)"
_DIMS = sorted(pairs.ASK)


@query("instruction_choices", f"""
WITH d AS ({D}), b AS (SELECT doc_id FROM d WHERE {X.wc('t')} >= 20),
a AS (SELECT doc_id, dim, row_number() OVER (PARTITION BY doc_id ORDER BY md5('42|' || doc_id || '|' || dim), dim) AS k FROM b, (SELECT unnest([{', '.join(repr(x) for x in _DIMS)}]) AS dim))
SELECT doc_id, 'classification' AS task_type, CAST(NULL AS VARCHAR) AS dimension, [{', '.join("'" + X.esc(x) + "'" for x in pairs.CLASSIFY)}][{_PICK('42c', 'doc_id')} % {len(pairs.CLASSIFY)} + 1] AS instruction FROM b
UNION ALL SELECT doc_id, 'judgment', dim, CASE dim {' '.join(f"WHEN '{x}' THEN [" + ', '.join("'" + X.esc(y) + "'" for y in pairs.ASK[x]) + f"][{_PICK('42' + x, 'doc_id')} % {len(pairs.ASK[x])} + 1]" for x in _DIMS)} END FROM a WHERE k <= 2""")
def instruction_choices(spark, d):
    p = pairs.instruction_pairs(S.metrics(docs(spark, d).select("doc_id", "text"), "text"), "doc_id", "text", "style", judgments=2)
    return p.select("doc_id", "task_type", "dimension", "instruction")


@query("instruction_pairs")
def instruction_pairs(spark, d):
    p = pairs.instruction_pairs(S.metrics(docs(spark, d).select("doc_id", "source", "text"), "text"), "doc_id", "text", "style")
    return p.select("doc_id", "task_type", "dimension", "instruction", "output")


@query("pair_counts", f"""
WITH d AS ({D}) SELECT task_type, count(*) * k AS n FROM d, (VALUES ('classification', 1), ('judgment', 3)) v(task_type, k) WHERE {X.wc('t')} >= 20 GROUP BY task_type, k""")
def pair_counts(spark, d):
    return instruction_pairs(spark, d).groupBy("task_type").agg(F.count("*").alias("n"))


# --- Retrieval, evaluation ------------------------------------------------------------------
_TK = lambda t: f"list_distinct(regexp_extract_all(lower({t}), '[a-z]{{3,}}'))"


@query("kb_top_k", f"""
WITH q AS (SELECT DISTINCT story_id, title FROM stories WHERE title IS NOT NULL), qt AS (SELECT story_id, title, {_TK('title')} AS tok FROM q),
k AS (SELECT item_id, {_TK("concat_ws(' ', prompt, item_text)")} AS tok FROM eval_items),
s AS (SELECT story_id, title, item_id, len(list_intersect(qt.tok, k.tok)) AS score FROM qt, k),
r AS (SELECT *, row_number() OVER (PARTITION BY story_id, title ORDER BY score DESC, item_id) AS rank FROM s)
SELECT story_id, item_id, score, rank FROM r WHERE rank <= 3 AND score > 0""")
def kb_top_k(spark, d):
    # one exchange for the distinct rows, with a stated number of partitions that is kept for the scoring
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    q = table(spark, d, "stories").where("title is not null").select("story_id", "title").repartition(n, "story_id", "title").distinct()
    plain = table(spark, d, "eval_items")
    return retrieval.top_k(q, "story_id", "title", plain, "item_id", "prompt", "item_text", use_categories=False)


@query("case_cross", "SELECT suite, subject FROM (SELECT DISTINCT suite FROM eval_items), subjects")
def case_cross(spark, d):
    s = table(spark, d, "eval_items").select("suite").distinct()
    return s.crossJoin(F.broadcast(table(spark, d, "subjects").select("subject")))  # the subjects are a fixed small table


_FIELDS = ["source", "author_slug", "title_slug", "split", "total_chunks"]
_RUN = f"""WITH c AS (SELECT DISTINCT chunk_id, story_id, chunk_index, source, author_slug, title_slug, split, CAST(total_chunks AS VARCHAR) AS total_chunks FROM chunks),
s AS (SELECT story_id, max(source) AS source, max(author_slug) AS author_slug, max(title_slug) AS title_slug, max(split) AS split, CAST(max(total_chunks) AS VARCHAR) AS total_chunks FROM stories GROUP BY story_id),
r AS (SELECT c.chunk_id, c.story_id, c.chunk_index, s.source AS plot, coalesce(s.split, 'none') AS scene, {' + '.join(f'CASE WHEN s.{f} IS NULL THEN 0 ELSE 1 END' for f in _FIELDS)} AS compared,
  {' + '.join(f'CASE WHEN s.{f} = c.{f} THEN 1 ELSE 0 END' for f in _FIELDS)} AS matched FROM c JOIN s USING (story_id)),
e AS (SELECT *, CASE WHEN compared > 0 THEN {X.rnd('matched / compared', 4)} END AS score FROM r)"""


def run(spark, d):
    """The labels of a chunk held against those of its story."""
    s = table(spark, d, "stories").groupBy("story_id").agg(*[F.max(f).alias(f) for f in _FIELDS])
    target = s.select("story_id", F.create_map(*[x for f in _FIELDS for x in (F.lit(f), F.col(f).cast("string"))]).alias("target"), F.col("source").alias("plot"), F.coalesce("split", F.lit("none")).alias("scene"))
    actual = chunks(spark, d).select("chunk_id", "story_id", "chunk_index", *_FIELDS).distinct()
    actual = actual.select("chunk_id", "story_id", "chunk_index", F.create_map(*[x for f in _FIELDS for x in (F.lit(f), F.col(f).cast("string"))]).alias("actual"))
    return actual.join(target, "story_id").withColumn("delta", runs.delta(F.col("target"), F.col("actual"), _FIELDS))


@query("eval_delta", f"{_RUN} SELECT chunk_id, compared, matched, score FROM e")
def eval_delta(spark, d):
    return run(spark, d).select("chunk_id", "delta.compared", "delta.matched", "delta.score")


@query("eval_summary", f"{_RUN} SELECT plot, scene, count(*) AS n, {X.rnd('sum(score) / count(score)', 4)} AS mean_score FROM e GROUP BY GROUPING SETS ((), (plot), (scene))")
def eval_summary(spark, d):
    return runs.summary(run(spark, d).withColumn("score", F.col("delta.score")), "plot", "scene", "score")


@query("eval_hit_rates", _RUN.replace("r AS (SELECT c.chunk_id", "hits AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, coalesce(s.{f} = c.{f}, false) AS hit FROM c JOIN s USING (story_id) WHERE s.{f} IS NOT NULL" for f in _FIELDS) + "), r AS (SELECT c.chunk_id")
    + f" SELECT field, count(*) AS n, {X.rnd('avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END)', 4)} AS hit_rate FROM hits GROUP BY field")
def eval_hit_rates(spark, d):
    return runs.hit_rates(run(spark, d).select(F.col("delta.matches").alias("m")), "m")


@query("eval_compare", f"""{_RUN}, b AS (SELECT story_id, plot, max_by(score, chunk_id) AS base_score FROM e WHERE chunk_index = 0 GROUP BY ALL),
n AS (SELECT story_id, plot, max_by(score, chunk_id) AS cand_score FROM e WHERE chunk_index = 1 GROUP BY ALL)
SELECT story_id, plot, base_score, cand_score, {X.rnd('cand_score - base_score', 4)} AS delta,
CASE WHEN cand_score > base_score THEN 'improved' WHEN cand_score < base_score THEN 'regressed' WHEN cand_score = base_score THEN 'unchanged' END AS direction FROM b JOIN n USING (story_id, plot)""")
def eval_compare(spark, d):
    r = run(spark, d).select("story_id", "plot", "chunk_id", "chunk_index", F.col("delta.score").alias("score"))
    side = lambda i: records.last_wins(r.where(F.col("chunk_index") == i).drop("chunk_index"), ["story_id", "plot"], ["chunk_id"])
    return runs.compare(side(0), side(1), ["story_id", "plot"], "score")


@query("eval_trend", f"""{_RUN}, m AS (SELECT chunk_index, count(*) AS n, {X.rnd('sum(score) / count(score)', 4)} AS mean_score FROM e GROUP BY chunk_index),
t AS (SELECT *, {X.rnd('mean_score - lag(mean_score) OVER (ORDER BY chunk_index)', 4)} AS step_delta, {X.rnd('mean_score - first(mean_score) OVER (ORDER BY chunk_index)', 4)} AS base_delta FROM m)
SELECT *, CASE WHEN step_delta > 0 THEN 'up' WHEN step_delta < 0 THEN 'down' WHEN step_delta = 0 THEN 'flat' END AS direction FROM t""")
def eval_trend(spark, d):
    return runs.trend(run(spark, d).withColumn("score", F.col("delta.score")), "chunk_index", "score")


@query("throughput_window", """
SELECT event_id, (count(*) OVER w - 1) / greatest((epoch_us(max(ts) OVER w) - epoch_us(min(ts) OVER w)) / 1e6, 0.01) AS rate FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def throughput_window(spark, d):
    return runs.rolling_rate(table(spark, d, "events"), "user_id", "ts", "event_id").select("event_id", "rate")


@query("stream_last_wins", f"{_STATE} SELECT id, corpus, segment_index, bytes, updated_at FROM l")
def stream_last_wins(spark, d):
    return resume.replay_last_wins(spark, f"{d}/segment_records.parquet", "id", "updated_at").select("id", "corpus", "segment_index", "bytes", "updated_at")
