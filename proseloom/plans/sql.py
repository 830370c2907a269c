"""Fragments of the checking SQL."""

from __future__ import annotations

from ..functions import quality as Q, text as T

WS = f"[{T.SPACE}]"


def esc(p: str) -> str:
    return p.replace("'", "''")


def strip(t: str) -> str:
    return f"regexp_replace({t}, '^{WS}+|{WS}+$', '', 'g')"


def words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '{WS}+'), lambda w: w <> '')"


def wc(t: str) -> str:
    return f"len({words(t)})"


def sents(t: str) -> str:
    marked = f"""regexp_replace({strip(t)}, '([.!?]){WS}+([A-Z"''])', '\\1' || chr(1) || '\\2', 'g')"""
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda x: {strip('x')}), lambda x: x <> '')"


def lines(t: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({t}, '{T.LINE_END}'), lambda x: {strip('x')}), lambda x: x <> '')"


def rnd(x: str, k: int) -> str:
    return f"floor(({x}) * 1e{k} + 0.5) / 1e{k}"


def has(t: str, name: str) -> str:
    return f"regexp_matches({t}, '{esc(Q.PROSE_PATTERNS[name])}')"


def hits(t: str, name: str) -> str:
    return f"len(regexp_extract_all({t}, '{esc(Q.PROSE_PATTERNS[name])}'))"


def html(t: str) -> str:
    return strip(f"regexp_replace(regexp_replace(regexp_replace({t}, '{T.TAG}', ' ', 'g'), '{T.ENTITY}', ' ', 'g'), '{WS}+', ' ', 'g')")


def prose_features(src: str, least: int = 30) -> str:
    """CTE bodies from rows (id, raw): f with the features, p with the verdict."""
    nw = (
        f"list_sum(list_transform(list_filter(list_transform(string_split(regexp_replace(t, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda x: {strip('x')}), "
        f"lambda s: {wc('s')} >= 8 AND regexp_matches(s, '[a-z]') AND NOT {has('s', 'catalog_sentence')}), lambda s: {wc('s')}))")
    ratio = lambda name: f"CASE WHEN len(l) > 0 THEN len(list_filter(l, lambda x: {has('x', name)})) / len(l) ELSE 0 END"
    flags = ", ".join(f"{has('t', n)} AS {n}" for n in ("transcriber", "license", "toc", "illustrations", "divider", "works_by", "errata_header", "the_end"))
    nums = ", ".join(f"{hits('t', n)} AS n_{n}" for n in ("metadata", "wiki", "price", "toc_entry", "toc_dotted", "errata_row", "verse"))
    return f"""
f0 AS (SELECT *, {strip("coalesce(raw, '')")} AS t FROM {src}),
f1 AS (SELECT *, {wc('t')} AS w, {lines('t')} AS l FROM f0),
f AS (SELECT *, {flags}, {nums}, CASE WHEN w > 0 THEN coalesce({nw}, 0) / w ELSE 0 END AS nw, {ratio('narrative_line')} AS nl, {ratio('catalog_line')} AS cl,
  len(list_filter(l, lambda x: length(x) > 20 AND regexp_matches(x, '\\p{{Lu}}') AND NOT regexp_matches(x, '\\p{{Ll}}'))) AS caps FROM f1),
p AS (SELECT *, CASE WHEN w < {least} THEN 'too_short'
  WHEN errata_header OR n_errata_row >= 4 THEN 'errata_corrections' WHEN n_verse >= 3 THEN 'verse_appendix'
  WHEN the_end AND n_errata_row >= 2 THEN 'errata_corrections' WHEN nw >= 0.45 THEN NULL
  WHEN nw < 0.35 AND ((n_price >= 2 AND (n_wiki >= 1 OR works_by OR divider)) OR (n_price >= 1 AND divider AND n_wiki >= 1) OR (works_by AND n_price >= 1) OR (cl >= 0.45 AND n_price >= 1)) THEN 'publisher_catalog'
  WHEN transcriber AND nw < 0.15 AND w < 250 THEN 'transcriber_credits' WHEN license AND nw < 0.15 AND w < 250 THEN 'gutenberg_license'
  WHEN toc AND n_toc_entry + n_toc_dotted >= 4 AND nw < 0.2 THEN 'table_of_contents' WHEN illustrations AND nw < 0.2 THEN 'illustration_index'
  WHEN n_toc_entry + n_toc_dotted >= 8 AND nw < 0.15 THEN 'table_of_contents' WHEN caps >= 6 AND nw < 0.1 AND w < 400 THEN 'structural_index'
  WHEN n_metadata >= 3 AND nw < 0.12 AND w < 200 THEN 'metadata_block' END AS reason FROM f)"""


def english_ratio(t: str) -> str:
    w = f"list_slice({words(f'lower({t})')}, 1, 500)"
    return f"CASE WHEN {wc(t)} > 0 THEN len(list_filter({w}, lambda x: regexp_matches(x, '^(?:{Q.ENGLISH})(?:$|[^\\p{{L}}\\p{{N}}_])'))) / len({w}) ELSE 0 END"


def language(t: str) -> str:
    return f"CASE WHEN regexp_matches(substring({t}, 1, 4000), '{Q.OTHER_SCRIPTS}') THEN 'non_en' WHEN {english_ratio(t)} >= 0.04 THEN 'en' ELSE 'unknown' END"


def fiction(src: str) -> str:
    """CTE bodies from rows (id, raw0): q with tier, score, reasons and features."""
    bigrams = "list_transform(range(1, len(ws)), lambda i: lower(ws[i]) || ' ' || lower(ws[i + 1]))"
    sent = f"list_filter(list_transform(regexp_split_to_array(t, '[.!?]+'), lambda x: {wc('x')}), lambda n: n >= 3)"
    hard, soft = (", ".join(f"'{x}'" for x in xs) for xs in (Q.HARD, Q.SOFT))
    return f"""
h0 AS (SELECT *, {strip("coalesce(raw0, '')")} AS r0 FROM {src}),
h AS (SELECT *, {html('r0')} AS raw FROM h0), {prose_features('h', 200)},
g0 AS (SELECT *, {words('t')} AS ws FROM p),
g AS (SELECT *, len(ws) AS n,
  CASE WHEN len(ws) > 0 THEN len(list_distinct(list_transform(ws, lambda x: lower(x)))) / len(ws) ELSE 0 END AS uniq,
  CASE WHEN len(ws) >= 50 THEN list_max(map_values(list_aggregate({bigrams}, 'histogram'))) / (len(ws) - 1) ELSE 0 END AS big,
  CASE WHEN len({sent}) > 0 THEN list_sum({sent}) / len({sent}) ELSE 0 END AS sent,
  CASE WHEN length(r0) > 0 THEN (2 * length(r0) - length(regexp_replace(r0, '{T.TAG}', '', 'g')) - length(regexp_replace(r0, '{T.ENTITY}', '', 'g'))) / length(r0) ELSE 0 END AS html,
  CASE WHEN length(t) > 0 THEN length(regexp_replace(t, '[^\\p{{L}}{T.SPACE}]', '', 'g')) / length(t) ELSE 0 END AS alpha, {language('t')} AS lang FROM g0),
k AS (SELECT *, list_filter([CASE WHEN lang <> 'en' THEN 'non_english' END, reason, CASE WHEN n < 200 THEN 'too_short' END, CASE WHEN n >= 200 AND n < 500 THEN 'short' END,
  CASE WHEN alpha < 0.78 THEN 'garbled' END, CASE WHEN uniq < 0.3 THEN 'low_vocab' END, CASE WHEN big > 0.07 THEN 'repetitive' END, CASE WHEN html > 0.12 THEN 'html_heavy' END,
  CASE WHEN regexp_matches(substring(r0, 1, 500), '{Q.DISCLAIMER}') AND n < 500 THEN 'disclaimer_only' END, CASE WHEN regexp_matches(r0, '{Q.FORUM}') AND n < 800 THEN 'forum_boilerplate' END,
  CASE WHEN sent < 4 AND n > 300 THEN 'fragmentary' END], lambda x: x IS NOT NULL) AS reasons,
  (100 - CASE WHEN lang <> 'en' THEN 50 ELSE 0 END - CASE WHEN reason IS NOT NULL THEN 40 ELSE 0 END - CASE WHEN n < 200 THEN 50 WHEN n < 500 THEN 15 ELSE 0 END
   - CASE WHEN alpha < 0.78 THEN 35 ELSE 0 END - CASE WHEN uniq < 0.3 THEN 25 ELSE 0 END - CASE WHEN big > 0.07 THEN 25 ELSE 0 END - CASE WHEN html > 0.12 THEN 10 ELSE 0 END
   - CASE WHEN regexp_matches(substring(r0, 1, 500), '{Q.DISCLAIMER}') AND n < 500 THEN 20 ELSE 0 END - CASE WHEN regexp_matches(r0, '{Q.FORUM}') AND n < 800 THEN 15 ELSE 0 END
   - CASE WHEN sent < 4 AND n > 300 THEN 15 ELSE 0 END) / 100 AS s FROM g),
q AS (SELECT *, greatest(0, least(1, s)) AS score, CASE WHEN list_has_any(reasons, [{hard}]) THEN 'drop'
  WHEN list_has_any(reasons, [{soft}]) THEN CASE WHEN s >= 0.4 THEN 'review' ELSE 'drop' END WHEN s >= 0.75 THEN 'keep' WHEN s >= 0.45 THEN 'review' ELSE 'drop' END AS tier FROM k)"""
