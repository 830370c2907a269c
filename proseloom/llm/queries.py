"""Queries of the training-data operators, and their SQL where SQL can state them on whole tables."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..session import spread, table
from . import boilerplate, contamination, encoding, language, leakage, mixing, pieces, quality, splits, subjects


def _chunks(spark, d):
    return spread(table(spark, d, "chunks"))


def _documents(spark, d):
    return spread(table(spark, d, "documents"))


def p1_found(spark, d):
    return splits.group_splits(_chunks(spark, d)).where("split is not null and n_stated >= 2").select("chunk_id")


def p1_split_report(spark, d):
    return splits.report(_chunks(spark, d))


def p1_group_sizes(spark, d):
    return splits.group_sizes(_chunks(spark, d))


def p1_labels(spark, d):
    chunks = _chunks(spark, d)
    return splits.labels(chunks, splits.group_splits(chunks))


def p2_found(spark, d):
    return leakage.overlaps(_chunks(spark, d))


def p2_report(spark, d):
    return leakage.report(_chunks(spark, d))


def p2_classes(spark, d):
    return leakage.class_members(_chunks(spark, d))


def p3_stats(spark, d):
    chunks = _chunks(spark, d)
    return quality.every_chunk(chunks, boilerplate.node_arrays(boilerplate.nodes(chunks)))


def p3_measures(spark, d):
    """The statistics of p3_stats that need no word lists, rounded."""
    r = lambda c: (F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c)
    return p3_stats(spark, d).select("chunk_id", "n_chars", "n_words", "n_lines", r("mean_word_length"), r("symbol_ratio"), r("ended_lines_ratio"))


def p3_found(spark, d):
    chunks = _chunks(spark, d)
    return quality.stats(chunks, boilerplate.node_arrays(boilerplate.nodes(chunks))).where("verdict = 'other'").select("chunk_id")


def p4_found(spark, d):
    return boilerplate.found_lines(_chunks(spark, d)).select("chunk_id", "line_no")


def p4_blocks(spark, d):
    return boilerplate.block_sizes(_chunks(spark, d))


def p4_clean(spark, d):
    return boilerplate.clean(_chunks(spark, d))


def p5_found(spark, d):
    return mixing.shares(table(spark, d, "segment_records"), table(spark, d, "mix_targets")).where("short").select("corpus")


def p5_usable(spark, d):
    """Usable bytes and segments of each corpus."""
    t = table(spark, d, "mix_targets")
    own = mixing.usable_segments(table(spark, d, "segment_records"), t).groupBy("corpus").agg(F.sum("bytes").alias("own_bytes"), F.count("*").alias("n_segments"))
    return t.select("corpus").join(own, "corpus", "left").na.fill(0)


def p5_shares(spark, d):
    return mixing.shares(table(spark, d, "segment_records"), table(spark, d, "mix_targets"))


def p5_schedule(spark, d):
    return mixing.schedule(table(spark, d, "segment_records"), table(spark, d, "mix_targets"))


def p6_found(spark, d):
    return pieces.split_texts(_chunks(spark, d)).where("piece_no = 1").select("chunk_id")


def p6_pieces(spark, d):
    return pieces.split_texts(_chunks(spark, d))


def p6_roundtrip(spark, d):
    """Of every oversized text the digest of its pieces joined without the shared parts, and the pieces that break the limit or the overlap."""
    p = pieces.split_texts(_chunks(spark, d))
    shared = F.coalesce(F.lag("end_char").over(W.partitionBy("chunk_id").orderBy("piece_no")) - F.col("start_char"), F.lit(0))
    p = p.withColumn("shared", shared).withColumn("bad", (F.length("piece") > 4000) | (F.col("piece_no") > 1) & ~F.col("shared").between(1, 200))
    tail = F.array_sort(F.collect_list(F.struct("piece_no", F.expr("substring(piece, shared + 1)").alias("t"))))  # the pieces of one text
    return p.groupBy("chunk_id").agg(F.md5(F.array_join(F.transform(tail, lambda x: x["t"]), "").cast("binary")).alias("hash"), F.count_if("bad").alias("n_bad"))


def p7_found(spark, d):
    return language.unstated(_chunks(spark, d), table(spark, d, "skipped_non_english"))


def p7_languages(spark, d):
    return language.labelled(_chunks(spark, d), table(spark, d, "skipped_non_english"))


def p7_stretches(spark, d):
    return language.stretches(_chunks(spark, d), table(spark, d, "skipped_non_english"))


def p8_ids(spark, d):
    return encoding.encode(_documents(spark, d))


def p8_lengths(spark, d):
    """Tokens, distinct texts and tokens per character by source."""
    docs = _documents(spark, d)
    both = encoding.encode(docs).join(docs.select("doc_id", "source", F.length(F.coalesce("text", F.lit(""))).alias("n")), "doc_id")
    return both.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(F.size("ids")).alias("n_tokens"), F.sum("n").alias("n_chars"))


def p9_found(spark, d):
    return p9_leaks(spark, d).select("doc_id", "item_id")


def p9_leaks(spark, d):
    return contamination.leaks(_documents(spark, d), table(spark, d, "eval_items"))


def p9_report(spark, d):
    """Leaked documents and the longest held passage of each test item that leaked."""
    suites = table(spark, d, "eval_items").select("item_id", "suite")
    return p9_leaks(spark, d).groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("n_words").alias("most_words"), F.count_if(F.col("prompt_part") >= 0.9).alias("n_with_prompt")).join(suites, "item_id")


def _p10(spark, d, what):
    return what(_documents(spark, d), table(spark, d, "subjects"), table(spark, d, "subject_labels"))


def p10_found(spark, d):
    return p10_subjects(spark, d).where(F.col("share") >= subjects.SHARE).select("doc_id", "subject").distinct()


def p10_subjects(spark, d):
    return _p10(spark, d, subjects.about)


def p10_calibration(spark, d):
    return _p10(spark, d, subjects.calibration)


def p10_composition(spark, d):
    return _p10(spark, d, subjects.composition)


def p8_roundtrip(spark, d):
    """Documents by source, and those whose ids decode to their text."""
    docs = _documents(spark, d)
    back = encoding.decode(encoding.encode(docs)).withColumnRenamed("text", "back")
    both = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text")).join(back, "doc_id")
    return both.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(F.col("text") == F.col("back")).alias("n_same"))


QUERIES = {k: v for k, v in dict(globals()).items() if k[0] == "p" and k[1].isdigit()}

ORACLE = {
    "p8_roundtrip": "SELECT source, count(*) AS n_docs, count(*) AS n_same FROM documents GROUP BY source",
    "p4_found": r"""
WITH l AS (
  SELECT DISTINCT chunk_id, source_dataset, i AS line_no, line,
         regexp_replace(lower(line), '[^\p{L}]+', '', 'g') AS k
  FROM (SELECT chunk_id, source_dataset, unnest(string_split(text, chr(10))) AS line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM chunks WHERE source_dataset IS NOT NULL AND text IS NOT NULL)),
n AS (SELECT source_dataset, count(DISTINCT chunk_id) AS n FROM chunks GROUP BY source_dataset),
s AS (SELECT source_dataset, k, count(DISTINCT chunk_id) AS c FROM l WHERE k <> '' GROUP BY source_dataset, k)
SELECT DISTINCT l.chunk_id, CAST(l.line_no AS INTEGER) AS line_no
FROM l JOIN s USING (source_dataset, k) JOIN n USING (source_dataset)
WHERE s.c >= 5 AND s.c >= 0.03 * n.n AND len(list_filter(regexp_split_to_array(line, '\s+'), lambda w: regexp_matches(w, '\p{L}'))) >= 3
""",
    "p4_blocks": r"""
WITH RECURSIVE l AS (
  SELECT DISTINCT chunk_id, source_dataset, i AS line_no, line, regexp_replace(lower(line), '[^\p{L}]+', '', 'g') AS k
  FROM (SELECT chunk_id, source_dataset, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM chunks WHERE source_dataset IS NOT NULL AND text IS NOT NULL)),
n AS (SELECT source_dataset, count(DISTINCT chunk_id) AS n FROM chunks GROUP BY source_dataset),
s AS (SELECT source_dataset, k, count(DISTINCT chunk_id) AS c FROM l WHERE k <> '' GROUP BY source_dataset, k),
h AS (SELECT source_dataset, k, c FROM s JOIN n USING (source_dataset) WHERE c >= 5 AND c >= 0.03 * n.n),
o AS (SELECT chunk_id, source_dataset, line_no, k FROM l JOIN h USING (source_dataset, k) WHERE len(list_filter(regexp_split_to_array(line, '\s+'), lambda w: regexp_matches(w, '\p{L}'))) >= 3),
w AS (SELECT a.source_dataset, a.k, b.k AS k2, count(DISTINCT a.chunk_id) AS w FROM o a JOIN o b ON b.chunk_id = a.chunk_id AND b.source_dataset = a.source_dataset AND b.line_no = a.line_no + 1 GROUP BY ALL),
g AS (SELECT w.source_dataset, w.k, w.k2 FROM w JOIN h a ON a.source_dataset = w.source_dataset AND a.k = w.k JOIN h b ON b.source_dataset = w.source_dataset AND b.k = w.k2 WHERE w.w >= 0.5 * least(a.c, b.c)),
u AS (SELECT source_dataset, k, k2 FROM g UNION SELECT source_dataset, k2, k FROM g),
r AS (SELECT source_dataset, k, k AS root FROM h UNION SELECT r.source_dataset, u.k2, r.root FROM r JOIN u ON u.source_dataset = r.source_dataset AND u.k = r.k),
c AS (SELECT source_dataset, k, min(root) AS root FROM r GROUP BY source_dataset, k)
SELECT source_dataset, count(*) AS n_lines, min(h.c) AS least_support, max(h.c) AS most_support FROM c JOIN h USING (source_dataset, k) GROUP BY source_dataset, root
""",
    "p3_measures": r"""
WITH c AS (SELECT DISTINCT chunk_id, source_dataset, text FROM chunks),
l AS (SELECT chunk_id, source_dataset, i, line, regexp_replace(lower(line), '[^\p{L}]+', '', 'g') AS k
      FROM (SELECT chunk_id, source_dataset, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM c WHERE text IS NOT NULL)),
n AS (SELECT source_dataset, count(DISTINCT chunk_id) AS n FROM c GROUP BY source_dataset),
s AS (SELECT source_dataset, k, count(DISTINCT chunk_id) AS c FROM l WHERE k <> '' AND source_dataset IS NOT NULL GROUP BY source_dataset, k),
h AS (SELECT s.source_dataset, s.k FROM s JOIN n USING (source_dataset) WHERE s.c >= 5 AND s.c >= 0.03 * n.n),
o AS (SELECT chunk_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE h.k IS NULL OR len(list_filter(regexp_split_to_array(line, '\s+'), lambda w: regexp_matches(w, '\p{L}'))) < 3), '') AS text
      FROM l LEFT JOIN h ON h.source_dataset = l.source_dataset AND h.k = l.k GROUP BY chunk_id)
,
e AS (SELECT chunk_id, o.text FROM (SELECT DISTINCT chunk_id FROM c) LEFT JOIN o USING (chunk_id)),
v AS (SELECT chunk_id, text, regexp_extract_all(lower(text), '[\p{L}\p{Nl}\p{No}]+') AS w,
      list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12) || chr(160))), lambda x: x <> '') AS f,
      len(regexp_extract_all(text, '[^\p{L}\p{N}\s\x0b\x{a0}.,;:!?''"\-()…–—«»„“”‘’‹›¿¡]')) AS n_symbols FROM e),
k AS (SELECT chunk_id, coalesce(text IS NOT NULL AND len(f) > 0, false) AS has, length(text) + 1 AS n_chars, len(w) AS n_words, len(f) AS n_lines, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS n_letters, n_symbols,
      len(list_filter(f, lambda x: right(x, 1) IN ('.', '!', '?', '…', '"', chr(39), '”', '’', '»', ';', ',', '-', '—', ':'))) AS n_ended FROM v)
SELECT chunk_id, CAST(CASE WHEN has THEN n_chars ELSE 0 END AS BIGINT) AS n_chars, CAST(CASE WHEN has THEN n_words ELSE 0 END AS BIGINT) AS n_words, CAST(CASE WHEN has THEN n_lines ELSE 0 END AS BIGINT) AS n_lines,
  CASE WHEN has AND n_words > 0 THEN floor(n_letters / n_words * 1e6 + 0.5) / 1e6 ELSE 0 END AS mean_word_length, CASE WHEN has THEN floor(n_symbols / n_chars * 1e6 + 0.5) / 1e6 ELSE 0 END AS symbol_ratio,
  CASE WHEN has THEN floor(n_ended / n_lines * 1e6 + 0.5) / 1e6 ELSE 0 END AS ended_lines_ratio FROM k
""",
    "p4_clean": r"""
WITH c AS (SELECT DISTINCT chunk_id, source_dataset, text FROM chunks),
l AS (SELECT chunk_id, source_dataset, i, line, regexp_replace(lower(line), '[^\p{L}]+', '', 'g') AS k
      FROM (SELECT chunk_id, source_dataset, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM c WHERE text IS NOT NULL)),
n AS (SELECT source_dataset, count(DISTINCT chunk_id) AS n FROM c GROUP BY source_dataset),
s AS (SELECT source_dataset, k, count(DISTINCT chunk_id) AS c FROM l WHERE k <> '' AND source_dataset IS NOT NULL GROUP BY source_dataset, k),
h AS (SELECT s.source_dataset, s.k FROM s JOIN n USING (source_dataset) WHERE s.c >= 5 AND s.c >= 0.03 * n.n),
o AS (SELECT chunk_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE h.k IS NULL OR len(list_filter(regexp_split_to_array(line, '\s+'), lambda w: regexp_matches(w, '\p{L}'))) < 3), '') AS text
      FROM l LEFT JOIN h ON h.source_dataset = l.source_dataset AND h.k = l.k GROUP BY chunk_id)
SELECT chunk_id, o.text FROM (SELECT DISTINCT chunk_id FROM c) LEFT JOIN o USING (chunk_id)
""",
    "p5_found": """
WITH s AS (
  SELECT replace(lower(trim(corpus)), '-', '_') AS k, id, bytes,
         row_number() OVER (PARTITION BY replace(lower(trim(corpus)), '-', '_'), id ORDER BY updated_at DESC, bytes DESC NULLS LAST) AS rn
  FROM segment_records),
own AS (SELECT k, sum(bytes) AS b FROM s WHERE rn = 1 AND bytes > 0 GROUP BY k),
t AS (SELECT m.corpus, m.target_share, m.max_repeats, coalesce(own.b, 0) AS b
      FROM mix_targets m LEFT JOIN own ON own.k = replace(lower(trim(m.corpus)), '-', '_'))
SELECT corpus FROM t WHERE target_share * (SELECT sum(b) FROM t) > max_repeats * b
""",
    "p5_usable": """
WITH s AS (
  SELECT replace(lower(trim(corpus)), '-', '_') AS k, id, bytes,
         row_number() OVER (PARTITION BY replace(lower(trim(corpus)), '-', '_'), id ORDER BY updated_at DESC, bytes DESC NULLS LAST) AS rn
  FROM segment_records),
own AS (SELECT k, sum(bytes) AS b, count(*) AS n FROM s WHERE rn = 1 AND bytes > 0 GROUP BY k)
SELECT m.corpus, CAST(coalesce(own.b, 0) AS BIGINT) AS own_bytes, coalesce(own.n, 0) AS n_segments
FROM mix_targets m LEFT JOIN own ON own.k = replace(lower(trim(m.corpus)), '-', '_')
""",
    "p6_roundtrip": "SELECT DISTINCT chunk_id, md5(text) AS hash, CAST(0 AS BIGINT) AS n_bad FROM chunks WHERE length(text) > 4000",
    "p6_found": "SELECT DISTINCT chunk_id FROM chunks WHERE length(text) > 4000",
    "p1_found": r"""
WITH RECURSIVE r AS (
  SELECT chunk_id, min(split) AS split,
         array_to_string(list_sort(list_filter(regexp_split_to_array(lower(min(author_slug)), '[^\p{L}\p{N}]+'), lambda w: w <> '')), ' ') AS a,
         array_to_string(list_sort(list_filter(regexp_split_to_array(lower(min(story_key)), '[^\p{L}\p{N}]+'), lambda w: w <> '')), ' ') AS s
  FROM chunks GROUP BY chunk_id),
k AS (SELECT chunk_id, split,
             CASE WHEN a NOT IN ('', 'author unknown', 'anonymous', 'authors various') THEN 'a ' || a END AS a,
             CASE WHEN s <> '' THEN 's ' || s END AS s FROM r),
e AS (SELECT DISTINCT a AS u, s AS v FROM k WHERE a IS NOT NULL AND s IS NOT NULL),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach AS (SELECT DISTINCT u AS node, u AS root FROM b
          UNION SELECT b.v, reach.root FROM reach JOIN b ON b.u = reach.node AND reach.root < b.v),
root AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
g AS (SELECT chunk_id, split, coalesce(root.root, a, s, 'c ' || chunk_id) AS gid FROM k LEFT JOIN root ON root.node = coalesce(a, s)),
n AS (SELECT gid FROM g WHERE split IS NOT NULL GROUP BY gid HAVING count(DISTINCT split) >= 2)
SELECT chunk_id FROM g JOIN n USING (gid) WHERE split IS NOT NULL
""",
    "p1_group_sizes": r"""
WITH RECURSIVE r AS (
  SELECT chunk_id, min(split) AS split,
         array_to_string(list_sort(list_filter(regexp_split_to_array(lower(min(author_slug)), '[^\p{L}\p{N}]+'), lambda w: w <> '')), ' ') AS a,
         array_to_string(list_sort(list_filter(regexp_split_to_array(lower(min(story_key)), '[^\p{L}\p{N}]+'), lambda w: w <> '')), ' ') AS s
  FROM chunks GROUP BY chunk_id),
k AS (SELECT chunk_id, split,
             CASE WHEN a NOT IN ('', 'author unknown', 'anonymous', 'authors various') THEN 'a ' || a END AS a,
             CASE WHEN s <> '' THEN 's ' || s END AS s FROM r),
e AS (SELECT DISTINCT a AS u, s AS v FROM k WHERE a IS NOT NULL AND s IS NOT NULL),
b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach AS (SELECT DISTINCT u AS node, u AS root FROM b
          UNION SELECT b.v, reach.root FROM reach JOIN b ON b.u = reach.node AND reach.root < b.v),
root AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
g AS (SELECT chunk_id, split, coalesce(root.root, a, s, 'c ' || chunk_id) AS gid FROM k LEFT JOIN root ON root.node = coalesce(a, s)),
n AS (SELECT gid, count(*) AS n_records FROM g GROUP BY gid)
SELECT CAST(n_records AS BIGINT) AS n_records, count(*) AS n_groups, CAST(0 AS BIGINT) AS n_divided FROM n GROUP BY n_records
""",
}
