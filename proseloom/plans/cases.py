"""Queries of further operators: over the tables where SQL can state them, else over small written-out cases."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import cleaning as C, metadata as M, quality as Q, style as S, text as T
from ..operators import chunking, labels, manuscripts, records, retrieval, sampling
from ..session import table
from ..sources import files, readers, sinks
from ..streaming import resume
from . import sql as X
from .registry import D, ORACLE, docs, query

# --- Sources and sinks ---------------------------------------------------------------------


def _written(spark, d):
    """A new folder of the shared folder with the nations in every format that is read, and files that are no data."""
    base = resume._folder(spark)
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("text")).coalesce(1)
    n.write.json(f"{base}/jsonl")
    for name in files.files_below(spark, f"{base}/jsonl"):
        if name.endswith(".json"):
            files.rename(spark, f"{base}/jsonl/{name}", f"{base}/jsonl/{name}l")
    n.write.option("header", "true").csv(f"{base}/csv")
    n.write.option("header", "true").option("sep", "\t").csv(f"{base}/tsv")
    n.write.parquet(f"{base}/parquet")
    n.agg(F.to_json(F.struct(F.collect_list(F.struct("id", "text")).alias("records"))).alias("value")).write.text(f"{base}/json")  # 25 nations
    n.agg(F.concat_ws("\n", F.sort_array(F.collect_list("text"))).alias("value")).write.text(f"{base}/txt")
    for name, text in (("README.md", "no data"), ("jsonl/dataset_infos.json", "{}"), ("kept/a.csv", "id,text\n1,x\n"), ("kept/b.csv", "id,text\n"), ("left/c.csv", "id,text\n"), ("manifests/nations.json", '{"repo_id": "us/nations", "slug": "n-2", "text_field": "text", "unknown": 1}')):
        files.write_text(spark, f"{base}/{name}", text)
    return base


@query("reader_formats", """
SELECT f AS format, CAST(n_nationkey AS VARCHAR) AS id, n_name AS text FROM nation, (SELECT unnest(['csv', 'json', 'jsonl', 'parquet', 'tsv']) AS f)
UNION ALL SELECT 'txt', NULL, string_agg(n_name, chr(10) ORDER BY n_name) FROM nation""")
def reader_formats(spark, d):
    base = _written(spark, d)
    read = {"jsonl": readers.read_jsonl, "json": readers.read_json, "csv": readers.read_csv, "tsv": lambda s, p: readers.read_csv(s, p, "\t"), "parquet": lambda s, p: s.read.parquet(p),
            "txt": lambda s, p: readers.read_text(s, p).withColumn("id", F.lit(None).cast("string"))}
    out = None
    for f, r in read.items():
        part = f"{base}/{f}/part-*"
        df = r(spark, part).select(F.lit(f).alias("format"), "id", "text")
        out = df if out is None else out.unionByName(df)
    return out


@query("discovered_files", "SELECT * FROM (VALUES ('all csv', 'kept/a.csv'), ('all csv', 'kept/b.csv'), ('all csv', 'left/c.csv'), ('kept only', 'kept/a.csv'), ('kept only', 'kept/b.csv'), ('not left', 'kept/a.csv'), ('not left', 'kept/b.csv'), ('manifest', 'us/nations text')) t(rule, file)")
def discovered_files(spark, d):
    base = _written(spark, d)
    for f in ("jsonl", "json", "csv", "tsv", "parquet", "txt"):
        files.delete(spark, f"{base}/{f}")
    found = {"all csv": readers.discover(spark, base, "*.csv"), "kept only": readers.discover(spark, base, include={"kept"}), "not left": readers.discover(spark, base, exclude={"left", "manifests"})}
    m = readers.find_manifest(spark, f"{base}/manifests", "org/n-2")
    rows = [(rule, p[len(base) + 1:]) for rule, ps in found.items() for p in ps] + [("manifest", f"{m.repo_id} {m.text_field}")]
    return spark.createDataFrame(rows, "rule string, file string")


@query("united_formats", "SELECT id, text, count(*) AS n FROM (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS text FROM nation, range(3)) GROUP BY ALL UNION ALL SELECT '1', 'x', 1")
def united_formats(spark, d):
    base = _written(spark, d)
    paths = [p for p in readers.discover(spark, base, exclude={"txt", "json", "tsv", "manifests"}) if not p.endswith(("b.csv", "c.csv"))]
    return readers.read_any(spark, paths).groupBy("id", "text").agg(F.count("*").alias("n"))


@query("nth_record", "SELECT * FROM (VALUES (-5, 0), (3, 3), (99, 24)) t(asked, n_nationkey)")
def nth_record(spark, d):
    n, out = table(spark, d, "nation"), None
    for k in (-5, 3, 99):
        df = readers.nth_record(n, "n_nationkey", k).select(F.lit(k).alias("asked"), F.col("n_nationkey").cast("int").alias("n_nationkey"))
        out = df if out is None else out.unionByName(df)
    return out


@query("malformed_lines", "SELECT * FROM (VALUES ('lenient', 2), ('counted', 3), ('broken', 1)) t(reader, n)")
def malformed_lines(spark, d):
    base = resume._folder(spark)
    files.write_text(spark, f"{base}/x.jsonl", '{"id": 1}\n\n{"id": 2}\n{broken\n')
    schema = StructType([StructField("id", LongType())])
    counted = readers.read_jsonl_counted(spark, f"{base}/x.jsonl", schema).cache()
    rows = [("lenient", readers.read_jsonl(spark, f"{base}/x.jsonl", schema).count()), ("counted", counted.count()), ("broken", counted.where("_corrupt_record is not null").count())]
    counted.unpersist()
    return spark.createDataFrame(rows, "reader string, n int")


@query("author_folders", "SELECT coalesce(nullif(author_slug, ''), 'unknown_author') AS author_slug, count(*) AS n, count(*) AS n_read FROM stories GROUP BY ALL")
def author_folders(spark, d):
    base = resume._folder(spark)
    told = sinks.write_by_author(table(spark, d, "stories").select("story_id", "author_slug", "title"), f"{base}/authors")
    read = spark.read.schema("story_id long, title string, author_slug string").json(f"{base}/authors").groupBy("author_slug").agg(F.count("*").alias("n_read"))
    return told.join(read, "author_slug")


_P = f"WITH src AS (SELECT doc_id, source, text AS raw FROM documents), {X.prose_features('src')}"


@query("kept_and_rejected", f"{_P} SELECT reason IS NULL AS kept, reason, count(*) AS n FROM p GROUP BY ALL")
def kept_and_rejected(spark, d):
    base = resume._folder(spark)
    rows = Q.prose(docs(spark, d).select("doc_id", "text"), "text").select("doc_id", "prose.keep", "prose.reason")
    sinks.write_kept_and_rejected(rows, F.col("keep"), f"{base}/kept", f"{base}/left", F.col("reason"))
    kept = spark.read.schema("doc_id long, reject_reason string").json(f"{base}/kept").withColumn("kept", F.lit(True))
    left = spark.read.schema("doc_id long, reject_reason string").json(f"{base}/left").withColumn("kept", F.lit(False))
    return kept.unionByName(left).groupBy("kept", F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))


@query("replaced_table", "SELECT 'now' AS state, r_name AS name FROM region WHERE r_regionkey > 2 UNION ALL SELECT 'backup', r_name FROM region WHERE r_regionkey = 0")
def replaced_table(spark, d):
    path, r = f"{resume._folder(spark)}/t", table(spark, d, "region").select("r_regionkey", F.col("r_name").alias("name"))
    for condition in ("r_regionkey = 0", "r_regionkey = 1", "r_regionkey > 2"):
        sinks.replace_with_backup(r.where(condition), path)
    read = lambda p, s: spark.read.schema("name string").json(p).select(F.lit(s).alias("state"), "name")
    return read(path, "now").unionByName(read(f"{path}.bak", "backup"))


@query("index_file", """SELECT * FROM (VALUES ('missing', 'false'), ('merged', '{"a": 1, "n": {"x": 1, "y": 2}, "z": 3}')) t(step, result)""")
def index_file(spark, d):
    path = f"{resume._folder(spark)}/index.json"
    missing = sinks.update_index(spark, path, z=3)
    files.write_text(spark, path, '{"a": 1, "n": {"x": 1}}')
    sinks.update_index(spark, path, n={"y": 2}, z=3)
    flat = " ".join(files.read_text(spark, path).split()).replace("{ ", "{").replace(" }", "}")
    return spark.createDataFrame([("missing", str(missing).lower()), ("merged", flat)], "step string, result string")


@query("segment_files", ORACLE["byte_segments"].replace("SELECT source, doc_id, bytes, segment FROM r", "SELECT source, segment, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM r WHERE source IS NOT NULL GROUP BY ALL"))
def segment_files(spark, d):
    path = f"{resume._folder(spark)}/segments"
    rows = docs(spark, d).where("source is not null").select("source", "doc_id", (F.octet_length(T.text_of("text")) + 1).alias("bytes"))
    sinks.write_segments(chunking.byte_segments(rows, "source", "doc_id", "bytes", 50_000), path, "source")
    read = spark.read.schema("doc_id long, bytes long, source string, segment int").json(path)
    return read.groupBy("source", "segment").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


# --- Records -------------------------------------------------------------------------------
@query("picked_fields", f"SELECT DISTINCT chunk_id, CASE WHEN {X.strip('text')} <> '' THEN md5(text) END AS hash, title AS name, coalesce(nullif({X.strip('author')}, ''), nullif({X.strip('title')}, '')) AS first_set FROM chunks")
def picked_fields(spark, d):
    c = table(spark, d, "chunks").select("chunk_id", "text", "title", "author")
    c = records.map_fields(c, {"name": "title", "absent": "no_such_column"}).withColumn("_t", records.pick_text(c.select("text", "title")))
    return c.select("chunk_id", F.md5(F.col("_t").cast("binary")).alias("hash"), "name", T.first_text(F.col("author"), F.col("title")).alias("first_set")).distinct()


@query("tag_lists", "SELECT DISTINCT story_id, list_sort(list_distinct(list_filter(genres, lambda g: g IS NOT NULL))) AS tags FROM stories WHERE genres IS NOT NULL")
def tag_lists(spark, d):
    s = table(spark, d, "stories").where("genres is not null").select("story_id", F.array_distinct(F.array_compact("genres")).alias("g"))
    m = s.select("story_id", F.map_from_arrays("g", F.transform("g", lambda x: F.lit(True))).alias("m"))
    return m.select("story_id", F.sort_array(T.genres_of_flags(F.col("m"))).alias("tags")).distinct()


@query("gap_filled", "SELECT doc_id, subject FROM subject_labels WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, subject FROM subject_labels WHERE doc_id NOT IN (SELECT doc_id FROM subject_labels WHERE doc_id % 2 = 0)")
def gap_filled(spark, d):
    seed = table(spark, d, "subject_labels").select("doc_id", "subject")
    return records.with_gaps_filled(seed.where("doc_id % 2 = 0"), seed, "doc_id")


@query("longest_definition", "SELECT source, min(doc_id) AS doc_id, max(length(coalesce(text, ''))) AS n FROM (SELECT *, max(length(coalesce(text, ''))) OVER (PARTITION BY source) AS m FROM documents) WHERE length(coalesce(text, '')) = m GROUP BY source")
def longest_definition(spark, d):
    return records.longest_by(docs(spark, d).select("source", "doc_id", "text"), "source", "text", "doc_id").select("source", "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"))


_AUTHOR = "CASE WHEN contains(coalesce(author, ''), ',') THEN concat_ws(' ', trim(regexp_extract(author, '^[^,]*,(.*)$', 1)), trim(regexp_extract(author, '^([^,]*),', 1))) ELSE coalesce(author, '') END"


@query("projected_books", f"""
WITH c AS (SELECT DISTINCT chunk_id, text, title, author, {X.wc("coalesce(text, '')")} AS n FROM chunks),
s AS (SELECT *, regexp_replace(regexp_replace(lower({_AUTHOR}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS a,
  regexp_replace(substring(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80), '_+$', '', 'g') AS t FROM c WHERE n >= 100)
SELECT chunk_id AS story_id, coalesce(nullif(a, ''), 'unknown_author') || ':' || chunk_id AS story_key, title, author, coalesce(nullif(a, ''), 'unknown_author') AS author_slug, coalesce(nullif(t, ''), 'untitled') AS title_slug, n AS word_count, md5(text) AS hash FROM s""")
def projected_books(spark, d):
    c = table(spark, d, "chunks").select("chunk_id", "text", "title", "author").distinct()
    b = records.project_books(c, "text", "title", "author", "chunk_id")
    return b.withColumn("hash", F.md5(F.col("text").cast("binary"))).drop("text")


@query("resume_incomplete", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM subject_labels WHERE subject IS NOT NULL)")
def resume_incomplete(spark, d):
    return records.pending(docs(spark, d).select("doc_id"), table(spark, d, "subject_labels"), ["doc_id"], F.col("subject").isNotNull())


@query("resumed_records", "SELECT n_nationkey, n_name, count(*) AS n FROM nation GROUP BY ALL")
def resumed_records(spark, d):
    path, n = f"{resume._folder(spark)}/log", table(spark, d, "nation").select("n_nationkey", "n_name")
    for rows in (n.where("n_nationkey < 9"), n.where("n_nationkey < 20"), n):
        resume.append_new(rows, path, ["n_nationkey"])
    return spark.read.schema(n.schema).json(path).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n"))


@query("complete_profiles", "SELECT DISTINCT chunk_id, author IS NOT NULL AND title IS NOT NULL AS complete FROM chunks")
def complete_profiles(spark, d):
    profile = F.create_map(F.lit("author"), F.col("author"), F.lit("title"), F.col("title"))
    return table(spark, d, "chunks").select("chunk_id", records.complete(profile, ["author", "title"]).alias("complete")).distinct()


@query("profile_passes", """SELECT * FROM (VALUES ('full', 'no scorer', 'n=1 pov=b tone=c'), ('full', 'scorer', 'n=1 pov=d tone=e'), ('deep', 'scorer', 'n=1 pov=b tone=e'), ('both', 'scorer', 'n=9 pov=b tone=e')) t(mode, labels, profile)""")
def profile_passes(spark, d):
    one = spark.range(1).select(*[F.from_json(F.lit(j), "map<string,string>").alias(n) for n, j in (("c", '{"n": "1", "pov": "a"}'), ("p", '{"pov": "b", "tone": "c", "n": "9"}'), ("f", '{"pov": "d", "tone": "e"}'))])
    out = None
    for mode, fresh in (("full", False), ("full", True), ("deep", True), ("both", True)):
        m = records.pass_profile(F.col("c"), F.col("p"), F.col("f") if fresh else None, mode, ("pov",))
        text = F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")
        df = one.select(F.lit(mode).alias("mode"), F.lit("scorer" if fresh else "no scorer").alias("labels"), text.alias("profile"))
        out = df if out is None else out.unionByName(df)
    return out


@query("file_rules", """SELECT * FROM (VALUES ('a_styled.jsonl', true, 4, 1, 1, 1), ('a_clean_styled.jsonl', false, 1, 0, 1, 0), ('b_deep_seg_002.jsonl', true, 1, 0, 0, 0)) t(file, allowed, n_rows, n_invalid, n_without_profile, n_incomplete)""")
def file_rules(spark, d):
    ok = '{"metadata": {"style_profile": {"pov": "x"}}}'
    rows = [("a_styled.jsonl", x) for x in (ok, '{"metadata": {"style_profile": {"tone": "x"}}}', '{"text": "y"}', "{broken", " ", None)] + [("a_clean_styled.jsonl", "{}"), ("b_deep_seg_002.jsonl", ok)]
    return records.validated(spark.createDataFrame(rows, "file string, line string"), "file", "line", ["pov"])


@query("english_books", f"WITH d AS ({D}), l AS (SELECT doc_id, {X.language('t')} AS language, {X.wc('t')} AS word_count FROM d) SELECT doc_id, language, word_count, language = 'en' AS kept, CASE language WHEN 'non_en' THEN 'non_english' WHEN 'unknown' THEN 'unknown_language' END AS reason FROM l")
def english_books(spark, d):
    return Q.english_only(docs(spark, d), "text", "doc_id")


@query("label_lookup", "SELECT DISTINCT chunk_id, CASE split WHEN 'train' THEN 'for training' WHEN 'test' THEN 'held out' ELSE 'other' END AS say FROM chunks")
def label_lookup(spark, d):
    say = records.lookup(F.col("split"), {"train": "for training", "test": "held out"}, "other")
    return table(spark, d, "chunks").select("chunk_id", say.alias("say")).distinct()


@query("naming_telemetry", "SELECT count(*) AS n_runs, avg(total_chunks) AS mean_attempts, max(total_chunks) AS most_attempts, avg(total_chunks / nullif(len(genres), 0)) AS mean_per_character FROM (SELECT DISTINCT story_id, total_chunks, genres FROM stories)")
def naming_telemetry(spark, d):
    s = table(spark, d, "stories").select("story_id", "total_chunks", "genres").distinct()
    return labels.naming_summary(s.withColumn("k", F.when(F.col("genres").isNotNull(), F.size("genres"))), "total_chunks", "k")


# --- Choices -------------------------------------------------------------------------------
_U = "CAST('0x' || substring(md5('7|' || story_id), 1, 8) AS BIGINT) / 4294967296.0"


@query("weighted_letters", f"WITH s AS (SELECT DISTINCT story_id FROM stories), u AS (SELECT story_id, {_U} * 10 AS u FROM s) SELECT story_id, CASE WHEN u >= 9 THEN 'C' WHEN u >= 6 THEN 'B' ELSE 'A' END AS letter FROM u")
def weighted_letters(spark, d):
    return table(spark, d, "stories").select("story_id").distinct().withColumn("letter", sampling.choose_weighted(7, {"A": 6.0, "B": 3.0, "X": 0.0, "C": 1.0}, F.col("story_id")))


@query("rate_sample", "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents) SELECT doc_id FROM r WHERE k <= floor(n * 0.05)")
def rate_sample(spark, d):
    return sampling.sample_by_rate(docs(spark, d).select("doc_id"), "doc_id", 0.05)


@query("first_documents", "SELECT doc_id FROM documents ORDER BY added_at NULLS FIRST, doc_id LIMIT 25")
def first_documents(spark, d):
    return sampling.first_rows(docs(spark, d).select("doc_id", "added_at"), ["added_at", "doc_id"], 25).select("doc_id")


# --- Retrieval and knowledge -----------------------------------------------------------------
@query("style_sections", f"SELECT item_id, length(regexp_extract(lower(concat_ws(' ', prompt, substring(item_text, 1, 300))), '{'|'.join(retrieval.STYLE_WORDS)}')) > 0 AS relevant FROM eval_items")
def style_sections(spark, d):
    return table(spark, d, "eval_items").select("item_id", retrieval.style_relevant(F.col("prompt"), F.col("item_text")).alias("relevant"))


@query("knowledge_categories", f"WITH k AS ({ORACLE['kb_categories']}) SELECT unnest(categories) AS category, count(*) AS n FROM k JOIN eval_items USING (item_id) WHERE length(item_text) >= 120 GROUP BY 1")
def knowledge_categories(spark, d):
    k = retrieval.knowledge_records(table(spark, d, "eval_items"), "item_id", "prompt", "item_text")
    return retrieval.category_counts(k, "categories")


_KB = ORACLE["kb_categories"]


@query("kb_top_k_categories", f"""
WITH q AS (SELECT DISTINCT story_id, title FROM stories WHERE title IS NOT NULL), kc AS ({_KB}),
qt AS (SELECT story_id, title, list_distinct(regexp_extract_all(lower(title), '[a-z]{{3,}}')) AS tok,
  list_filter([{', '.join(f"CASE WHEN {' OR '.join(f'contains(lower(title), {chr(39)}{k}{chr(39)})' for k in ks)} THEN '{n}' END" for n, ks in retrieval.CATEGORIES.items())}], lambda x: x IS NOT NULL) AS cat FROM q),
k AS (SELECT item_id, list_distinct(regexp_extract_all(lower(concat_ws(' ', prompt, item_text)), '[a-z]{{3,}}')) AS tok, list_filter(categories, lambda c: c <> 'general') AS cat FROM eval_items JOIN kc USING (item_id)),
s AS (SELECT story_id, title, item_id, len(list_intersect(qt.tok, k.tok)) + CASE WHEN len(list_intersect(qt.cat, k.cat)) > 0 THEN 5 ELSE 0 END AS score FROM qt, k),
r AS (SELECT *, row_number() OVER (PARTITION BY story_id, title ORDER BY score DESC, item_id) AS rank FROM s)
SELECT story_id, title, item_id, score, rank FROM r WHERE rank <= 3 AND score > 0""")
def kb_top_k_categories(spark, d):
    q = table(spark, d, "stories").where("title is not null").select(F.struct("story_id", "title").alias("q"), "title").distinct()
    k = retrieval.top_k(q, "q", "title", table(spark, d, "eval_items"), "item_id", "prompt", "item_text")
    return k.select("q.story_id", "q.title", "item_id", "score", "rank")


@query("context_blocks", """
WITH s AS (SELECT suite, item_id, item_text AS b, row_number() OVER (PARTITION BY suite ORDER BY item_id) AS k FROM eval_items), p AS (SELECT * FROM s WHERE k <= 3),
a AS (SELECT suite, max(CASE WHEN k = 1 THEN b END) AS x, max(CASE WHEN k = 2 THEN b END) AS y, max(CASE WHEN k = 3 THEN b END) AS z FROM p GROUP BY suite),
c1 AS (SELECT *, CASE WHEN length(x) <= 1500 THEN x ELSE substring(x, 1, 1500) END AS c FROM a),
c2 AS (SELECT *, CASE WHEN y IS NULL THEN c WHEN length(y) <= 1500 - length(c) THEN c || chr(10) || chr(10) || y WHEN 1500 - length(c) > 200 THEN c || chr(10) || chr(10) || substring(y, 1, 1500 - length(c)) ELSE c END AS d FROM c1),
c3 AS (SELECT *, CASE WHEN z IS NULL THEN d WHEN length(z) <= 1500 - length(d) THEN d || chr(10) || chr(10) || z WHEN 1500 - length(d) > 200 THEN d || chr(10) || chr(10) || substring(z, 1, 1500 - length(d)) ELSE d END AS e FROM c2)
SELECT suite, md5(e) AS hash FROM c3""")
def context_blocks(spark, d):
    e = table(spark, d, "eval_items").withColumn("k", F.row_number().over(W.partitionBy("suite").orderBy("item_id"))).where("k <= 3")
    return retrieval.context(e, "suite", "item_text", "k", 1_500).select("suite", F.md5(F.col("context").cast("binary")).alias("hash"))


# --- Chunks of records and books -------------------------------------------------------------
@query("record_chunks", ORACLE["sentence_chunks"].replace(">= 30 UNION", ">= 0 UNION").replace("md5(chunk) AS hash,", "md5(chunk) AS hash, 500 AS chunk_size,"))
def record_chunks(spark, d):
    c = chunking.chunk_records(docs(spark, d), "doc_id", "text", "source", "title")
    return c.select("doc_id", "metadata.chunk_index", "metadata.total_chunks", F.md5(F.col("text").cast("binary")).alias("hash"), "metadata.chunk_size", "metadata.word_count")


_ARCHIVE = (
    "Title: The First\nAuthor: Ann Lee\n*** START OF THIS PROJECT GUTENBERG EBOOK THE FIRST ***\nProduced by Some One\n\nIt was late. The old man went home.\n"
    "*** END OF THIS PROJECT GUTENBERG EBOOK THE FIRST ***\n" + "-" * 4_100 + "\n*** START OF THE PROJECT GUTENBERG EBOOK A SECOND TALE ***\n[Illustration: a boat]\n\nThe boat left the harbour. Nobody saw it go.\n")


@query("archive_cases", """SELECT * FROM (VALUES (1, 0, 'The First', 'Ann Lee', 'the_first:0', 'It was late. The old man went home.'), (1, 1, 'A Second Tale', NULL, 'a_second_tale:1', 'The boat left the harbour. Nobody saw it go.'),
(2, 0, 'Unknown', NULL, 'unknown:0', 'No marks in this file.')) t(file, book_no, title, author, story_key, text)""")
def archive_cases(spark, d):
    f = spark.createDataFrame([(1, _ARCHIVE), (2, "No marks in this file."), (3, "*** START OF THE PROJECT GUTENBERG EBOOK EMPTY ***\n")], "file int, text string")
    b = C.split_archives(f, "file", "text")
    keys = chunking.book_chunks(b, "file", "book_no").select("file", "story_key", F.split("story_key", ":").getItem(1).cast("int").alias("book_no"))
    return b.join(keys, ["file", "book_no"]).select("file", "book_no", "title", "author", "story_key", "text")


_BODY = "Plain words of the body that go on for a while. " * 5


@query("manuscript_cases", f"""SELECT * FROM (VALUES (0, 'Part One', 2, 'ONE', NULL, NULL, '{_BODY.strip()}', ['general'], false), (1, 'Chapter 2', 3, 'ONE', 2, NULL, '{_BODY.strip()}', ['general'], false), (2, '3.1 A checklist of things', 4, 'ONE', 2, '3.1',
'A: Lexical' || chr(10) || '5 NOUN PHRASES. Are they simple or complex?' || chr(10) || '{_BODY.strip()}', ['lexical'], true)) t(section_no, title, page, part, chapter, section_id, body, categories, is_checklist)""")
def manuscript_cases(spark, d):
    text = f"Title\n<PAGE>\nHeader\nPART ONE\n{_BODY}\n12\n<PAGE>\nHeader\nCHAPTER 2\n{_BODY}\n<PAGE>\nHeader\n3.1 A checklist of things\nA: Lexical\n5 NOUN PHRASES. Are they simple or complex?\n{_BODY}"
    return manuscripts.manuscript_sections(spark.createDataFrame([(1, text)], "i int, t string"), "i", "t").drop("i")


@query("checklist_cases", """SELECT * FROM (VALUES ('a', NULL, 'Noun phrases', 5, 'Are they simple or complex in this text?'), ('b', 'Cohesion', NULL, NULL, 'Does the text hold together by links?')) t(g, grp, subgroup, item, prompt)""".replace("('a', NULL, 'Noun phrases'", "('a', 'a', 'Noun phrases'").replace("('b', 'Cohesion', NULL", "('b', 'b', 'Cohesion'"))
def checklist_cases(spark, d):
    body = "A: Lexical\n5 NOUN PHRASES. Are they simple or\n[see p. 3]\ncomplex in this text?\nB: Cohesion\nDoes the text hold together by links?\n7 SHORT. no"
    items = manuscripts.checklist_items(spark.createDataFrame([(1, body)], "i int, t string"), "i", "t")
    return items.select(F.substring("id", 1, 1).alias("g"), F.col("group").alias("grp"), "subgroup", "item", "prompt")


@query("markdown_cases", """SELECT * FROM (VALUES (0, 'One', 1, 'text of one'), (1, 'Two', 2, 'text of two')) t(section_no, title, level, body)""")
def markdown_cases(spark, d):
    text = "# One\ntext of one\n<!-- page 2 -->\n## Two\ntext of two\n"
    return chunking.markdown_sections(spark.createDataFrame([(1, text)], "i int, t string"), "i", "t").select("section_no", "title", "level", "body")


# --- Cleaning --------------------------------------------------------------------------------
_TALE = "It was a cold evening in the village and the old man walked home along the river while nobody looked at him and the lamps were lit one by one in the windows. "
_NORMAL = [
    ("plain", _TALE.strip(), _TALE.strip(), ""),
    ("front", f"THE BOOK\n\nBy John Doe\n\nCONTENTS\n\nI. The Start 3\n\nCHAPTER I\n\n{_TALE * 2}", (_TALE * 2).strip(), "front_matter"),
    ("roman", f"LONE TITLE\n\nIX\n\n{_TALE * 2}", (_TALE * 2).strip(), "roman_chapter_marker"),
    ("wiki", f"[[a link]] {_TALE * 2}", (_TALE * 2).strip(), "wiki_blocks"),
    ("disclaimer", "This novel is a work of fiction. All is invented.", "", "fiction_disclaimer_only"),
    ("notes", f"{_TALE * 2}=== Acknowledgements === thanks to all", (_TALE * 2).strip(), "back_matter_section"),
    ("trailer", f"{_TALE * 2}Publication date: May 2011 http://www.bookrix.com/x ISBN: 978-3-16", (_TALE * 2).strip(), "bookrix_publication_trailer"),
    ("wrapped", "The old man went ho-\nme along the\nriver.", "The old man went home along the river.", ""),
    ("null", None, "", ""),
]


@query("normalize_cases", "SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{t}', '{r}')" for n, _, t, r in _NORMAL) + ") t(name, text, reasons)")
def normalize_cases(spark, d):
    df = spark.createDataFrame([(n, t) for n, t, _, _ in _NORMAL], "name string, raw string")
    rows = records.normalized(df, "raw", "text")
    why = T.once(df.withColumn("_r", T.reflow(T.normalize_whitespace(T.text_of("raw")))), c=C.clean(F.col("_r"))).select("name", F.array_join("c.reasons", ",").alias("reasons"))
    return rows.select("name", "text").join(why, "name")


@query("unified_cases", f"SELECT * FROM (VALUES ('plain', 's', {len(_TALE.split())}, NULL), ('front', 's', {2 * len(_TALE.split())}, 'T'), ('roman', 's', {2 * len(_TALE.split())}, 'T'), ('wiki', 's', {2 * len(_TALE.split())}, 'T'), ('notes', 's', {2 * len(_TALE.split())}, 'T'), ('trailer', 's', {2 * len(_TALE.split())}, 'T')) t(name, source, word_count, title)")
def unified_cases(spark, d):
    df = spark.createDataFrame([(n, t, "s", "" if n == "plain" else "T") for n, t, _, _ in _NORMAL], "name string, text string, src string, title string")
    u = records.unified(df, "text", "src", "src", title="title", name="name")
    return u.select("metadata.name", "metadata.source", "metadata.word_count", "metadata.title")


@query("enriched_cases", f"SELECT * FROM (VALUES ('plain', {len(_TALE.split())}, 'low'), ('wiki', {2 * len(_TALE.split())}, 'low'), ('wrapped', NULL, NULL), ('null', NULL, NULL)) t(name, word_count, pov)")
def enriched_cases(spark, d):
    df = spark.createDataFrame([(n, t) for n, t, _, _ in _NORMAL if n in ("plain", "wiki", "wrapped", "null")], "name string, text string")
    e = records.enriched(df, "text", F.create_map(F.lit("pov"), F.lit("low")))
    return e.select("name", "word_count", F.try_element_at("style_profile", F.lit("pov")).alias("pov"))


@query("style_bands", f"WITH m AS ({ORACLE['style_metrics']}) SELECT doc_id, CASE WHEN sentence_length_mean < 12 THEN 'low' WHEN sentence_length_mean > 28 THEN 'high' ELSE 'mid' END AS band FROM m")
def style_bands(spark, d):
    m = S.metrics(docs(spark, d).select("doc_id", "text"), "text").where("style is not null")
    v = F.col("style.sentence_length_mean")
    return m.select("doc_id", F.when(v < 12, "low").when(v > 28, "high").otherwise("mid").alias("band"))


@query("model_output_cases", """SELECT * FROM (VALUES (1, '# Title' || chr(10) || 'body'), (2, 'just words of a plain page')) t(i, text)""")
def model_output_cases(spark, d):
    rows = spark.createDataFrame([(1, "<think>x</think>\nReasoning:\n# Title\nbody"), (2, "just words of a plain page")], "i int, t string")
    return rows.select("i", C.cleaned_output(F.col("t")).alias("text"))


@query("book_metadata_cases", "SELECT * FROM (VALUES (1, 'Jane Doe', 'The Long Road'), (2, 'Jane', 'Road'), (3, 'Jane Doe', 'The Long Road'), (4, NULL, NULL)) t(i, author, title)")
def book_metadata_cases(spark, d):
    rows = [(1, "https://x.y/_ebook-jane-doe-the-long-road", "no header here"), (2, "https://x/_ebook-jane-road/", ""), (3, "https://x/other", "Jane Doe The Long Road   chapter one it was"), (4, "", None)]
    return spark.createDataFrame(rows, "i int, u string, t string").select("i", M.book_metadata(F.col("u"), F.col("t")).alias("m")).select("i", "m.author", "m.title")
