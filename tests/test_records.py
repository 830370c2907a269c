import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from proseloom.operators import pairs, records as R, retrieval, runs, sampling, segments
from proseloom.sources import readers, sinks
from proseloom.streaming import resume


def test_last_wins_and_duplicates(spark):
    rows = [("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), (None, 4, "n"), ("a", 3, "z")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = {r.k: (r.v, r.first_seen) for r in R.last_wins(df, ["k"], ["o"]).collect()}
    assert got == {"a": ("z", 1), "b": ("y", 2), None: ("n", 4)}
    again = R.last_wins(R.last_wins(df, ["k"], ["o"]).drop("first_seen"), ["k"], ["o"]).drop("first_seen")
    assert sorted(map(str, again.collect())) == sorted(map(str, R.last_wins(df, ["k"], ["o"]).drop("first_seen").collect()))
    assert [(r.k, r.n) for r in R.duplicate_keys(df, ["k"]).collect()] == [("a", 3)]
    assert {r.k for r in R.pending(df, df.where("k = 'a'"), ["k"]).collect()} == {"b", None}
    assert R.last_wins(df.limit(0), ["k"], ["o"]).count() == 0


def test_profiles_and_fields(spark):
    df = spark.createDataFrame([({"a": "1", "b": None}, {"b": "2"}, {"a": "9"})], "c map<string,string>, p map<string,string>, f map<string,string>")
    assert df.select(R.merge_profiles(F.col("c"), F.col("p"), F.col("f")).alias("m")).first().m == {"b": "2", "a": "9"}
    assert df.select(R.complete(F.col("c"), ["a"]).alias("x"), R.complete(F.col("c"), ["a", "b"]).alias("y")).first() == (True, False)
    d2 = spark.createDataFrame([("", "word " * 25), ("body text", "x")], "content string, other string")
    assert [r.t.strip()[:4] for r in d2.select(R.pick_text(d2).alias("t")).collect()] == ["word", "body"]
    best = R.longest_by(spark.createDataFrame([("i", "aa", 1), ("i", "bb", 0), ("i", "c", 2)], "k string, t string, o int"), "k", "t", "o").first()
    assert best.t == "bb"


def test_split_sizes_and_samples(spark):
    df = spark.range(997).withColumnRenamed("id", "k")
    got = sampling.split_by_fraction(df, "k", 0.1)
    assert got.where("part = 'validation'").count() == 99 and got.count() == 997
    one, two = (sorted(r.k for r in sampling.sample(df, "k", 20).collect()) for _ in range(2))
    assert one == two and len(one) == 20
    assert sampling.split_by_fraction(df.limit(0), "k", 0.1).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12))
def test_budget_prefix_is_the_greedy_loop(spark, sizes):
    df = spark.createDataFrame([("c", i, n) for i, n in enumerate(sizes)], "corpus string, i int, bytes long")
    got = sorted(r.i for r in segments.budget_prefix(df, "corpus", "i", "bytes", 100).collect())
    want, held = [], 0
    for i, n in enumerate(sizes):
        if want and held + n > 100:
            break
        held += n
        want.append(i)
        if held > 100:
            break
    assert got == want


def test_runs(spark):
    df = spark.createDataFrame([(1, {"a": "x", "b": "y", "c": None}, {"a": "x", "c": "z"})], "i int, t map<string,string>, v map<string,string>")
    d = df.select(runs.delta(F.col("t"), F.col("v"), ["a", "b", "c"]).alias("d")).first().d
    assert (d.compared, d.matched, d.score, d.matches) == (2, 1, 0.5, {"a": True, "b": False})
    base = spark.createDataFrame([("p", 0.5), ("q", 0.2)], "k string, s double")
    cand = spark.createDataFrame([("p", 0.25), ("r", 1.0)], "k string, s double")
    assert [(r.k, r.delta, r.direction) for r in runs.compare(base, cand, ["k"], "s").collect()] == [("p", -0.25, "regressed")]


def test_retrieval_context_and_pairs(spark):
    kb = spark.createDataFrame([(1, "Metaphor", "a metaphor and simile here"), (2, "Other", "nothing shared")], "id long, title string, text string")
    q = spark.createDataFrame([(7, "the metaphor and the simile"), (8, "zzz"), (9, None)], "q long, text string")
    got = retrieval.top_k(q, "q", "text", kb, "id", "title", "text").collect()
    assert [(r.q, r.id, r.rank) for r in got] == [(7, 1, 1)] and got[0].score == 3 + 5
    r = spark.createDataFrame([(1, 1, "a" * 30), (1, 2, "b" * 30), (2, 1, "c" * 90)], "q long, rank int, body string")
    c = {x.q: x.context for x in retrieval.context(r, "q", "body", "rank", 50, 10).collect()}
    assert c[1] == "a" * 30 + "\n\n" + "b" * 20 and c[2] == "c" * 50
    from proseloom.functions import style

    t = spark.createDataFrame([(1, "It was a long and quiet day in the village and nobody spoke to him about the letter that came at noon today."), (2, None)], "k long, text string")
    p = pairs.instruction_pairs(style.metrics(t, "text"), "k", "text", "style").collect()
    assert sorted(x.task_type for x in p) == ["classification"] + ["judgment"] * 3 and len({x.dimension for x in p}) == 4


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.jsonl").write_text('{"text": "x", "n": 1}\n\n{bad\n{"text": "y"}\n')
    (tmp_path / "d/b.json").write_text('{"meta": 1, "data": [{"text": "p"}, {"text": "q"}]}')
    (tmp_path / "d/c.csv").write_text("text,n\nhello,1\n")
    (tmp_path / "d/e.tsv").write_text("text\tn\nworld\t2\n")
    (tmp_path / "d/f.txt").write_text("  a whole\nfile ")
    (tmp_path / "d/README.md").write_text("no")
    files = readers.discover(spark, str(tmp_path / "d"))
    assert len(files) == 5 and readers.discover(spark, str(tmp_path / "d"), "*.csv") == [str(tmp_path / "d/c.csv")]
    assert sorted(r.text for r in readers.read_jsonl(spark, files[0]).collect()) == ["x", "y"]
    assert sorted(r.text for r in readers.read_json(spark, files[1]).collect()) == ["p", "q"]
    assert [tuple(r) for r in readers.read_csv(spark, files[3], "\t").collect()] == [("world", "2")]
    assert readers.read_text(spark, files[4]).first().source_file == "f.txt"
    df = spark.createDataFrame([("a", "x_y", 1), ("b", None, 2), ("c", "x_y", 3)], "text string, author_slug string, n int")
    counts = {r.author_slug: r.n for r in sinks.write_by_author(df, str(tmp_path / "by")).collect()}
    assert counts == {"x_y": 2, "unknown_author": 1} and (tmp_path / "by/author_slug=x_y").exists()
    sinks.write_kept_and_rejected(df, F.col("n") > 1, str(tmp_path / "k"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "k")).count() == 2 and spark.read.json(str(tmp_path / "r")).count() == 1
    sinks.replace_with_backup(df, str(tmp_path / "k"))
    assert spark.read.json(str(tmp_path / "k")).count() == 3 and (tmp_path / "k.bak").exists()
    assert not sinks.update_index(spark, str(tmp_path / "no.json"), n=1)
    (tmp_path / "i.json").write_text(json.dumps({"a": 1}))
    assert sinks.update_index(spark, str(tmp_path / "i.json"), n=2) and json.loads((tmp_path / "i.json").read_text()) == {"a": 1, "n": 2}


def test_stream_resumes_and_compacts(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int").coalesce(1).write.parquet(src)
    step = lambda df: df.withColumn("w", F.col("v") * 10)
    resume.process_available(spark, src, step, out, ck)
    spark.createDataFrame([("a", 2)], "k string, v int").coalesce(1).write.mode("append").parquet(src)
    resume.process_available(spark, src, step, out, ck)
    assert spark.read.parquet(out).count() == 3
    assert {r.k: r.w for r in resume.last_wins(spark.read.parquet(out), "k", "v").collect()} == {"a": 20, "b": 10}


def test_names_labels_and_manuscripts(spark):
    from proseloom.operators import labels as L, manuscripts as P

    rows = [(1, "g", "Captain  Ann Lee"), (2, "g", "ann lee"), (3, "g", "Ann Bo of Kent"), (4, "g", None), (5, "h", "Dr. Mary Sue"), (6, "g", "Captain ann Lee")]
    df = spark.createDataFrame(rows, "i int, g string, n string")
    got = {r.i: r.code for r in L.name_gate(df, "n", "g", "i", ["mary"], ["zed"]).collect()}
    assert got == {1: "ok", 2: "duplicate_first", 3: "duplicate_first", 4: "empty", 5: "overused_first", 6: "duplicate"}
    assert [r.x for r in df.orderBy("i").select(L.last_name(F.col("n")).alias("x")).collect()][2] == "bo"
    score = L.default_scorer([{"id": "tone", "metric_type": "ordinal"}, {"id": "pov", "values": ["a", "b", "c"]}])
    out = L.annotate(df, "i", "n", score, {"tone": "x", "pov": "y", "other": "z"}).where("i = 1").first().labels
    assert out == {"tone": "moderate", "pov": "b", "other": "z"}

    def broken(texts):
        raise RuntimeError

    one = L.annotate(df, "i", "n", broken, {"tone": "x"}).where("i = 1").first()
    assert one.labels == {"tone": "x"} and one.error.startswith("RuntimeError")

    def picky(texts):
        if any("Sue" in t for t in texts):
            raise ValueError("no")
        return [{"tone": "y"} for _ in texts]

    assert {r.i: (r.labels["tone"], r.error) for r in L.annotate(df, "i", "n", picky, {"tone": "x"}).collect()} == {1: ("y", None), 2: ("y", None), 3: ("y", None), 5: ("x", "ValueError: no"), 6: ("y", None)}
    assert [r.x for r in spark.createDataFrame([("Warden Jane Poe",), ("the Vizier Abu",)], "n string").select(L.first_name(F.col("n")).alias("x")).collect()] == ["jane", "the"]
    body = "Plain words of the body that go on for a while. " * 6
    text = "Title\n<PAGE>\nHeader\nPART ONE\n" + body + "\n12\n<PAGE>\nHeader\nCHAPTER 2\n" + body + "\n<PAGE>\nHeader\n3.1 A checklist of things\nA: Lexical\n5 NOUN PHRASES. Are they simple or complex in this text?\n[see pp. 3]\nWhat do the adjectives do in the passage?\n" + body
    books = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, body)], "i int, t string").selectExpr("*", "1 AS page", "'x' AS line")
    got = P.manuscript_sections(books, "i", "t").orderBy("i", "section_no").collect()
    assert [s.is_checklist for s in got] == [False, False, True] and got[2].categories == ["lexical"]
    assert [(s.i, s.section_no, s.title, s.page, s.part, s.chapter, s.section_id) for s in got] == [
        (1, 0, "Part One", 2, "ONE", None, None), (1, 1, "Chapter 2", 3, "ONE", 2, None), (1, 2, "3.1 A checklist of things", 4, "ONE", 2, "3.1")]
    assert "Header" not in got[1].body and "12" not in got[0].body and got[0].body == body.strip()
    lists = P.manuscript_sections(books, "i", "t").where("section_id = '3.1'")
    items = P.checklist_items(lists, "i", "body").orderBy("item").collect()
    assert (items[-1].group, items[-1].subgroup, items[-1].item) == ("a", "Noun phrases", 5) and items[-1].prompt.startswith("Are they") and "see pp" not in items[-1].prompt
    assert items[-1].id == "a_noun_phrases_are_they_simple_or_complex_in_this_text"[:80] and P.manuscript_sections(books.limit(0), "i", "t").count() == 0


def test_record_helpers(spark):
    df = spark.createDataFrame([("t", "A", {"a": "1", "b": "2", "c": "3"})], "text string, by string, m map<string,string>")
    assert R.map_fields(df, {"author": "by", "x": "none"}).columns == ["text", "by", "m", "author"]
    assert df.select(R.metadata_blob(df.drop("m")).alias("b")).first().b.asDict() == {"by": "A"}
    nested = df.select("text", F.struct("by").alias("meta"))
    assert nested.select(R.metadata_blob(nested).alias("b")).first().b.by == "A"
    assert R.annotated(nested, "meta", "n", F.lit(1)).first().meta.n == 1
    assert df.select(R.record_label(F.col("by"), F.lit(None), F.lit(""), F.lit(3)).alias("l")).first().l == "A | 3"
    p = df.select(R.profile_parts(F.col("m"), ["a"], ["b"]).alias("p")).first().p
    assert (p.computable, p.labels, p.extra) == ({"a": "1"}, {"b": "2"}, {"c": "3"})


def test_profiles_files_and_choices(spark):
    from proseloom.operators import chunking as K, labels as L, records as R, retrieval as V, sampling as S

    df = spark.createDataFrame([({"n": "1", "pov": "a"}, {"pov": "b", "tone": "c", "n": "9"}, {"pov": "d", "tone": "e"})], "c map<string,string>, p map<string,string>, f map<string,string>")
    got = lambda fresh, mode: df.select(R.pass_profile(F.col("c"), F.col("p"), F.col("f") if fresh else None, mode, ("pov",)).alias("x")).first().x
    assert got(False, "full") == {"n": "1", "pov": "b", "tone": "c"} and got(True, "full") == {"n": "1", "pov": "d", "tone": "e"}
    assert got(True, "deep") == {"n": "1", "pov": "b", "tone": "e"} and got(True, "both") == {"n": "9", "pov": "b", "tone": "e"}
    names = ["a_styled.jsonl", "a_styled_seg_001.jsonl", "b_deep_seg_002.jsonl", "a_clean_styled.jsonl", "a_styled.json", "a.jsonl", None]
    assert [r.x for r in spark.createDataFrame([(n,) for n in names], "n string").select(R.file_allowed(F.col("n")).alias("x")).collect()] == [True, True, True, False, False, False, False]
    lines = spark.createDataFrame([("a_styled.jsonl", x) for x in ('{"metadata": {"style_profile": {"pov": "x"}}}', '{"metadata": {"style_profile": {"tone": "x"}}}', '{"text": "y"}', "{broken", " ", None)], "f string, l string")
    assert tuple(R.validated(lines, "f", "l", ["pov"]).first()) == ("a_styled.jsonl", True, 4, 1, 1, 1)
    picks = spark.range(4000).select(S.choose_weighted(1, {"a": 3, "b": 1, "c": 0}, F.col("id")).alias("x")).groupBy("x").count().collect()
    share = {r.x: r["count"] / 4000 for r in picks}
    assert set(share) == {"a", "b"} and abs(share["a"] - 0.75) < 0.03 and sum(L.FIRST_LETTERS.values()) > 100
    assert S.sample_by_rate(spark.range(1001), "id", 0.1).count() == 100 and S.sample_by_rate(spark.range(0), "id", 0.1).count() == 0
    assert [r.id for r in S.first_rows(spark.range(50), ["id"], 3).collect()] == [0, 1, 2]
    assert [r.x for r in spark.createDataFrame([("On Metaphor", ""), ("x", "y" * 310 + "style"), (None, None)], "t string, c string").select(V.style_relevant(F.col("t"), F.col("c")).alias("x")).collect()] == [True, False, False]
    assert [r.x for r in spark.createDataFrame([("low",), ("zzz",), (None,)], "k string").select(R.lookup(F.col("k"), {"low": "plain"}, "none").alias("x")).collect()] == ["plain", "none", "none"]
    q = spark.createDataFrame([(1, "metaphor of the river"), (2, "nothing shared here"), (3, None)], "q int, t string").selectExpr("*", "1 AS i", "2 AS s")
    kb = spark.createDataFrame([(10, "figure", "the river"), (11, "irony", "a tale"), (12, "the", "the")], "k int, title string, body string").selectExpr("*", "1 AS q")
    assert {tuple(r) for r in V.top_k(q, "q", "t", kb, "k", "title", "body", 2).collect()} == {(1, 10, 7, 1), (1, 11, 5, 2)}
    sec = spark.createDataFrame([(1, "On style", "x" * 130), (2, "y", "z" * 10)], "k int, title string, body string")
    assert V.knowledge_records(sec, "k", "title", "body").count() == 1
    long = " ".join(f"This is sentence number {i} of the record." for i in range(200))
    rec = spark.createDataFrame([(1, long, "s", "A"), (2, "Short text.", None, "B"), (3, None, "s", "C")], "i int, t string, src string, title string").selectExpr("*", "9 AS chunk", "8 AS word_count")
    got = {}
    for r in K.chunk_records(rec, "i", "t", "src", "title").collect():
        got.setdefault(r.i, []).append(r)
    assert set(got) == {1, 2} and got[2][0].text == "Short text." and got[2][0].metadata.source == "unknown" and got[2][0].metadata.total_chunks == 1
    assert len(got[1]) > 2 and all(r.metadata.title == "A" and r.metadata.total_chunks == len(got[1]) and r.metadata.chunk_size == 500 for r in got[1])
    books = spark.createDataFrame([(5, 0, "The Title", "Ann", long), (5, 1, None, None, "Second book text here.")], "f int, n int, title string, author string, text string")
    assert {r.story_key for r in K.book_chunks(books, "f", "n").collect()} == {"the_title:0", "untitled:1"}


def test_byte_segments_over_many_tasks(spark):
    import random

    from proseloom.operators.chunking import byte_segments

    rng = random.Random(3)
    rows = [(None if g == 2 else f"g{g}", i, None if rng.random() < 0.02 else rng.choice((1, 40, 90, 300))) for g in range(3) for i in range((900, 7, 40)[g])]
    want, state = {}, {}
    for g, i, n in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        held, seg = state.get(g, (0, 0))
        n = n or 0
        held, seg = (n, seg + 1) if held > 0 and held + n > 200 else (held + n, seg)
        state[g] = (held, seg)
        want[g, i] = seg
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o int, n int")
    assert {(r.g, r.o): r.segment for r in byte_segments(df, "g", "o", "n", 200).collect()} == want
    assert byte_segments(df.limit(0), "g", "o", "n", 200).count() == 0


def test_english_only(spark):
    from proseloom.functions import quality as Q

    df = spark.createDataFrame([(1, "the old man and the sea " * 5, None), (2, "Кот и пёс", None), (3, "zzz qqq " * 9, None), (4, "the cat and the dog", "fr"), (5, "zzz", "en"), (6, None, None)], "i int, t string, d string")
    got = {r.i: (r.language, r.kept, r.reason) for r in Q.english_only(df, "t", "i", detected=F.col("d")).collect()}
    assert got == {1: ("en", True, None), 2: ("non_en", False, "non_english"), 3: ("unknown", False, "unknown_language"), 4: ("fr", False, "non_english"), 5: ("en", True, None), 6: ("unknown", False, "unknown_language")}
