import random
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from proseloom.functions import text as T
from proseloom.operators import chunking


def column(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", expr(F.col("t")).alias("x")).orderBy("i").collect()]


SAMPLES = ["", " ", "one", "a b\tc\nd e　f", "It was. \"Yes!\" she said. no Cap. End?", "x\r\n\r\n\r\ny  \nz\rw", "He said “hi” and ‘no’ «x»", "<b>a</b>&nbsp;b <i>c</i>", "I\n\nt was cold\nand wet sum-\nmer", "The\n\nend of it", "Ab\nnext line\n\nC\nd e"]


def test_words_sentences_whitespace(spark):
    assert column(spark, SAMPLES, T.word_count) == [len(s.split()) for s in SAMPLES]
    want = []
    for s in SAMPLES:
        parts = [p.strip() for p in re.split(r"(?<=[.!?])\s+(?=[A-Z\"'])", s.strip()) if p.strip()]
        want.append(parts)
    assert column(spark, SAMPLES, T.sentences) == want
    ws = [re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", re.sub(r"\r\n?", "\n", s))).strip() for s in SAMPLES]
    assert column(spark, SAMPLES, T.normalize_whitespace) == ws


def test_quotes_html_slugs_genres(spark):
    q = column(spark, SAMPLES, T.normalize_quotes)
    assert q[6] == "He said \"hi\" and 'no' \"x\"" and column(spark, q, T.normalize_quotes) == q
    assert column(spark, SAMPLES, T.strip_html)[7] == "a b c"
    ratio = column(spark, SAMPLES, T.html_ratio)
    assert ratio[0] == 0.0 and abs(ratio[7] - 20 / 24) < 1e-9
    assert column(spark, ["Hello, World!", None, "--", "Doe, Jane"], T.slug) == ["hello_world", "untitled", "untitled", "doe_jane"]
    assert column(spark, ["Doe, Jane", None, "Al B."], T.author_slug) == ["jane_doe", "unknown_author", "al_b"]
    assert column(spark, ["Sci Fi; Horror/gothic|x", None, " , "], T.genres) == [["sci_fi", "horror", "gothic", "x"], [], []]
    df = spark.createDataFrame([({"Dark-Romance": "1", "no": "0", "Two Words": "True"},)], "m map<string,string>")
    assert sorted(df.select(T.genres_of_flags(F.col("m")).alias("x")).first().x) == ["dark_romance", "two_words"]


def plain_reflow(text):
    """Statement of the rule in plain Python."""
    letter, word = re.compile(r"[A-Z]\Z"), re.compile(r"[A-Z][a-z']{1,11}\Z")
    text = re.sub(r"\r\n?", "\n", text)
    ps = [p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()]
    out, skip = [], False
    for i, p in enumerate(ps):
        if skip:
            skip = False
            continue
        nxt = ps[i + 1] if i + 1 < len(ps) else ""
        if (letter.match(p) or word.match(p)) and nxt[:1].islower():
            p, skip = p + ("" if letter.match(p) else " ") + nxt, True
        out.append(p)
    done = []
    for p in out:
        ls = [x.strip() for x in p.split("\n") if x.strip()]
        if len(ls) > 1 and (letter.match(ls[0]) or word.match(ls[0])) and ls[1][0].islower():
            ls[:2] = [ls[0] + ("" if letter.match(ls[0]) else " ") + ls[1]]
        s = ls[0]
        for x in ls[1:]:
            s = s[:-1] + x if s.endswith("-") else f"{s} {x}"
        done.append(s)
    return "\n\n".join(done)


def test_reflow_against_plain_statement(spark):
    rng = random.Random(1)
    bits = ["I", "The", "t was", "word", "sum-", "mer", "\n", "\n", "\n\n", " ", "A long line.", "b"]
    texts = SAMPLES + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    assert column(spark, texts, T.reflow) == [plain_reflow(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40), st.integers(10, 80), st.integers(0, 3))
def test_sentence_ranges_cover_everything(counts, target, overlap):
    got = chunking.next_chunks(counts, target, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(counts)
    for (s, e), (s2, e2) in zip(got, got[1:]):
        assert s < s2 <= e and e2 > e - overlap and sum(counts[s:e]) >= target


def test_chunkers(spark):
    long = " ".join(f"Sentence number {i} has exactly some eight words." for i in range(200))
    df = spark.createDataFrame([(1, long), (2, "Short one."), (3, ""), (4, None)], "id long, text string")
    got = chunking.sentence_chunks(df, "id", "text").orderBy("id", "chunk_index").collect()
    assert [r.id for r in got if r.id != 1] == [2] and got[0].total_chunks == sum(r.id == 1 for r in got)
    fixed = chunking.fixed_chunks(df, "id", "text", 100, 10).where("id = 1").collect()
    assert all(len(r.chunk.split()) <= 100 for r in fixed) and fixed[0].chunk.split()[-10:] == fixed[1].chunk.split()[:10]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=30))
def test_packing_bounds(sizes):
    text = "\n\n".join("x" * n for n in sizes)
    parts = chunking.pack_paragraphs(text, 45)
    assert "\n\n".join(parts) == text and all(len(p) <= 45 for p in parts)


def test_byte_segments(spark):
    rng = random.Random(3)
    rows = [("a" if i % 3 else "b", i, rng.choice([5, 30, 70, 200])) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, n long")
    got = {(r.g, r.o): r.segment for r in chunking.byte_segments(df, "g", "o", "n", 100).collect()}
    for g in "ab":
        seg, held = 0, 0
        for _, o, n in sorted(r for r in rows if r[0] == g):
            if held and held + n > 100:
                seg, held = seg + 1, 0
            held += n
            assert got[g, o] == seg


def test_markdown_sections():
    got = chunking.sections("intro\n<!-- page 3 -->\n# One\n<!-- page 4 -->\nbody\n\n## Two\n\n### Three\nmore")
    assert [(t, p, lv, b) for t, p, lv, b in got] == [("Introduction", None, 1, "intro"), ("One", 4, 1, "body"), ("Three", 4, 3, "more")]
