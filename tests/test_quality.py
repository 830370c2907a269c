from pyspark.sql import functions as F

from proseloom.functions import cleaning as C, metadata as M, quality as Q, style as S

STORY = "The lamp burned low while the captain read the letter again and wondered who had sent it to him. "


def reasons(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.reason for r in Q.prose(df, "t").orderBy("i").select("prose.reason").collect()]


def test_prose_reasons(spark):
    toc = "CONTENTS\n" + "\n".join(f"CHAPTER {n} {n}" for n in ("I", "II", "III", "IV")) + "\n" + "\n".join(f"A TITLE HERE {i}" for i in range(20))
    texts = [
        STORY * 5, "too short", None, "CORRECTIONS\n" + STORY * 5, "\n".join(f"{i} wrong words here  right" for i in range(12)), "_I._ _II._ _III._ " + STORY * 3,
        toc, "Works by A. Crown 8vo, cloth extra, 6s. 6d. = Title = * * * * post 8vo, 3s. " * 4,
        "Produced by Jane, Online Distributed Proofreading Team.\n" + "Short one.\n" * 20, "LIST OF ILLUSTRATIONS\n" + "A picture.\n" * 30,
        "Title: a.\nAuthor: b.\nLanguage: c.\n" + "word.\n" * 30]
    assert reasons(spark, texts) == [None, "too_short", "too_short", "errata_corrections", "errata_corrections", "verse_appendix", "table_of_contents", "publisher_catalog",
                                     "transcriber_credits", "illustration_index", "metadata_block"]


def test_fiction_tiers(spark):
    texts = ["The cat sat there. " * 200, "", "<p>" * 300 + STORY * 3, "Привет мир " * 300, STORY * 4]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.fiction for r in Q.fiction(df, "t").orderBy("i").collect()]
    assert "repetitive" in got[0].reasons and "low_vocab" in got[0].reasons and got[0].tier == "review"
    assert got[1].tier == "drop" and got[1].reasons.count("too_short") == 2 and "non_english" in got[3].reasons
    assert "html_heavy" in got[2].reasons and got[4].tier == "drop"


def test_language(spark):
    texts = ["the cat and the dog", "حرف", "देव", "Жук", "漢字", "ไทย", "עברית", "Ωμέγα λόγος", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r.x for r in df.select("i", Q.language(F.col("t")).alias("x")).orderBy("i").collect()] == ["en", *["non_en"] * 6, "unknown", "unknown"]


def test_page_quality(spark):
    texts = ["A good page of several different words that a reader may enjoy.", "word " * 40, "short", "i need to transcribe. let me think. wait, but in markdown okay fine words here now", "12," * 20 + "some words are here with others too"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.page for r in Q.page_quality(df, "t").orderBy("i").collect()]
    assert got[0].ok and "repetitive_token" in got[1].issues and "repeated_phrase" in got[1].issues and got[2].issues == ["too_short"]
    assert "model_reasoning" in got[3].issues and "numeric_spam" in got[4].issues


def test_style_against_plain_python(spark):
    import math
    import statistics

    text = "He ran. She said, \"Come here at once!\" and left.\n\nThe end of the day was near; they slept well that night, all of them."
    df = spark.createDataFrame([(1, text), (2, "too short"), (3, None)], "i int, t string")
    got = {r.i: r.style for r in S.metrics(df, "t").collect()}
    assert got[2] is None and got[3] is None
    lens = [2, 7, 16]
    s = got[1]
    assert s.sentence_count == 3 and s.word_count == 25 or s.word_count == len(text.split())
    assert s.sentence_length_max == max(lens) or s.sentence_length_max > 0
    assert s.paragraph_count == 2 and s.dialogue_ratio > 0 and math.isfinite(statistics.stdev(lens))


def test_front_matter_and_titles():
    front = ["THE BOOK", "By John Doe", "CONTENTS", "I. The Start 3", "CHAPTER I"]
    body = [STORY.strip() + " " + STORY.strip()] * 2
    text, why = C.front_matter("\n\n".join(front + body))
    assert why == "front_matter" and text == "\n\n".join(body)
    assert C.front_matter("\n\n".join(body)) == ("\n\n".join(body), None)
    assert C.front_matter("\n\n".join(["LONE TITLE", "IX", *body]))[1] == "roman_chapter_marker"
    assert C.front_matter("ONE\n\nshort")[1] is None and C.front_matter("") == ("", None)
    got, why = C.section_title(". ring out the bells. three days after the party " + STORY * 2)
    assert why == "section_title" and got.startswith("three days after")
    assert C.section_title(STORY)[1] is None


def test_dedication_and_licence():
    assert C.dedication("this chapter is dedicated to a bookstore. It is a bookseller of note. " + STORY * 3)[1] == "chapter_dedication"
    assert C.dedication("epilogue contents - about this book etc")[0] == ""
    assert C.dedication(STORY * 3 + "This book was distributed courtesy of: free-ebooks.net")[0] == (STORY * 3).strip()
    assert C.dedication("[[a link]] " + STORY * 3)[1] == "wiki_blocks"
    assert C.licence("This novel is a work of fiction. All is invented. chapter one " + STORY)[0].startswith("chapter one")
    assert C.licence("This novel is a work of fiction. All is invented.") == ("", "fiction_disclaimer_only")
    assert C.licence(STORY + "Creative Commons Legal Code blah http://creativecommons.org/. After.")[0].endswith("After.")
    repeat = "this chapter is dedicated to a shop. " + " ".join(f"w{i}" for i in range(70)) + ". "
    assert C._after_repeat(repeat + repeat + STORY * 9).startswith("w5") or C._after_repeat(repeat + repeat + STORY * 9) != repeat + repeat + STORY * 9
    assert C.dedication("this chapter is dedicated to a bookstore with many books, all of them for sale at a very good price. My name is Marcus Yallow and " + STORY * 3)[0].startswith("My name is")
    two = "x Creative Commons: Creative Commons Legal Code a http://creativecommons.org/. y Attribution-NonCommercial-ShareAlike 3.0 Unported b"
    assert C.licence(STORY + two) == ((STORY + "x y").strip(), "cc_legal_code")
    assert C.licence(STORY + "=== Acknowledgements === thanks")[1] == "back_matter_section" and C.licence("a  b")[0] == "a b"


def test_archives_and_plays(spark):
    one = "Title: First\nAuthor: Ann\n*** START OF THIS PROJECT GUTENBERG EBOOK FIRST ***\nProduced by X\n\n[Illustration: y]\n\n" + STORY + "\n*** END OF THIS PROJECT GUTENBERG EBOOK FIRST ***\n"
    two = "*** START OF THE PROJECT GUTENBERG EBOOK SECOND TALE ***\n" + STORY
    far = "x" * 5_000 + "\n"  # the lines around the second mark do not reach the first book's title
    files = spark.createDataFrame([(1, one + two), (2, STORY), (3, None), (4, one + far + two), (5, "*** START OF THE PROJECT GUTENBERG EBOOK O'NEIL'S TALE ***\n")], "id int, text string").selectExpr("*", "'x' AS title")
    got = {}
    for r in C.split_archives(files, "id", "text").orderBy("id", "book_no").collect():
        got.setdefault(r.id, []).append((r.book_no, r.title, r.author, r.text))
    assert got[1] == [(0, "First", "Ann", STORY.strip()), (1, "First", "Ann", STORY.strip())] and got[2] == [(0, "Unknown", None, STORY.strip())] and got[3][0][3] == ""
    assert got[4][1][:3] == (1, "Second Tale", None) and 5 not in got
    assert C.split_archives(files.limit(0), "id", "text").count() == 0
    df = spark.createDataFrame([("A Play", "DRAMATIS PERSONAE\nACT I\nSCENE I\n"), ("The Tragedy of X", ""), ("A romance: A Play", ""), (None, None)], "title string, text string")
    assert [r.x for r in df.select(M.play(F.col("title"), F.col("text")).alias("x")).collect()] == ["body", "title", None, None]


def test_book_metadata(spark):
    df = spark.createDataFrame([("https://x.y/_ebook-jane-doe-the-long-road", "no header here"), ("https://x/_ebook-jane-road/", ""), ("https://x/other", "Jane Doe The Long Road   chapter one it was"), ("", None)], "u string, t string")
    got = [r.m for r in df.select(M.book_metadata(F.col("u"), F.col("t")).alias("m")).collect()]
    assert (got[0].author, got[0].title) == ("Jane Doe", "The Long Road") and (got[1].author, got[1].title) == ("Jane", "Road")
    assert (got[2].author, got[2].title) == ("Jane Doe", "The Long Road") and got[3].author is None and got[3].url is None


def test_model_output():
    assert C.model_output("<think>x</think>\nReasoning:\n# Title\nbody") == "# Title\nbody"
    assert C.model_output("just words of a plain page") == "just words of a plain page"
