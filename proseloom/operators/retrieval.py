"""Retrieval of reference passages by scored token overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Keywords of the knowledge categories.
CATEGORIES = {
    "lexical": ("lexic", "vocabulary", "register", "diction", "word choice", "collocation"),
    "grammatical": ("grammar", "syntax", "sentence", "clause", "passive", "subordination", "coordination"),
    "figurative": ("figur", "metaphor", "simile", "irony", "trope", "scheme", "rhetoric"),
    "cohesion": ("cohes", "reference", "anaphora", "connect", "linking", "discourse"),
    "context": ("context", "setting", "time", "place", "tone", "atmosphere"),
    "viewpoint": ("viewpoint", "point of view", "narrator", "perspective", "voice", "fid", "mind style"),
    "textual": ("segmentation", "salience", "end-focus", "end focus", "climax", "linearity", "graphic unit", "rhythm of prose", "rhetoric of text"),
}


def tokens(c: Column) -> Column:
    """Different runs of three or more small letters."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0)))


def categories(title: Column, body: Column, chars: int = 800) -> Column:
    """Categories of which a keyword stands in the title or the first characters of the body; general if none."""
    both = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.substring(F.coalesce(body, F.lit("")), 1, chars)))
    hits = F.array_compact(F.array(*[F.when(F.exists(F.array(*map(F.lit, kws)), lambda k: F.contains(both, k)), name) for name, kws in CATEGORIES.items()]))
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit("general")))


CATEGORY_BONUS = 5
# Words of which one marks a section as dealing with style.
STYLE_WORDS = ("style", "lexic", "gramm", "syntax", "rhetoric", "figur", "narrat", "viewpoint", "voice", "register", "cohes", "diction", "sentence", "prose", "metaphor", "irony", "point of view")


def style_relevant(title: Column, content: Column) -> Column:
    """Whether a style word stands in a section's title or the first 300 characters of its content."""
    both = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.substring(F.coalesce(content, F.lit("")), 1, 300)))
    return F.exists(F.array(*map(F.lit, STYLE_WORDS)), lambda w: F.contains(both, w))


def category_counts(df: DataFrame, categories_col: str) -> DataFrame:
    """(category, n) over rows with lists of categories."""
    return df.select(F.explode(categories_col).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


def knowledge_records(sections: DataFrame, key: str, title: str, body: str, least: int = 120) -> DataFrame:
    """(key, title, body, categories, n_diagrams): sections of at least ``least`` characters as knowledge; diagrams are mermaid blocks."""
    rows = sections.where(F.length(F.coalesce(body, F.lit(""))) >= least)
    return rows.select(key, title, body, categories(F.col(title), F.col(body)).alias("categories"), F.regexp_count(body, F.lit("```mermaid")).alias("n_diagrams"))


def distilled(sections: DataFrame, items: DataFrame, title: str, body: str) -> DataFrame:
    """One row of counts of a distilled manuscript: sections, those about style, knowledge records, checklist items and their groups."""
    s = sections.agg(F.count("*").alias("n_sections"), F.count_if(style_relevant(F.col(title), F.col(body))).alias("n_style"), F.count_if(F.length(body) >= 120).alias("n_knowledge"))
    i = items.agg(F.count("*").alias("n_items"), F.count_distinct("group").alias("n_groups"))
    return s.crossJoin(i)  # one row each


def top_k(queries: DataFrame, query_id: str, query: str, knowledge: DataFrame, item_id: str, title: str, text: str, k: int = 3, use_categories: bool = True) -> DataFrame:
    """(query_id, item_id, score, rank): the k best items of every query, ties by item id; items without a score are none.

    Queries and items meet on their tokens, an equi-join that needs no copy of the knowledge; an
    item scores one for every shared token and CATEGORY_BONUS for a shared category. Scores are summed before
    they are ranked, and the ranking's limit is applied before its shuffle. Null query ids stay apart.
    """
    q = queries.select(F.col(query_id).alias("q"), tokens(F.col(query)).alias("tok"), categories(F.lit(""), F.col(query)).alias("cat"))
    i = knowledge.select(F.col(item_id).alias("i"), tokens(F.concat_ws(" ", title, text)).alias("tok"), categories(F.col(title), F.col(text)).alias("cat"))
    met = q.select("q", F.explode("tok").alias("t")).join(i.select("i", F.explode("tok").alias("t")), "t").select("q", "i", F.lit(1).alias("s"))
    if use_categories:
        of = lambda df, name: df.select(name, F.explode(F.array_remove("cat", "general")).alias("t"))
        met = met.unionByName(of(q, "q").join(of(i, "i"), "t").select("q", "i").distinct().withColumn("s", F.lit(CATEGORY_BONUS)))
    scored = met.groupBy("q", "i").agg(F.sum("s").cast("int").alias("score"))
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "i"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("q").alias(query_id), F.col("i").alias(item_id), "score", "rank")


def context(ranked: DataFrame, query_id: str, body: str, rank: str, max_chars: int = 4_000, least: int = 200) -> DataFrame:
    """(query_id, context): bodies in rank order up to ``max_chars``; the last is cut if more than ``least`` characters are left, else dropped.

    Groups hold the k rows of one query.
    """
    rows = F.transform(F.sort_array(F.collect_list(F.struct(rank, body))), lambda r: r[body])

    def step(acc, b):
        left = F.lit(max_chars) - F.length(acc)
        piece = F.when(F.length(b) <= left, b).when(left > least, F.substring(b, F.lit(1), left)).otherwise("")
        return F.when(piece == "", acc).otherwise(F.concat(acc, F.when(acc == "", "").otherwise("\n\n"), piece))

    return ranked.groupBy(query_id).agg(F.aggregate(rows, F.lit(""), step).alias("context"))
