"""Records by key: last one wins, duplicate counts, resume, reconciliation, nested record schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import cleaning as C, text as T


def record_key(source: Column, index: Column, text: Column) -> Column:
    """source|index|first 60 characters; a missing index counts as 0."""
    return F.concat_ws("|", F.coalesce(source, F.lit("")), F.coalesce(index.cast("string"), F.lit("0")), F.substring(F.coalesce(text, F.lit("")), 1, 60))


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last by ``order``; adds ``first_seen``, the first order value, to restore the first-seen order.

    An aggregation with max_by over a struct instead of a window: rows are reduced before
    the shuffle, so a key that holds a third of all rows makes no hot task. Ties in
    ``order`` are broken by the row's other columns, so the result does not depend on the
    order of arrival.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    one = df.groupBy(*keys).agg(F.max(row).alias("_r"), F.min(F.col(order[0])).alias("first_seen"))
    return one.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in order + rest], "first_seen")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def pending(df: DataFrame, done: DataFrame, keys: list[str], finished: Column | None = None) -> DataFrame:
    """Rows whose key is not among the done ones, of which only the ``finished`` ones count where that is given (null keys are pending)."""
    done = done if finished is None else done.where(finished)
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def project_books(df: DataFrame, text: str, title: str, author: str, story_id: str, min_words: int = 100) -> DataFrame:
    """(story_id, story_key, title, author, author_slug, title_slug, word_count, text) of rows of at least ``min_words``; story_key is author_slug:story_id."""
    rows = T.once(df, _n=T.word_count(T.text_of(text))).where(F.col("_n") >= min_words)
    slug = T.author_slug(F.col(author))
    return rows.select(
        F.col(story_id).alias("story_id"), F.concat_ws(":", slug, F.col(story_id).cast("string")).alias("story_key"), F.col(title).alias("title"), F.col(author).alias("author"),
        slug.alias("author_slug"), T.slug(F.col(title), cut=80).alias("title_slug"), F.col("_n").alias("word_count"), F.col(text).alias("text"))


def complete(profile: Column, fields: list[str]) -> Column:
    """Whether all required fields of a map are set."""
    return F.forall(F.array(*map(F.lit, fields)), lambda k: F.try_element_at(profile, k).isNotNull())


def merge_profiles(computed: Column, prior: Column, fresh: Column) -> Column:
    """One map: computed values, then prior labels, then fresh ones; later ones win."""
    empty = F.create_map().cast("map<string,string>")
    parts = [F.coalesce(m, empty) for m in (computed, prior, fresh)]
    merged = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    def over(old: Column, new: Column) -> Column:
        return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)

    for m in parts:
        merged = over(merged, m)
    return merged


def normalized(df: DataFrame, text: str, out: str, reflow: bool = True) -> DataFrame:
    """Adds ``out``: whitespace, reflow, front matter, section titles, dedications, licences and quotes of a text, in that order."""
    t = T.normalize_whitespace(T.text_of(text))
    rows = df.withColumn("_raw", T.reflow(t) if reflow else t)
    return T.once(rows, _clean=C.clean(F.col("_raw"))).withColumn(out, T.normalize_quotes(F.col("_clean.text"))).drop("_raw", "_clean")


def enriched(df: DataFrame, text: str, profile: Column, min_words: int = 30) -> DataFrame:
    """Sets the normalised text and adds word_count and style_profile (a map); below ``min_words``, or where the profile is null, a row stays as it is, with nulls."""
    rows = normalized(df, text, "_t").withColumn("_n", T.word_count(F.col("_t"))).withColumn("_p", profile)
    fits = (F.col("_n") >= min_words) & F.col("_p").isNotNull()
    return rows.withColumns({text: F.when(fits, F.col("_t")).otherwise(F.col(text)), "word_count": F.when(fits, F.col("_n")), "style_profile": F.when(fits, F.col("_p"))}).drop("_t", "_n", "_p")


def pass_profile(computed: Column, prior: Column, fresh: Column | None = None, mode: str = "full", fast: tuple[str, ...] = ()) -> Column:
    """The profile map of a labelling pass from computed metrics, an earlier profile and fresh labels (null: no scorer).

    Without fresh labels the earlier profile fills what is missing and settles the ``fast`` labels.
    With them: full and fast let fresh labels win; deep keeps earlier values that were not
    computed, and its ``fast`` labels; both lets all earlier values pass, labels what is missing, and keeps the earlier ``fast`` labels.
    """
    empty = F.create_map().cast("map<string,string>")
    base, old, new = (F.coalesce(m, empty) for m in (computed, prior, empty if fresh is None else fresh))
    over = lambda a, b: F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)
    held = F.map_filter(old, lambda k, v: k.isin(*fast)) if fast else empty
    if fresh is None:
        return over(over(old, base), held)
    if mode == "both":
        return over(over(over(base, F.map_filter(old, lambda k, v: v.isNotNull())), new), F.map_filter(held, lambda k, v: v.isNotNull()))
    return over(over(over(old, base), new), held) if mode == "deep" else over(base, new)


def lookup(key: Column, table: dict[str, str], default: str | None = None) -> Column:
    """A small fixed table's value of ``key``, as a literal map; the default where it is missing."""
    if not table:
        return F.lit(default).cast("string")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key), F.lit(default).cast("string"))


# Names of styled corpus files, and parts that no such name holds.
STYLED_FILES = (r"(?i)^[a-z0-9_]+_styled(?:_seg_\d{3})?\.jsonl$", r"(?i)^[a-z0-9_]+_deep_seg_\d{3}\.jsonl$")
FORBIDDEN_PARTS = ("pipeline_chunks", "temp", "combined", "deduped", "reflowed", "clean", "flagged")


def file_allowed(name: Column) -> Column:
    """Whether a file may stand in a styled corpus, by its name."""
    bad = F.exists(F.array(*map(F.lit, FORBIDDEN_PARTS)), lambda x: F.contains(name, x))
    return F.coalesce(name.endswith(".jsonl") & ~bad & (name.rlike(STYLED_FILES[0]) | name.rlike(STYLED_FILES[1])), F.lit(False))


def validated(lines: DataFrame, file: str, line: str, required: list[str]) -> DataFrame:
    """(file, allowed, n_rows, n_invalid, n_without_profile, n_incomplete) of JSON lines; blank lines do not count."""
    rows = lines.where(F.trim(F.coalesce(line, F.lit(""))) != "")
    broken = F.try_parse_json(F.col(line)).isNull()
    profile = F.from_json(F.get_json_object(line, "$.metadata.style_profile"), "map<string,string>")
    some = F.coalesce(F.size(profile), F.lit(0)) > 0
    return rows.groupBy(F.col(file).alias("file")).agg(
        F.count("*").alias("n_rows"), F.count_if(broken).alias("n_invalid"), F.count_if(~broken & ~some).alias("n_without_profile"),
        F.count_if(~broken & some & ~complete(profile, required)).alias("n_incomplete")).select("file", file_allowed(F.col("file")).alias("allowed"), "n_rows", "n_invalid", "n_without_profile", "n_incomplete")


def unified(df: DataFrame, text: str, source: str, dataset: str, min_words: int = 30, **fields: str) -> DataFrame:
    """(text, metadata): text through the whole normalising chain with a nested metadata struct; rows below ``min_words`` are left out.

    Optional fields are null where missing and so left out when written as JSON.
    """
    base = normalized(df, text, "_t").withColumn("_n", T.word_count(F.col("_t"))).where(F.col("_n") >= min_words)
    extra = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(k) if dict(df.dtypes)[c] == "string" else F.col(c).alias(k) for k, c in fields.items()]
    return base.select(F.col("_t").alias("text"), F.struct(F.col(source).alias("source"), F.col(dataset).alias("source_dataset"), F.col("_n").alias("word_count"), *extra).alias("metadata"))


def pick_text(df: DataFrame, preferred: str | None = None) -> Column:
    """The text of a row: the preferred column, else the first candidate that is not blank, else the first text of 20 words."""
    # Names that may hold the text, in order.
    names = ("text", "content", "passage", "body", "story", "chapter", "paragraph", "document", "description", "blurb", "prompt", "completion")
    strings = [c for c, t in df.dtypes if t == "string"]
    if preferred in strings:
        return F.col(preferred)
    first = [F.when(T.strip(F.col(c)) != "", F.col(c)) for c in names if c in strings]
    long = [F.when(T.word_count(T.text_of(c)) >= 20, F.col(c)) for c in strings]
    return F.coalesce(*first, *long, F.lit(None).cast("string"))


def with_gaps_filled(df: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` and those of ``seed`` whose key is absent."""
    return df.unionByName(seed.join(df.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def first_line_repeats(df: DataFrame, group: str, text: str, least: int = 3) -> DataFrame:
    """(group, line, n): first content lines that open ``least`` or more rows of a group, as running headers do."""
    line = F.try_element_at(T.lines(T.text_of(text)), F.lit(1))
    return df.select(group, line.alias("line")).where("line is not null").groupBy(group, "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def longest_by(df: DataFrame, key: str, text: str, order: str) -> DataFrame:
    """Per key the row with the longest text, the first by ``order`` among equals."""
    best = F.max_by(F.struct(*df.columns), F.struct(F.length(F.coalesce(text, F.lit(""))), -F.col(order)))
    return df.groupBy(key).agg(best.alias("_b")).select("_b.*")


def row_number_by(df: DataFrame, group: str, order: str) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(W.partitionBy(group).orderBy(order)))


def map_fields(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Target columns from source columns that exist; the sources stay."""
    return df.withColumns({target: F.col(source) for target, source in mapping.items() if source in df.columns})


def metadata_blob(df: DataFrame, preferred: str | None = None, text_names: tuple[str, ...] = ("text",)) -> Column:
    """The record's metadata: the preferred nested column, else the first of the usual names, else all columns but the texts."""
    nested = [c for c, t in df.dtypes if t.startswith(("struct", "map"))]
    for name in (preferred, "metadata", "meta", "info", "attrs", "attributes"):
        if name in nested:
            return F.col(name)
    return F.struct(*[F.col(c) for c in df.columns if c not in text_names])


def annotated(df: DataFrame, struct: str, name: str, value: Column) -> DataFrame:
    """``df`` with a field set inside a nested column."""
    return df.withColumn(struct, F.col(struct).withField(name, value))


def record_label(*parts: Column) -> Column:
    """Parts that are set, joined by a bar."""
    return F.concat_ws(" | ", *[F.nullif(p.cast("string"), F.lit("")) for p in parts])


def profile_parts(profile: Column, computable: list[str], labels: list[str]) -> Column:
    """struct(computable, labels, extra): a profile's map by kind of key."""
    among = lambda names: F.map_filter(profile, lambda k, v: k.isin(names))
    rest = F.map_filter(profile, lambda k, v: ~k.isin(computable + labels))
    return F.struct(among(computable).alias("computable"), among(labels).alias("labels"), rest.alias("extra"))
