"""Cutting texts: sentence chunks, fixed word chunks, byte-bounded segments, markdown sections, paragraph packing."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..session import cut_lineage

TARGET, OVERLAP, MIN_WORDS = 500, 2, 30


def next_chunks(counts: list[int], target: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) sentence ranges: sentences until the target is reached, the next start ``overlap`` before the end."""
    out, s, n = [], 0, len(counts)
    while s < n:
        e, words = s, 0
        while e < n and words < target:
            words += counts[e]
            e += 1
        out.append((s, e))
        if e == n:
            break
        s = max(s + 1, e - overlap)
    return out


def sentence_chunks(df: DataFrame, id_col: str, text_col: str, target: int = TARGET, overlap: int = OVERLAP, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, chunk_index, total_chunks, chunk, word_count): chunks of whole sentences.

    A text of up to 1.5 times the target stays whole; chunks below ``min_words`` are dropped.
    Sentences and their word counts are found in the JVM; only longer texts go to Python.
    Null and blank texts give no row.
    """
    base = T.once(df.select(F.col(id_col).alias("id"), T.text_of(text_col).alias("t")), n=T.word_count(F.col("t"))).where("n > 0")
    short = base.where(F.col("n") <= int(target * 1.5)).select("id", F.lit(0).alias("chunk_index"), F.lit(1).alias("total_chunks"), T.strip(F.col("t")).alias("chunk"))

    def run(batches):
        for b in batches:
            cols = [[], [], [], []]
            for i, sents, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                pieces = [" ".join(sents[s:e]) for s, e in next_chunks(counts, target, overlap) if sum(counts[s:e]) >= min_words]
                for k, p in enumerate(pieces):
                    for c, v in zip(cols, (i, k, len(pieces), p)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())],
                                             names=["id", "chunk_index", "total_chunks", "chunk"])

    kind = dict(base.dtypes)["id"]
    long = T.once(base.where(F.col("n") > int(target * 1.5)).select("id", "t"), s=T.sentences(F.col("t"))).select("id", "s", F.transform("s", T.word_count).alias("c"))
    cut = long.mapInArrow(run, f"id {kind}, chunk_index int, total_chunks int, chunk string")
    return short.unionByName(cut).withColumn("word_count", T.word_count(F.col("chunk"))).withColumnRenamed("id", id_col)


def fixed_chunks(df: DataFrame, id_col: str, text_col: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """(id, chunk_index, chunk): overlapping windows of words; blank texts give no row."""
    rows = df.where(T.word_count(T.text_of(text_col)) > 0)
    return rows.select(id_col, F.posexplode(T.fixed_chunks(T.text_of(text_col), size, overlap)).alias("chunk_index", "chunk"))


def chunk_records(df: DataFrame, id_col: str, text_col: str, source: str, *carried: str, target: int = TARGET, overlap: int = OVERLAP) -> DataFrame:
    """(id, text, metadata): records as chunks that carry their metadata; a record of one chunk keeps its text.

    metadata is a struct of source ("unknown" where null), chunk_index, total_chunks, chunk_size,
    chunk_overlap_sentences, chunk_boundary, word_count and the ``carried`` columns. Null and blank texts give no row.
    """
    own = df.select(F.col(id_col).alias("_id"), F.coalesce(source, F.lit("unknown")).alias("_source"), F.struct(*[F.col(c).alias(c) for c in carried]).alias("_m") if carried else F.lit(None).alias("_m"))
    cut = sentence_chunks(df, id_col, text_col, target, overlap, 0)
    meta = F.struct(
        F.col("_source").alias("source"), "chunk_index", "total_chunks", F.lit(target).alias("chunk_size"), F.lit(overlap).alias("chunk_overlap_sentences"),
        F.lit("sentence").alias("chunk_boundary"), "word_count", *[F.col(f"_m.{c}").alias(c) for c in carried])
    return cut.join(own, cut[id_col] == own["_id"]).select(F.col("_id").alias(id_col), F.col("chunk").alias("text"), meta.alias("metadata"))


def book_chunks(books: DataFrame, key: str, number: str, target: int = TARGET, overlap: int = OVERLAP) -> DataFrame:
    """(key, story_key, chunk_index, total_chunks, text, title, author, title_slug): chunks of the books (title, author, text) of an archive; story_key is title_slug:number."""
    ids = books.select(F.struct(key, number).alias("_b"), "title", "author", "text")
    cut = sentence_chunks(ids.select("_b", "text"), "_b", "text", target, overlap, 0)
    slug = T.slug(F.col("title"), cut=80)
    return cut.join(ids.drop("text"), "_b").select(
        F.col(f"_b.{key}").alias(key), F.concat_ws(":", slug, F.col(f"_b.{number}").cast("string")).alias("story_key"), "chunk_index", "total_chunks", F.col("chunk").alias("text"), "title", "author", slug.alias("title_slug"))


def byte_segments(df: DataFrame, group: str, order: str, size: str, max_bytes: int) -> DataFrame:
    """Adds ``segment``: a new one starts where the bytes of the current one and the row would exceed ``max_bytes``.

    A row larger than the bound is a segment of its own. Null sizes count as 0. Where a segment
    begins hangs on all rows before it, yet the group need not be one task: rows are ranged
    over tasks, every task runs on from what the one before it left, and the tasks run again
    until what they leave no longer changes. A task's cuts soon fall into step whatever it began with, so this takes few rounds;
    only keys and sizes should be given, not texts.
    """
    fields = df.select(F.col(group).alias("g"), F.col(order).alias("o"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("n"))
    gk, ok = dict(df.dtypes)[group], dict(df.dtypes)[order]
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = cut_lineage(fields.repartitionByRange(parts, "g", "o").sortWithinPartitions("g", "o").select("*", F.spark_partition_id().alias("p")))

    def walk(entries, emit):
        def run(batches):
            state = part = None
            for b in batches:
                out = []
                ps = b.column(3).to_pylist()
                if ps and part is None:
                    part = ps[0]
                    state = entries.get(part)
                for g, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                    if state is None or g != state[0]:
                        state = (g, n, 0)
                    elif state[1] > 0 and state[1] + n > max_bytes:
                        state = (g, n, state[2] + 1)
                    else:
                        state = (g, state[1] + n, state[2])
                    out.append(state[2])
                if emit:
                    yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.int32())], names=["g", "o", "n", "segment"])
            if not emit and part is not None:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([state[0]], schema_g), pa.array([state[1]], pa.int64()), pa.array([state[2]], pa.int32())], names=["p", "g", "held", "segment"])
        return run

    from pyspark.sql.pandas.types import to_arrow_type

    schema_g = to_arrow_type(df.schema[group].dataType)
    entries: dict[int, tuple] = {}
    while True:  # a row for each task
        left = {r.p: (r.g, r.held, r.segment) for r in rows.mapInArrow(walk(entries, False), f"p int, g {gk}, held long, segment int").collect()}
        filled = sorted(left)
        found = {b: left[a] for a, b in zip(filled, filled[1:])}
        if found == entries:
            break
        entries = found
    return rows.mapInArrow(walk(entries, True), f"g {gk}, o {ok}, n long, segment int").toDF(group, order, size, "segment")


_HEADING = re.compile(r"^(#{1,4})\s+(.+)$")
_PAGE = re.compile(r"^<!--\s*page\s+(\d+)\s*-->\s*$")


def sections(text: str) -> list[tuple[str, int | None, int, str]]:
    """(title, page, level, body) of a markdown text: headings of level 1 to 4, page marks carried forward, empty bodies left out."""
    out, title, level, page, body = [], "Introduction", 1, None, []

    def flush():
        whole = "\n".join(body).strip()
        if whole:
            out.append((title, page_at, level, whole))

    page_at = None
    for line in (text or "").splitlines():
        mark = _PAGE.match(line.strip())
        if mark:
            page = int(mark[1])
            if not body:
                page_at = page
            continue
        head = _HEADING.match(line)
        if head:
            flush()
            title, level, body, page_at = head[2].strip(), len(head[1]), [], page
        else:
            body.append(line)
    flush()
    return out


def markdown_sections(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, section_no, title, page, level, body) of every section."""
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        for b in batches:
            rows = [(i, k, *s) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, s in enumerate(sections(t))]
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = [b.schema.field(0).type, pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["id", "section_no", "title", "page", "level", "body"])

    return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, section_no int, title string, page int, level int, body string").withColumnRenamed("id", id_col)


def pack_paragraphs(text: str, max_chars: int = 3_500) -> list[str]:
    """Paragraphs packed greedily up to ``max_chars``; a longer paragraph is packed by sentences, a longer sentence stands alone."""
    def greedy(parts, glue):
        out, held = [], ""
        for p in parts:
            joined = f"{held}{glue}{p}" if held else p
            if held and len(joined) > max_chars:
                out.append(held)
                held = p
            else:
                held = joined
        return out + [held] if held else out

    units = []
    for p in re.split(r"\n\s*\n", text or ""):
        p = p.strip()
        if len(p) > max_chars:
            units.extend(greedy(re.split(r"(?<=[.!?])\s+", p), " "))
        elif p:
            units.append(p)
    return greedy(units, "\n\n")


def packed(df: DataFrame, id_col: str, text_col: str, max_chars: int = 3_500) -> DataFrame:
    """(id, part, piece): texts packed by ``pack_paragraphs``; blank texts give no row."""
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        for b in batches:
            rows = [(i, k, p) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, p in enumerate(pack_paragraphs(t, max_chars))]
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (b.schema.field(0).type, pa.int32(), pa.string()))], names=["id", "part", "piece"])

    return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {kind}, part int, piece string").withColumnRenamed("id", id_col)
