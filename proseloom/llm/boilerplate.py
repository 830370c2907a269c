"""Problem 4: lines repeated across one source's texts.

Lines are nodes and consecutive lines are edges of a weighted graph per source. Nodes and
edges with high support stay, connected nodes form a boilerplate block (a node without a
supported edge is a block of one line), and every occurrence of a block's lines is deleted.
So every supported line is in exactly one block; operators that only need to know which
lines are boilerplate take the supported lines themselves, which spares them the edges.

Two lines are the same when their letters are the same after lower-casing; spaces,
punctuation and digits do not count. A line has support when it stands in at least
``min_share`` and at least ``min_chunks`` of the chunks of its source_dataset. A null source
has no boilerplate, a null text counts as a chunk without lines, redelivered rows of a
chunk_id count once, an empty table gives an empty result, and extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage

MIN_SHARE, MIN_CHUNKS, MIN_WORDS = 0.03, 5, 3
#: Nodes of one source are at most (mean lines per chunk / MIN_SHARE); the table of all sources is broadcast up to this many,
#: beyond it the join on the source is salted, so that a source with most of the texts is SALT tasks.
BROADCAST_NODES = 200_000
SALT = 64
BUCKETS = 64       # of the nodes of a source, by hash; a line is looked up in one of them
EDGE_SHARE = 0.5   # part of the occurrences of the rarer line after or before which the other one stands


def line_hash(line):
    return F.xxhash64(F.regexp_replace(F.lower(line), r"[^\p{L}]+", ""))


def _lines(text):
    return F.split(text, "\n")


def _is_long(line):
    return F.size(F.filter(F.split(line, r"\s+"), lambda w: w.rlike(r"\p{L}"))) >= MIN_WORDS


def nodes(chunks: DataFrame, min_share: float = MIN_SHARE, min_chunks: int = MIN_CHUNKS) -> DataFrame:
    """One row per (source_dataset, hash) of a supported line, with its support.

    Counting shuffles three longs per distinct line of a chunk; the chunk id is part of the
    first grouping key, so a line that stands everywhere does not make a hot group.
    """
    known = chunks.where(F.col("source_dataset").isNotNull())
    totals = known.groupBy("source_dataset").agg(F.count_distinct("chunk_id").alias("n_chunks"))
    empty = F.xxhash64(F.lit(""))
    pairs = known.where(F.col("text").isNotNull()).select(
        F.xxhash64("source_dataset").alias("src"), "chunk_id",
        F.explode(F.array_distinct(F.transform(_lines(F.col("text")), line_hash))).alias("h"),
    ).where(F.col("h") != empty)
    support = (
        pairs.groupBy("src", "h", "chunk_id").agg(F.lit(1).alias("one"))
        .groupBy("src", "h").agg(F.count("one").alias("support")).where(F.col("support") >= min_chunks)
    )
    totals = totals.withColumn("src", F.xxhash64("source_dataset"))
    return support.join(totals, "src").where(
        F.col("support") >= F.col("n_chunks") * min_share
    ).select("source_dataset", "h", "support", "n_chunks")


def node_arrays(found: DataFrame, most: int = BROADCAST_NODES) -> DataFrame:
    """source_dataset -> its node hashes in BUCKETS arrays, to be broadcast up to ``most`` nodes, else with a salt."""
    kept = cut_lineage(found.select("source_dataset", "h"))
    size = kept.count()
    parts = kept.groupBy("source_dataset", F.pmod("h", F.lit(BUCKETS)).cast("int").alias("b")).agg(F.collect_set("h").alias("hs"))
    by = parts.groupBy("source_dataset").agg(F.map_from_entries(F.collect_list(F.struct("b", "hs"))).alias("m"))
    empty = F.array().cast("array<long>")
    arrays = by.select("source_dataset", F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.coalesce(F.try_element_at("m", i), empty)).alias("bp"))
    return F.broadcast(arrays) if size <= most else arrays.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def _attach(chunks: DataFrame, arrays: DataFrame, how: str) -> DataFrame:
    """``chunks`` with the node arrays of their sources as ``bp``."""
    if "salt" not in arrays.columns:
        return chunks.join(arrays, "source_dataset", how)
    salted = chunks.withColumn("salt", F.pmod(F.xxhash64("chunk_id"), F.lit(SALT)).cast("int"))
    return salted.join(arrays, ["source_dataset", "salt"], how).drop("salt")


def _hit(line, bp):
    # an array of one, so that the hash is taken once for both of its uses
    listed = F.exists(F.array(line_hash(line)), lambda h: F.array_contains(F.element_at(bp, (F.pmod(h, F.lit(BUCKETS)) + 1).cast("int")), h))
    return listed & _is_long(line)


def occurrences(chunks: DataFrame, arrays: DataFrame) -> DataFrame:
    """(chunk_id, source_dataset, hits): of each chunk with boilerplate its lines (line_no, h) in order; a redelivered chunk once."""
    rows = _attach(chunks.where(F.col("text").isNotNull()).select("chunk_id", "source_dataset", "text"), arrays, "inner")
    hits = F.filter(F.transform(_lines(F.col("text")), lambda l, i: F.when(
        _hit(l, F.col("bp")), F.struct((i + 1).cast("int").alias("line_no"), line_hash(l).alias("h")))), lambda s: s.isNotNull())
    return rows.select("chunk_id", "source_dataset", hits.alias("hits")).where(F.size("hits") > 0).distinct()


def strip(chunks: DataFrame, arrays: DataFrame, column: str = "text") -> DataFrame:
    """``chunks`` with ``column`` freed of its source's boilerplate lines; other rows unchanged."""
    kept = F.array_join(F.filter(_lines(F.col(column)), lambda l: ~_hit(l, F.col("bp"))), "\n")
    # a text without any boilerplate keeps its bytes; array_join gives them back unchanged
    return _attach(chunks, arrays, "left").withColumn(column, F.when(F.col("bp").isNull(), F.col(column)).otherwise(kept)).drop("bp")


def _components(pdf: pd.DataFrame) -> pd.DataFrame:
    parent: dict[int, int] = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for h in pdf["h"]:
        parent.setdefault(h, h)
    for a, b in zip(pdf["h"], pdf["nxt"]):
        if b in parent:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    out = pdf[["source_dataset", "h"]].drop_duplicates().copy()
    out["block"] = [root(h) for h in out["h"]]
    return out


def _blocks(found: DataFrame, occ: DataFrame, min_edge_share: float) -> DataFrame:
    """(source_dataset, h, support, block) of materialised nodes and occurrences.

    An edge is supported when the two lines follow each other in ``min_edge_share`` of the
    occurrences of the rarer one. Groups of the grouped map hold the nodes of one source,
    which are at most lines per chunk / min_share.
    """
    two = F.filter(F.zip_with("hits", F.slice("hits", 2, F.greatest(F.size("hits"), F.lit(1))), lambda a, b: F.struct(a["h"].alias("h"), b["h"].alias("nxt"), (b["line_no"] - a["line_no"]).alias("gap"))), lambda e: e["gap"] == 1)
    edges = (
        occ.select("chunk_id", "source_dataset", F.explode(F.array_distinct(two)).alias("e")).select("chunk_id", "source_dataset", "e.h", "e.nxt")
        .groupBy("source_dataset", "h", "nxt").agg(F.count("*").alias("w"))
    )
    other = found.select("source_dataset", F.col("h").alias("nxt"), F.col("support").alias("support_2"))
    strong = edges.join(found, ["source_dataset", "h"]).join(other, ["source_dataset", "nxt"]).where(
        F.col("w") >= F.least("support", "support_2") * min_edge_share
    )
    graph = found.join(strong.select("source_dataset", "h", "nxt"), ["source_dataset", "h"], "left").select(
        "source_dataset", "h", F.coalesce("nxt", "h").alias("nxt"))  # no nulls: pandas would turn the longs into doubles
    comps = graph.groupBy("source_dataset").applyInPandas(_components, "source_dataset string, h long, block long")
    return found.join(comps, ["source_dataset", "h"]).select("source_dataset", "h", "support", "block")


def _parts(chunks: DataFrame, min_edge_share: float) -> tuple[DataFrame, DataFrame]:
    """(occurrences, blocks), both materialised."""
    found = cut_lineage(nodes(chunks))
    occ = cut_lineage(occurrences(chunks, node_arrays(found)))
    return occ, cut_lineage(_blocks(found, occ, min_edge_share))


def blocks(chunks: DataFrame, min_edge_share: float = EDGE_SHARE) -> DataFrame:
    """(source_dataset, h, support, block): supported lines and the block their supported edges join them to."""
    return _parts(chunks, min_edge_share)[1]


def found_lines(chunks: DataFrame, min_edge_share: float = EDGE_SHARE) -> DataFrame:
    """p4_found: (chunk_id, line_no, block) of every line of a boilerplate block where it occurs, numbered from 1 when split at LF."""
    occ, found = _parts(chunks, min_edge_share)
    lines = occ.select("chunk_id", "source_dataset", F.explode("hits").alias("o")).select("chunk_id", "source_dataset", "o.line_no", "o.h")
    if found.count() <= BROADCAST_NODES:
        found = F.broadcast(found)
    return lines.join(found.select("source_dataset", "h", "block"), ["source_dataset", "h"]).select("chunk_id", "line_no", "block")


def clean(chunks: DataFrame, min_edge_share: float = EDGE_SHARE) -> DataFrame:
    """(chunk_id, text): every chunk's text without the occurrences of its source's blocks."""
    rows = chunks.select("chunk_id", "source_dataset", "text")
    return strip(rows, node_arrays(blocks(rows, min_edge_share))).select("chunk_id", "text").distinct()


def block_sizes(chunks: DataFrame, min_edge_share: float = EDGE_SHARE) -> DataFrame:
    """(source_dataset, n_lines, least_support, most_support) of each block."""
    return blocks(chunks, min_edge_share).groupBy("source_dataset", "block").agg(
        F.count("*").alias("n_lines"), F.min("support").alias("least_support"), F.max("support").alias("most_support")).drop("block")
