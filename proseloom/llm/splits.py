"""Problem 1: splits that keep related records together.

Records are linked by author (author_slug) and story (story_key). Groups are the connected
components of the graph of distinct (author, story) pairs, found with large-star/small-star
steps; only edges move, never texts. Whole groups then get a split: by the hash of the group
first, then parallel simulated annealing moves or exchanges groups to lessen the deviation of
split sizes and of each split's mixture of labels, and the best restart is kept. Labels are the
source_datasets; those beyond the LABELS most frequent ones share the last OTHERS of the strata.

Slugs and keys are the same when they hold the same words and numbers in any order, apart
from case and separators. Null, empty and placeholder authors and null or empty keys link
nothing; a record without any link is its own group. A chunk_id counts once however often
delivered (rows of an id carry the same values). An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut_lineage, join_slim

# Author slugs that name nobody, as sorted words.
NOBODY = ["", "author unknown", "anonymous", "authors various"]
SPLITS = ("train", "validation", "test")
TARGETS = (0.8, 0.1, 0.1)
LABELS, OTHERS = 28, 4  # sources with a stratum of their own, and strata that the other ones are hashed to
STRATA = LABELS + OTHERS
LABEL_FORCE = 0.5   # weight of the mixture of labels against the sizes
BROADCAST_NODES = 500_000  # rows of two or three longs that are broadcast; beyond, joins are salted
HEAVY = 2_000       # groups above total / HEAVY records are placed first, together: there can be at most HEAVY of them
BLOCK = 4_000       # groups of one annealing block, in the mean
RESTARTS = 3
STEPS, STEPS_HEAVY = 4, 20  # annealing steps per group, of a block of light groups and of the heavy ones


def words_key(c):
    """Words and numbers of a slug in lower case, sorted: the identity of slugs and keys."""
    return F.array_join(F.array_sort(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")), " ")


def strata(chunks: DataFrame) -> dict[str, int]:
    """Stratum of each of the LABELS most frequent sources; a null source is one of them."""
    n = chunks.groupBy(F.coalesce("source_dataset", F.lit("")).alias("label")).agg(F.count("*").alias("n"))
    return {r.label: i for i, r in enumerate(n.orderBy(F.desc("n"), "label").limit(LABELS).collect())}


def links(chunks: DataFrame) -> DataFrame:
    """(chunk_id, split, label, a, s): author and story node of each record, null where there is none."""
    a, s = words_key(F.col("author_slug")), words_key(F.col("story_key"))
    own, source = strata(chunks), F.coalesce("source_dataset", F.lit(""))
    number = F.create_map(*[x for k, i in own.items() for x in (F.lit(k), F.lit(i))])[source] if own else F.lit(None).cast("int")
    rows = chunks.select(
        "chunk_id", "split", F.coalesce(number, F.lit(LABELS) + F.pmod(F.xxhash64(source), F.lit(OTHERS)).cast("int")).alias("label"),
        F.when(F.col("author_slug").isNotNull() & ~a.isin(NOBODY), F.xxhash64(F.lit("a"), a)).alias("a"),
        F.when(F.col("story_key").isNotNull() & (s != ""), F.xxhash64(F.lit("s"), s)).alias("s"),
    )
    return rows.groupBy("chunk_id").agg(*[F.min(c).alias(c) for c in ("split", "label", "a", "s")])


def components(edges: DataFrame, max_rounds: int = 60, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """(node, root) of every node of the (u, v) edges, root the least node of its component.

    Alternating large-star and small-star (each round shortens paths, so the number of rounds
    is logarithmic; one that has not come to rest in ``max_rounds`` raises), lineage cut in the shared folder each round. Neighbours are never
    gathered: a step needs only each node's least neighbour, which is pre-aggregated before
    the shuffle, and a hub's edges are rewritten row by row, without a shuffle by the hub.
    """
    e = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    n_nodes = e.select("u").union(e.select("v")).distinct().count()
    small = n_nodes <= broadcast_nodes
    before, rest = None, n_nodes == 0
    for _ in range(max_rounds):
        if rest:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_slim(both, low, "u", "v", small).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = join_slim(large, low, "u", "v", small).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = cut_lineage(star.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        state = e.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        rest, before = (state.n, state.h) == before, (state.n, state.h)
    if not rest:
        raise RuntimeError(f"components have not come to rest in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))


def grouped(chunks: DataFrame) -> DataFrame:
    """(chunk_id, split, label, group_id) of each record."""
    rows = cut_lineage(links(chunks))
    edges = rows.where("a is not null and s is not null").select(F.col("a").alias("u"), F.col("s").alias("v")).distinct()
    roots = cut_lineage(components(edges).withColumnRenamed("node", "k"))
    key = rows.withColumn("k", F.coalesce("a", "s", F.xxhash64(F.lit("c"), F.col("chunk_id"))))
    return join_slim(key, roots, "k", "chunk_id", roots.count() <= BROADCAST_NODES, "left").select("chunk_id", "split", "label", F.coalesce("root", "k").alias("group_id"))


def _hashed_start(groups: np.ndarray, p: np.ndarray, restart: int) -> np.ndarray:
    """Split of each group by the hash of its id and the restart."""
    x = groups.view(np.uint64) ^ np.uint64((0x9E3779B97F4A7C15 * (restart + 1)) % 2**64)
    for a, b in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(a))) * np.uint64(b)
    u = (x ^ (x >> np.uint64(31))) / 2.0**64
    return np.minimum(np.searchsorted(np.cumsum(p), u, "right"), len(p) - 1)


def _anneal(groups: np.ndarray, sizes: np.ndarray, goal: np.ndarray, restart: int, steps: int) -> tuple[np.ndarray, float]:
    """Assignment of rows (groups x label counts) to splits with goal[split, label]; deviation of the best state."""
    rng = np.random.default_rng(1000 + restart)
    n, k = len(sizes), len(goal)
    total = sizes.sum(axis=1)
    p = np.maximum(goal.sum(axis=1), 0)
    at = _hashed_start(groups, p / p.sum() if p.sum() > 0 else np.full(k, 1 / k), restart)
    order = np.argsort(-total, kind="stable")
    have = np.zeros_like(goal)
    for i in order[: min(n, 256)]:  # a group too large for annealing to repair goes where most is missing
        if total[i] > 0.01 * total.sum():
            at[i] = int(np.argmax((goal - have).sum(axis=1)))
        have[at[i]] += sizes[i]
    have = np.stack([sizes[at == j].sum(axis=0) for j in range(k)]).astype(float)
    scale = max(total.sum(), 1.0)

    def cost(h):
        d = h - goal
        return (np.abs(d.sum(axis=-1)).sum(axis=-1) + LABEL_FORCE * np.abs(d).sum(axis=(-1, -2))) / scale

    now = cost(have)
    best, best_at = now, at.copy()
    heat = 0.02
    picks = rng.integers(0, n, steps)
    other = rng.integers(0, n, steps)
    to = rng.integers(0, k, steps)
    chance = rng.random(steps)
    for t in range(steps):
        i, j = picks[t], to[t]
        a = at[i]
        swap = None
        h = have.copy()
        if t % 3 == 0 and at[other[t]] != a:  # exchange two whole groups
            swap = other[t]
            b = at[swap]
            h[a] += sizes[swap] - sizes[i]
            h[b] += sizes[i] - sizes[swap]
        elif a != j:
            h[a] -= sizes[i]
            h[j] += sizes[i]
        else:
            continue
        c = cost(h)
        if c <= now or chance[t] < np.exp((now - c) / max(heat, 1e-9)):
            have, now = h, c
            if swap is None:
                at[i] = j
            else:
                at[i], at[swap] = at[swap], a
            if now < best:
                best, best_at = now, at.copy()
        heat *= 0.9995
    return best_at, float(best)


_COLS = [f"l{i}" for i in range(STRATA)]
_GOALS = [f"g{j}_{i}" for j in range(len(SPLITS)) for i in range(STRATA)]


def _anneal_block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("group_id")  # the result does not depend on the order of arrival
    goal = pdf[_GOALS].iloc[0].to_numpy(float).reshape(len(SPLITS), STRATA)
    share = pdf[_COLS].to_numpy(float)
    restart = int(pdf["restart"].iloc[0])
    per = STEPS_HEAVY if int(pdf["block"].iloc[0]) < 0 else STEPS
    at, dev = _anneal(pdf["group_id"].to_numpy(np.int64), share, goal, restart, max(10_000, min(per * len(pdf), 40_000)))
    return pd.DataFrame({"block": pdf["block"], "restart": restart, "group_id": pdf["group_id"], "n": pdf["n"], "new_split": [SPLITS[x] for x in at], "deviation": dev})


_OUT = "block int, restart int, group_id long, n long, new_split string, deviation double"


def _best_assignment(groups: DataFrame) -> DataFrame:
    """Anneal every (block, restart) in parallel; of each block the restart with the least deviation."""
    tried = cut_lineage(
        groups.withColumn("restart", F.explode(F.sequence(F.lit(0), F.lit(RESTARTS - 1))))
        .groupBy("block", "restart").applyInPandas(_anneal_block, _OUT))
    best = tried.groupBy("block").agg(F.min(F.struct("deviation", "restart"))["restart"].alias("restart"))
    return tried.join(F.broadcast(best), ["block", "restart"])


def _with_goal(groups: DataFrame, goal: DataFrame) -> DataFrame:
    """Each block's goal: the goal's mixture, scaled to the block's own label counts."""
    sums = groups.groupBy("block").agg(*[F.sum(c).alias("t" + c) for c in _COLS])
    both = sums.join(F.broadcast(goal))
    cols = []
    for i, c in enumerate(_COLS):
        whole = sum(F.greatest(F.col(f"w{j}_{i}"), F.lit(0.0)) for j in range(len(SPLITS)))
        for j in range(len(SPLITS)):
            part = F.greatest(F.col(f"w{j}_{i}"), F.lit(0.0)) / F.when(whole > 0, whole)
            cols.append((F.coalesce(part, F.lit(TARGETS[j])) * F.col("t" + c)).alias(f"g{j}_{i}"))
    return groups.join(F.broadcast(both.select("block", *cols)), "block")


def assign(groups_of: DataFrame) -> DataFrame:
    """group_id -> new_split over the rows of ``grouped``."""
    g = groups_of.groupBy("group_id").agg(F.count("*").alias("n"), *[F.count_if(F.col("label") == i).cast("double").alias(c) for i, c in enumerate(_COLS)])
    g = cut_lineage(g)
    size = g.agg(F.count("*").alias("k"), F.sum("n").alias("n")).first()
    if not size.k:
        return g.select("group_id", F.lit("train").alias("new_split"))
    heavy = F.col("n") > size.n / HEAVY
    n_blocks = max(1, size.k // BLOCK)
    goal_all = g.agg(*[(F.sum(c) * TARGETS[j]).alias(f"w{j}_{i}") for j in range(len(SPLITS)) for i, c in enumerate(_COLS)])
    first = _best_assignment(_with_goal(g.where(heavy).withColumn("block", F.lit(-1)), goal_all))
    placed = g.join(first.select("group_id", "new_split"), "group_id")
    left = goal_all.join(placed.agg(*[
        F.coalesce(F.sum(F.when(F.col("new_split") == s, F.col(c))), F.lit(0.0)).alias(f"p{j}_{i}")
        for j, s in enumerate(SPLITS) for i, c in enumerate(_COLS)]))
    goal_rest = left.select(*[(F.col(f"w{j}_{i}") - F.col(f"p{j}_{i}")).alias(f"w{j}_{i}") for j in range(len(SPLITS)) for i in range(STRATA)])
    light = g.where(~heavy).withColumn("block", F.pmod(F.xxhash64("group_id"), F.lit(n_blocks)).cast("int"))
    rest = _best_assignment(_with_goal(light, goal_rest))
    return first.select("group_id", "new_split").unionByName(rest.select("group_id", "new_split"))


def group_splits(chunks: DataFrame) -> DataFrame:
    """Per record: chunk_id, stated split, group_id, n_stated (different non-null splits in its group), new_split."""
    rows = cut_lineage(grouped(chunks))
    stated = rows.where("split is not null").groupBy("group_id", "split").agg(F.lit(1).alias("x")).groupBy("group_id").agg(F.count("x").alias("n_stated"))
    per_group = cut_lineage(assign(rows).join(stated, "group_id", "left").na.fill(0, ["n_stated"]))
    return join_slim(rows, per_group, "group_id", "chunk_id", per_group.count() <= BROADCAST_NODES).select("chunk_id", "split", "group_id", "n_stated", "new_split")


def report(chunks: DataFrame) -> DataFrame:
    """Records, groups and share of each new split; label_deviation, the records that stand in another split than the label's target shares ask for, against the split's records, and the largest deviation of a label's share."""
    rows = cut_lineage(group_splits(chunks))
    per = rows.groupBy("new_split").agg(F.count("*").alias("n_records"), F.count_distinct("group_id").alias("n_groups"))
    per = per.withColumn("share", F.col("n_records") / F.sum("n_records").over(W.partitionBy(F.lit(1))))
    want = F.create_map(*[x for s, t in zip(SPLITS, TARGETS) for x in (F.lit(s), F.lit(t))])
    lab = labels(chunks, rows).withColumn("off", F.abs(F.col("n_records") - want[F.col("new_split")] * F.col("n_label")))
    dev = lab.groupBy("new_split").agg((F.sum("off") / F.sum("n_records")).alias("label_deviation"), F.max(F.abs(F.col("share") - want[F.col("new_split")])).alias("largest_label_gap"))
    return per.join(F.broadcast(dev), "new_split")


def labels(chunks: DataFrame, rows: DataFrame) -> DataFrame:
    """(source_dataset, new_split, n_records, n_label, share) of every source and split, from the rows of ``group_splits``."""
    of = chunks.groupBy("chunk_id").agg(F.min("source_dataset").alias("source_dataset"))
    n = rows.join(of, "chunk_id").groupBy("source_dataset").pivot("new_split", list(SPLITS)).agg(F.count("chunk_id"))
    n = n.na.fill(0, list(SPLITS)).withColumn("n_label", sum(F.col(x) for x in SPLITS))
    return n.select("source_dataset", "n_label", F.explode(F.array(*[F.struct(F.lit(x).alias("new_split"), F.col(x).alias("n_records")) for x in SPLITS])).alias("x")).select(
        "source_dataset", "x.new_split", "x.n_records", "n_label", (F.col("x.n_records") / F.col("n_label")).alias("share"))


def group_sizes(chunks: DataFrame) -> DataFrame:
    """(n_records, n_groups, n_divided): groups by their number of records, and those of them that are not whole in one new split."""
    g = group_splits(chunks).groupBy("group_id", "new_split").agg(F.count("*").alias("n")).groupBy("group_id").agg(F.sum("n").alias("n_records"), F.count("*").alias("k"))
    return g.groupBy("n_records").agg(F.count("*").alias("n_groups"), F.count_if(F.col("k") > 1).alias("n_divided"))
