import random

from proseloom.llm import splits


def brute(rows):
    """Groups by repeated relabelling."""
    key = lambda s: " ".join(sorted("".join(c if c.isalnum() else " " for c in s.lower()).split()))
    nodes = {}
    for r in rows:
        own = set()
        a = key(r["author_slug"]) if r.get("author_slug") is not None else ""
        if a not in splits.NOBODY:
            own.add("a" + a)
        if r.get("story_key") is not None and key(r["story_key"]):
            own.add("s" + key(r["story_key"]))
        nodes[r["chunk_id"]] = own or {f"c{r['chunk_id']}"}
    label = {n: n for own in nodes.values() for n in own}
    changed = True
    while changed:
        changed = False
        for own in nodes.values():
            low = min(label[n] for n in own)
            for n in own:
                if label[n] != low:
                    label[n], changed = low, True
    return {c: label[next(iter(own))] for c, own in nodes.items()}


def test_groups_match_brute_force_and_stay_together(spark, make_chunks):
    rng = random.Random(4)
    spell = [str.upper, str.title, lambda s: s.replace("_", "-"), lambda s: "_".join(reversed(s.split("_"))), str]
    rows = []
    for i in range(400):
        a = rng.choice([None, "", "Anonymous", "Various-Authors", *[f"name{k}_last{k}" for k in range(40)]])
        s = rng.choice([None, *[f"book_{k}:{k}" for k in range(90)]])
        rows.append({"chunk_id": i, "author_slug": rng.choice(spell)(a) if a else a, "story_key": rng.choice(spell)(s) if s else s, "split": rng.choice([None, "train", "test"])})
    rows += rows[:30]  # delivered again
    got = {r.chunk_id: r for r in splits.group_splits(make_chunks(rows)).collect()}
    want = brute(rows)
    assert len(got) == 400
    groups = {}
    for c, r in got.items():
        groups.setdefault(want[c], set()).add((r.group_id, r.new_split))
    assert all(len(x) == 1 for x in groups.values())  # one group and one split for each true group
    assert len({next(iter(x))[0] for x in groups.values()}) == len(groups)
    stated = {}
    for r in rows:
        if r["split"]:
            stated.setdefault(want[r["chunk_id"]], set()).add(r["split"])
    assert all(r.n_stated == len(stated.get(want[c], ())) for c, r in got.items())


def test_shares_are_near_the_targets_even_with_a_hot_author(make_chunks):
    rows = [{"chunk_id": i, "author_slug": "hot_one" if i % 3 == 0 else f"a{i}", "story_key": f"k{i}"} for i in range(1500)]
    got = splits.report(make_chunks(rows)).collect()
    share = {r.new_split: r.share for r in got}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["test"] - 0.1) < 0.02


def test_chain_and_empty(spark, make_chunks):
    chain = [{"chunk_id": i, "author_slug": f"a{i // 2}", "story_key": f"s{(i + 1) // 2}", "split": "train"} for i in range(60)]
    assert len({r.group_id for r in splits.grouped(make_chunks(chain)).collect()}) == 1
    assert splits.group_splits(make_chunks([])).count() == 0
    assert splits.group_splits(make_chunks([{"chunk_id": None}, {"chunk_id": 1}])).count() == 2


def test_labels_are_spread_and_hot_keys_are_salted(spark, make_chunks):
    import pytest
    from proseloom.session import join_slim

    rows = [{"chunk_id": i, "author_slug": f"a{i // 3}", "story_key": f"k{i // 3}", "source_dataset": ("x", "y", None)[i // 3 % 3]} for i in range(3000)]
    df = make_chunks(rows)
    got = splits.report(df).collect()
    assert all(r.label_deviation < 0.1 and r.largest_label_gap < 0.03 for r in got) and abs(sum(r.share for r in got) - 1) < 1e-9
    assert all(r.n_divided == 0 for r in splits.group_sizes(df).collect())
    edges = spark.createDataFrame([(1, 1000 + i) for i in range(200)] + [(2, 1199), (3000 + 1, 3002)], "u long, v long")
    want = {(r.node, r.root) for r in splits.components(edges).collect()}
    assert {(r.node, r.root) for r in splits.components(edges, broadcast_nodes=0).collect()} == want and len({r for _, r in want}) == 2
    big, slim = spark.range(100).selectExpr("id", "id % 2 AS k"), spark.createDataFrame([(0, "x")], "k long, v string")
    assert {tuple(r) for r in join_slim(big, slim, "k", "id", False, "left").select("id", "v").collect()} == {(i, None if i % 2 else "x") for i in range(100)}
    with pytest.raises(RuntimeError):
        splits.components(edges, max_rounds=1)


def test_start_is_hashed():
    import numpy as np

    ids = np.arange(10_000, dtype=np.int64) * 7919
    at = splits._hashed_start(ids, np.array([0.8, 0.1, 0.1]), 0)
    assert abs((at == 0).mean() - 0.8) < 0.02 and (splits._hashed_start(ids[::-1].copy(), np.array([0.8, 0.1, 0.1]), 0)[::-1] == at).all()
