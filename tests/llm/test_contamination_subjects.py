import random

from proseloom.llm import contamination as C, subjects as S

WORDS = [a + b + c for a in ("mo", "ka", "ti", "lu", "re", "so") for b in ("ran", "lek", "tor", "mis", "bel") for c in ("", "s", "ing", "ed")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_passages_are_found_however_they_are_laid_out(spark):
    rng = random.Random(2)
    items = [(i, text(rng, 100)) for i in range(20)]
    w = {i: t.split() for i, t in items}
    other = lambda: text(rng, 80)
    changed = w[3][20:60]
    for k in (5, 15, 25, 35):
        changed[k] = "entirelydifferent"
    cases = [
        (1, f"{other()} {' '.join(w[0][10:40])} {other()}", 0), (2, ", ".join(w[1][:30]).upper(), 1), (3, other() + "\n".join(w[2][5:35]) + other(), 2), (4, " ".join(changed), 3),
        (5, " ".join(w[4][30:60]).replace("e", "e-\n").replace("a", "&#97;"), 4), (6, f"{other()} {' '.join(w[5][:18])} {other()}", None),
        (7, other(), None), (8, None, None), (9, "", None), (10, " ".join(x if i % 4 else "zz" for i, x in enumerate(w[6])), None), (11, "".join(w[7]), 7),
        (12, other() * 50 + " ".join(w[8]) + other() * 50, 8)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in cases] * 2, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS n_words")
    it = spark.createDataFrame(items, "item_id long, item_text string").selectExpr("*", "3 AS doc_id")
    got = {(r.doc_id, r.item_id) for r in C.leaks(docs, it).collect()}
    assert got == {(i, k) for i, _, k in cases if k is not None}
    assert C.leaks(docs.limit(0), it).count() == 0 and C.leaks(docs, it.limit(0)).count() == 0


def test_pruned_search_equals_exhaustive_scoring():
    import numpy as np

    rng = random.Random(9)
    ix = C.Index([(i, text(rng, 60)) for i in range(40)])
    h = C.gram_hashes(C._codes(C.letters(ix.texts[3][:200] + text(rng, 40))))
    _, term = ix.lookup(h)
    got = set(zip(*[x.tolist() for x in ix.search(np.zeros(len(term), dtype=np.int64), term)]))
    score = np.zeros(40)
    for t in term:
        for e in range(ix.post_from[t], ix.post_from[t] + ix.post_n[t]):
            score[ix.post_item[e]] += ix.post_impact[e]
    assert got == {(0, i) for i in range(40) if score[i] >= C.THRESHOLD} and (0, 3) in got
    postings = sum(int(ix.post_n[t]) for t in term)
    assert ix.read[1] < postings  # blocks that cannot reach the threshold are not read
    few = term[:10]  # too few terms for any item: no list is opened
    assert not len(ix.search(np.zeros(10, dtype=np.int64), few)[0]) and ix.read == (0, 0)


def test_few_items_and_shared_passages_are_found(spark):
    rng = random.Random(21)
    shared = text(rng, 27).split()
    shared[9] = shared[18] = "other"
    alone = text(rng, 60)
    items = [(i, f"{text(rng, 50)} {' '.join(shared)} {text(rng, 50)}") for i in range(6)]
    docs = spark.createDataFrame([(1, alone), (2, f"{text(rng, 40)} {' '.join(shared)} {text(rng, 40)}")], "doc_id long, text string")
    found = lambda rows: {(r.doc_id, r.item_id) for r in C.leaks(docs, spark.createDataFrame(rows, "item_id long, item_text string")).collect()}
    assert found([(9, alone)]) == {(1, 9)}
    short = text(rng, 30)
    docs = spark.createDataFrame([(1, f"{text(rng, 40)} {short} {text(rng, 40)}"), (2, f"{text(rng, 40)} {' '.join(shared)} {text(rng, 40)}"), (1, short)], "doc_id long, text string")
    for n in (1, 2, 3, 150):  # a whole short item, however many others there are
        assert found([(0, short), *[(i, text(rng, 60)) for i in range(1, n)]]) == {(1, 0)}
    many = [(i, f"{text(rng, 30)} {' '.join(shared)} {text(rng, 30)}") for i in range(150)]  # a passage of every item
    assert found(many) == {(2, i) for i in range(150)}
    it = spark.createDataFrame([(i, t, short if i == 7 else None) for i, t in many], "item_id long, item_text string, prompt string")
    got = C.leaks(docs.unionAll(spark.createDataFrame([(3, f"{short}. {' '.join(shared)}")], docs.schema)), it, part_chars=5_000).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, i) for d in (2, 3) for i in range(150)} and len(got) == 300
    assert {r.item_id for r in got if r.prompt_part > 0.9} == {7} and all(r.doc_id == 3 for r in got if r.prompt_part > 0.9)
    assert found(items) == {(2, i) for i in range(6)}


TOPICS = {"law": "court judge verdict lawsuit statute attorney".split(), "music": "violin melody chord orchestra rhythm sonata".split()}
PLAIN = "the old man saw a garden near the river and she took the letter from a table in the house".split()


def test_subjects_on_held_out_documents(spark):
    rng = random.Random(6)

    def sentence(s=None):
        words = [rng.choice(PLAIN) for _ in range(9)]
        if s:
            for k in rng.sample(range(9), 3):
                words[k] = rng.choice(TOPICS[s])
        return " ".join(words).capitalize() + "."

    rows, truth, labels = [], {}, []
    for i in range(300):
        subs = {0: [], 1: ["law"], 2: ["music"], 3: ["law", "music"]}[i % 4]
        parts = [sentence(s) for s in subs for _ in range(4)] + [sentence() for _ in range(4)]
        if not subs:
            parts[0] = parts[0].replace(parts[0].split()[3], "violin")  # in passing
        rng.shuffle(parts)
        rows.append((i, " ".join(parts)))
        truth[i] = set(subs)
        if i < 120:
            labels += [(i, s) for s in (["law"] if i % 15 == 0 else subs or [None])]
    rows += [(900, None), (901, ""), (902, " \n")] + rows[:5]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS source", "1 AS share")
    subs = spark.createDataFrame([("law", ""), ("music", "")], "subject string, description string")
    lab = spark.createDataFrame(labels + labels[:4], "doc_id long, subject string")
    got: dict[int, set] = {}
    found = S.about(docs, subs, lab).where("share >= 0.25").collect()
    for r in found:
        got.setdefault(r.doc_id, set()).add(r.subject)
    wrong = sum(got.get(i, set()) != truth[i] for i in range(120, 300))
    assert wrong <= 9 and len(found) == len({(r.doc_id, r.subject) for r in found})
    assert S.about(docs.limit(0), subs, lab).count() == 0 and S.about(docs, subs, lab.limit(0)).count() == 0
    told = S.calibration(docs, subs, lab).collect()
    assert {r.subject for r in told} == {"law", "music"} and all(r.n_held_out > 5 and r.error < 0.2 and 1 <= r.em_passes <= S.ROUNDS for r in told)
    sure = {r.doc_id: r.confidence for r in found if r.subject == "music"}
    of = [sure[i] for i in sure if "music" in truth.get(i, ()) and i >= 120]
    assert sum(of) / len(of) > 0.7


def test_posteriors_are_independent_and_calibration_follows_the_labels():
    import numpy as np
    import pyarrow as pa

    raw = next(S._tokens([pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["Court violin judge melody. Court judge here now.", None or "No sign at all. None here."]})]))
    word = lambda w: int(S.pd.util.hash_array(np.array([w], dtype=object)).view(np.int64)[0])
    p, _ = S.posteriors(S.Weights({word("court"): np.array([5.0, 0]), word("judge"): np.array([5.0, 0]), word("violin"): np.array([0, 5.0]), word("melody"): np.array([0, 5.0])}, 2), S.Batch(raw))
    assert (p[0] > 0.9).all() and p[1, 0] > 0.9 and p[1, 1] == 0 and (p[2:] == 0).all()  # one sentence about both
    counts = [(0, i, int(y), 10) for i in range(S.BINS) for y in (i >= 10,)] + [(1, 2, 0, 50)]
    curves, table = S.calibrate(counts, 2)
    q = S._posterior(curves, np.array([[0.1, 0.1], [0.6, 0.6]]))
    assert q[0].max() < 0.2 and q[1].min() > 0.8 and table.sum() == 10 * S.BINS + 50
    assert S.calibrate([], 1)[0].tolist() == [[16.0, -4.0]]
