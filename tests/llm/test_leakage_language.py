import random

from hypothesis import given, settings, strategies as st

from proseloom.llm import language as L, leakage as K

WORDS = [a + b for a in ("mo", "ka", "ti", "lu", "re", "so", "ne", "pa", "vi", "du") for b in ("ran", "lek", "tor", "mis", "bel", "gan", "sut", "dor")]


def story(rng, n=120):
    return " ".join(rng.choice(WORDS) + (" the" if i % 3 else " and") for i in range(n))


def test_finds_equal_changed_and_moved_copies_only(spark, make_chunks):
    rng = random.Random(7)
    base = [story(rng) for _ in range(12)]
    swap = lambda t, share: " ".join("zzz" if rng.random() < share else w for w in t.split())
    half = lambda t: " ".join(t.split()[:120] + story(rng, 60).split())
    move = lambda t: " ".join(t.split()[120:] + t.split()[:120])
    rows = [{"chunk_id": i, "split": "train", "text": t} for i, t in enumerate(base)]
    variants = [(100, base[0].upper() + "!!"), (101, swap(base[1], 0.06)), (102, half(base[2])), (103, move(base[3])), (104, story(rng)), (105, ""), (106, None), (107, "tiny text"), (108, swap(base[4], 0.55))]
    rows += [{"chunk_id": i, "split": "test", "text": t} for i, t in variants] + [{"chunk_id": 120, "split": "train", "text": "Tiny  text."}, {"chunk_id": 121, "text": base[0]}]
    rows += rows[:5]
    got = {(r.chunk_id_1, r.chunk_id_2) for r in K.overlaps(make_chunks(rows)).collect()}
    assert got == {(0, 100), (1, 101), (3, 103), (107, 120)}
    assert K.overlaps(make_chunks([])).count() == 0
    assert sum(r.n_exact for r in K.report(make_chunks(rows)).collect()) == 2


def test_finds_copies_with_scattered_changes(make_chunks):
    rng = random.Random(13)
    base = [story(rng, 250) for _ in range(40)]
    fifth = lambda t: " ".join(f"new{rng.randrange(10_000)}" if i % 5 == 4 else w for i, w in enumerate(t.split()))
    rows = [{"chunk_id": i, "split": "train", "text": t} for i, t in enumerate(base)] + [{"chunk_id": 1000 + i, "split": "test", "text": fifth(t)} for i, t in enumerate(base)]
    rows += [{"chunk_id": 2000 + i, "split": "test", "text": fifth(base[0])} for i in range(80)]
    got = {(r.chunk_id_1, r.chunk_id_2) for r in K.overlaps(make_chunks(rows)).collect()}
    want = {(i, 1000 + i) for i in range(40)} | {(0, 2000 + i) for i in range(80)}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_unrelated_texts_of_one_kind_are_no_candidates(make_chunks):
    """Their shingles come from few patterns, so every text meets every other in some band; the pairs are not to be written down."""
    rng = random.Random(23)
    patterns = ["half of {} belongs to {}", "{} cannot trust a {}", "bring me {} or bring me the {}", "{} never wanted the {}", "take the {} and the {}"]
    text = lambda: ". ".join(rng.choice(patterns).format(*(f"{rng.choice(WORDS)}{rng.choice('abcdefgh')}" for _ in "xy")) for _ in range(25)) + "."
    rows = [{"chunk_id": i, "split": "test" if i % 3 else "train", "text": text()} for i in range(600)]
    rows += [{"chunk_id": 1000 + i, "split": "train" if i % 3 else "test", "text": rows[i]["text"] + " The end."} for i in range(20)]
    df = make_chunks(rows)
    feats = K.features(df.select("chunk_id", "source_dataset", "text", "split"), K.boilerplate.node_arrays(K.boilerplate.nodes(df)))
    near = K.candidates(feats, K.np.zeros(0, dtype=K.np.uint32))
    assert 20 <= near.count() <= 200  # of 80,000 pairs, 14,500 of which share a band
    assert {(r.chunk_id_1, r.chunk_id_2) for r in K.overlaps(df).collect()} >= {(i, 1000 + i) for i in range(20)}


def test_common_shingles_are_counted_over_all_different_texts(spark, make_chunks, monkeypatch):
    monkeypatch.setattr(K, "SAMPLE", 50, raising=False)  # of the sample that was taken before
    rng = random.Random(31)
    plain = lambda: story(rng, 20)
    texts = [plain() + (" under the same old moon" if i % 5 == 0 else "") + (" far from home again" if i % 10 == 0 else "") for i in range(700)]
    texts += [plain() + " copied words stand here"] * 400  # one text
    rows = [{"chunk_id": i, "split": "train", "text": t} for i, t in enumerate(texts)]
    df = make_chunks(rows + rows[:100]).select("chunk_id", "source_dataset", "text", "split").repartition(5)
    feats = K.features(df, K.boilerplate.node_arrays(K.boilerplate.nodes(df)))
    got = set(K.common_shingles(feats).tolist())
    count = {}
    for words in {tuple(K.words_of(t)) for t in texts}:
        for h in set(K.shingle_hashes([list(words)])[0].tolist()):
            count[h] = count.get(h, 0) + 1
    assert got == {h for h, n in count.items() if n >= K.COMMON_LEAST} and len(got) >= 5


def test_the_sieve_of_meetings_loses_no_case():
    rng = random.Random(29)
    for _ in range(300):
        a = [rng.choice(WORDS) for _ in range(rng.randrange(1, 400))]
        b = list(a)
        for _ in range(rng.randrange(0, len(a) // 4 + 1)):
            i = rng.randrange(len(b) + 1)
            b[i:i + rng.randrange(2)] = ["new"] * rng.randrange(2)
        if not b:
            continue
        bits, over = K.histograms([a, b])
        most = K.room(bits[:1], bits[1:], over.min(keepdims=True))[0]
        assert most >= K.kept_share(a, b) * max(len(a), len(b)) - 1e-6
        met = K.np.zeros(2, dtype=K.ENTRY)
        met["at"], met["h"], met["over"], met["bits"] = [len(a), len(b)], [1, 2], over * 2 + [1, 0], bits
        assert len(K.meet(met)[0]) == 1 or K.kept_share(a, b) < K.KEEP


def test_entries_of_a_text_take_as_much_in_any_number_of_rounds():
    """In one round for a small table and in twelve for a large one; as Spark compresses them."""
    import pyarrow as pa

    rng = random.Random(37)
    words = [K.words_of(story(rng, rng.randrange(60, 140))) for _ in range(300)]
    n = K.np.array([len(w) for w in words], dtype=K.np.int32)
    h, starts = K.shingle_hashes(words)
    if hasattr(K, "word_bits"):
        bits, over = K.word_bits(n, K.word_hashes(words))
    else:
        bits, over = K.histograms(words)
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(300), pa.int64()), pa.array([i % 5 == 0 for i in range(300)]), pa.array(n), pa.array(over, pa.int32()), pa.array([x.tobytes() for x in bits], pa.binary()),
        pa.array([x.tobytes() for x in K.np.split(h, starts[1:])], pa.binary())], names=["h", "is_eval", "n_words", "over", "bits", "shingles"])
    size = {}
    for rounds in (1, 12):
        out = [x for turn in range(rounds) for b in K._entries(K.np.zeros(0, dtype=K.np.uint32), turn, rounds, 30)([batch]) for x in b.column("entries").to_pylist()]
        assert sum(map(len, out)) == 300 * K.BANDS * K.ENTRY.itemsize
        size[rounds] = sum(len(pa.compress(x[i:i + 32768], codec="lz4_raw", asbytes=True)) for x in out for i in range(0, len(x), 32768))
    assert size[12] <= 1.1 * size[1] and size[12] <= 300 * K.BANDS * 90


def test_whole_histograms_are_no_looser_than_narrow_ones_and_lose_no_case():
    rng = random.Random(41)
    for _ in range(200):
        a = [rng.choice(WORDS + ["the"] * 30) for _ in range(rng.randrange(1, 900))]
        b = [w if rng.random() < 0.8 else rng.choice(WORDS) for w in a]
        n = K.np.array([len(a), len(b)])
        bits, over = K.word_bits(n, K.word_hashes([a, b]))
        narrow, rest = K.narrowed(bits, n)
        whole = K.room(bits[:1], bits[1:], over.min(keepdims=True))[0]
        assert K.kept_share(a, b) * len(a) - 1e-6 <= whole <= K.room(narrow[:1], narrow[1:], rest.min(keepdims=True))[0]


def test_files_of_a_round_are_removed_before_the_next(spark):
    from proseloom.session import forget, shuffle_mark

    mark = shuffle_mark(spark)
    met = spark.range(1000).groupBy((K.F.col("id") % 10).alias("k")).count().checkpoint()
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    made = [i for i in range(mark + 1, shuffle_mark(spark)) if tracker.containsShuffle(i)]
    assert made and forget(spark, mark, 30)
    assert not any(map(tracker.containsShuffle, made)) and met.count() == 10


def test_most_kept_is_no_less_than_kept_share():
    rng = random.Random(4)
    for _ in range(50):
        a = [rng.choice("abcdef") for _ in range(rng.randrange(1, 40))]
        b = [rng.choice("abcdef") for _ in range(rng.randrange(1, 40))]
        assert K.most_kept(a, b) >= K.kept_share(a, b)


def test_large_groups_of_copies_keep_every_link_in_few_rows(make_chunks):
    rng = random.Random(11)
    a, b = story(rng), story(rng)
    near = " ".join("zzz" if i % 40 == 0 else w for i, w in enumerate(a.split()))
    rows = [{"chunk_id": i, "split": "train" if i % 3 else "test", "text": a} for i in range(60)] + [{"chunk_id": 100 + i, "split": "train", "text": near} for i in range(4)]
    rows += [{"chunk_id": 200, "split": "train", "text": b}, {"chunk_id": 201, "split": "test", "text": b}]
    df = make_chunks(rows)
    whole = {(r.chunk_id_1, r.chunk_id_2) for r in K.overlaps(df).collect()}
    assert len(whole) == 20 * 40 + 20 * 4 + 1
    ev, tr = [i for i in range(0, 60, 3)], [i for i in range(60) if i % 3]
    few = {(r.chunk_id_1, r.chunk_id_2) for r in K.overlaps(df, representatives=3).collect()}
    pair = lambda x, y: (min(x, y), max(x, y))
    want = {pair(x, y) for i, x in enumerate(ev) for j, y in enumerate(tr) if i < 3 or j < 3} | {pair(x, y) for i, x in enumerate(ev) for j, y in enumerate(range(100, 104)) if i < 3 or j < 3} | {(200, 201)}
    assert few == want
    got = {r.chunk_id: r for r in K.class_members(df).collect()}
    assert set(got) == {i for p in whole for i in p} and got[0].n_links == 44 and got[1].n_links == 20 == got[100].n_links and got[200].n_links == 1
    assert {got[i].class_id for i in range(60)} == {0} and {got[i].class_id for i in range(100, 104)} == {100} and got[201].split_side == "evaluation"


def test_recall_of_edited_copies_against_brute_force(make_chunks):
    """Every 8th to 12th word replaced, and 5 to 15 % at random; the truth is the passage share of each pair."""
    rng = random.Random(17)
    vocabulary = [f"{a}{b}{c}" for a in ("mo", "ka", "ti", "lu", "re", "so", "ne", "pa") for b in ("ran", "lek", "tor", "mis", "bel", "gan") for c in ("", "s", "ed", "ing", "ly")]
    the = lambda n: [rng.choice(vocabulary) if i % 4 else "the" for i in range(n)]
    rows, pairs, k = [], [], 0
    for rule in (8, 9, 10, 12, 0.05, 0.1, 0.12, 0.15):
        for _ in range(25):
            a = the(300)
            b = [f"new{rng.randrange(10**6)}" if (i % rule == rule - 1 if rule >= 1 else rng.random() < rule) else w for i, w in enumerate(a)]
            rows += [{"chunk_id": k, "split": "train", "text": " ".join(a)}, {"chunk_id": k + 1, "split": "validation", "text": " ".join(b)}]
            pairs.append((k, k + 1, K.kept_share(a, b), rule))
            k += 2
    got = {(r.chunk_id_1, r.chunk_id_2) for r in K.overlaps(make_chunks(rows)).collect()}
    for rule in {r for *_, r in pairs}:
        true = {(x, y) for x, y, share, r in pairs if share >= K.KEEP and r == rule}
        assert len(true & got) >= 0.9 * len(true), rule
    assert got <= {(x, y) for x, y, share, _ in pairs if share >= K.KEEP}


def test_kept_share_against_brute_force():
    rng = random.Random(3)
    a = [rng.choice(WORDS) for _ in range(100)]
    assert K.kept_share(a, a) == 1.0 and K.jaccard(a, a) == 1.0
    assert K.kept_share(a[50:] + a[:50], a) == 1.0
    assert abs(K.kept_share(a[:50], a) - 0.5) < 0.05
    assert K.kept_share(["a"], ["b"]) == 0.0
    same = ["ha"] * 20_000
    assert K.kept_share(same, same[:16_000]) == 0.8  # repetitive texts do not take the square of their length


def test_the_shortcut_is_the_verdict():
    from proseloom.llm import quality as Q

    line = st.sampled_from(["apple, pear, plum, fig, rope", "Name: value", "The old man went to the river, and he said that it was cold.", "x1 y2 z3 4 5", "- , - , a , b", "", "....... 12", "iPhone macBook fooBar", "a" * 40, "Кот и пёс", "note: the end of it", "¿qué? «ya»…"])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(line, max_size=8).map("\n".join) | st.text(alphabet="ab ,:.\nA1|é-", max_size=120))
    def run(text):
        totals, *_ = Q.Counts.of(text, False, False)
        other = totals[8] + (totals[10] if totals[8] > totals[9] else 0)
        assert Q.is_other(text) == (other * 2 > sum(totals[8:11]))
        assert not Q.plainly_prose(text) or totals[8] == 0

    run()


def test_minhash_estimates_jaccard():
    rng = random.Random(5)
    a = [rng.choice(WORDS) for _ in range(300)]
    b = a[:200] + [rng.choice(WORDS) for _ in range(100)]
    sig = K.minhashes([a, b, ["one", "two"]])
    assert abs((sig[0] == sig[1]).mean() - K.jaccard(a, b)) < 0.15 and len(sig) == 3


SAMPLES = {
    "en": ["the old man went to the river and he said that it was cold", "she had never seen such a garden in the winter of that year", "there was a letter on the table but nobody wanted to read it"],
    "de": ["der alte Mann ging an den Fluss und sagte, dass es kalt war", "sie hatte noch nie einen solchen Garten im Winter gesehen", "auf dem Tisch lag ein Brief, aber niemand wollte ihn lesen"],
    "es": ["el viejo fue al río y dijo que hacía mucho frío", "ella nunca había visto un jardín así en el invierno de aquel año", "había una carta sobre la mesa, pero nadie quería leerla"],
}


def test_languages_and_stated_labels(spark, make_chunks):
    rng = random.Random(1)
    text = lambda x, n=10: ". ".join(rng.choice(SAMPLES[x]) for _ in range(n)) + "."
    rows, log = [], []
    for i in range(90):
        x = ("en", "de", "es")[i % 3]
        rows.append({"chunk_id": i, "source_dataset": "s", "text": text(x)})
        if x != "en":
            log.append((i, {"de": "German", "es": "es-MX"}[x] if i % 2 else {"de": "deu", "es": "spa"}[x], i))
    rows += [{"chunk_id": 200, "text": text("de")}, {"chunk_id": 201, "text": text("en", 6) + "\n" + text("es", 6)}, {"chunk_id": 202, "text": ""}, {"chunk_id": 203}, {"chunk_id": 204, "text": text("en")}, {"chunk_id": 205, "text": text("en")}]
    log += [(204, "unknown", 1), (205, "de", 1), (205, "English", 2), (None, "fr", 1)]
    lg = spark.createDataFrame(log, "chunk_id long, language string, n int").selectExpr("chunk_id", "language", "timestamp_seconds(n) AS logged_at", "'x' AS stated")
    got = {(r.chunk_id, r.language) for r in L.unstated(make_chunks(rows + rows[:3]), lg).collect()}
    assert got == {(200, "de"), (201, "es"), (204, "en")}
    parts = [r for r in L.stretches(make_chunks(rows), lg).collect() if r.chunk_id == 201]
    assert [p.language for p in sorted(parts, key=lambda p: p.segment_no)] == ["en", "es"] and all(0 <= p.confidence <= 1 for p in parts)
    assert L.unstated(make_chunks([]), lg.limit(0)).count() == 0


def least_phrases(s, texts):
    """Least number of substrings of ``texts`` (or strange letters) that make up s."""
    best = [0] + [len(s) + 1] * len(s)
    for e in range(1, len(s) + 1):
        best[e] = min(best[b] + 1 for b in range(e) if e - b == 1 or any(s[b:e] in t for t in texts))
    return best[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abc ", max_size=25), max_size=4), st.lists(st.text(alphabet="abc ", max_size=25), max_size=4), st.lists(st.text(alphabet="abcd ", max_size=20), max_size=6))
def test_parses_have_the_fewest_phrases(x, y, strings):
    p = L.Parser(L.Automaton({"x": x, "y": y}, own=0))
    got = p.phrases(strings)
    assert got.tolist() == [[least_phrases(s, x), least_phrases(s, y)] for s in strings]


def test_scripts_of_many_letters():
    rng = random.Random(4)
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(3_000)) for _ in range(n))
    p = L.Parser(L.Automaton({"zh": [f" {han(400)} " for _ in range(10)], "en": [L.running(s.split()) for s in SAMPLES["en"]] * 200}))
    got = p.phrases([f" {han(60)} ", " the old man went to the river ", "\U0001F600x", ""])
    zh, en = p.languages.index("zh"), p.languages.index("en")
    assert got[0, zh] < got[0, en] and got[1, en] < got[1, zh] and got[3].tolist() == [0, 0] and p.letters <= 1 + L.LETTERS + L.BLOCKS


def test_phrases_cross_words_and_segments_have_their_places():
    p = L.Parser(L.Automaton({"en": [" the old man went to the river "], "de": [" der alte mann ging an den fluss "]}, own=0))
    assert p.phrases([" old man went "]).tolist()[0][p.languages.index("en")] == 1
    text = "The Old man went.  To the RIVER\n\n" + "so and on " * 40
    placed = L.placed_segments(text)
    assert [w for *_, w in placed] == L.segments(text)
    assert all(L.WORD.findall(text[s:e].lower()) == w for s, e, w in placed)


def test_rare_languages_are_learnt_and_false_labels_are_not():
    rng = random.Random(8)

    def fragment(x):
        w = rng.choice(SAMPLES[x]).split()
        i = rng.randrange(len(w) - 2)
        return w[i:i + rng.randrange(2, 5)]

    text = lambda x, n=6: ". ".join(" ".join(w for _ in range(4) for w in fragment(x)) for _ in range(n)) + "."
    rows = [("en", text("en")) for _ in range(200)] + [("es", text("es")) for _ in range(40)] + [("ca", text("es")) for _ in range(20)] + [("de", text("de")) for _ in range(4)]
    rows += [("es", text("en")) for _ in range(4)]
    rng.shuffle(rows)
    assert L.train(rows).languages == ["de", "en", "es"]
    assert L.train([]).languages == ["en"]


def test_languages_are_not_dropped_for_a_more_frequent_false_label():
    rng = random.Random(9)

    def fragment(x):
        w = rng.choice(SAMPLES[x]).split()
        i = rng.randrange(len(w) - 2)
        return w[i:i + rng.randrange(2, 5)]

    text = lambda x, n=6: ". ".join(" ".join(w for _ in range(4) for w in fragment(x)) for _ in range(n)) + "."
    rows = [("en", text("en")) for _ in range(120)] + [(x, text(x)) for x in ("de", "es") for _ in range(30)] + [("ro", text(rng.choice(("de", "es")))) for _ in range(80)]
    rng.shuffle(rows)
    assert L.train(rows).languages == ["de", "en", "es"]
    one = [[f"w{i}"] for i in range(1000)]
    taken = L._filled({"x": one}, 100 / L.CHARS)["x"]  # segments of all texts, not the first ones
    assert len(taken) > 10 and sum(int(s.strip()[1:]) >= 500 for s in taken) >= 0.3 * len(taken)
