import datetime as dt

from hypothesis import given, settings, strategies as st

from proseloom.llm import mixing as M, pieces as P


def test_mix(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a/1", " A_x", 100, t0), ("a/1", "a-x", 50, t0 + dt.timedelta(1)), ("a/2", "A_X", -5, t0), ("b/1", "b", None, t0), ("b/2", "b", 0, t0), ("c/1", "c", 10_000, t0), ("z/1", "zzz", 9, t0), ("c/1", "c", 10_000, t0)]
    rows += [(f"d/{i}", "d", 200, t0) for i in range(100)]
    seg = spark.createDataFrame(rows, "id string, corpus string, bytes long, updated_at timestamp").selectExpr("*", "1 AS own_bytes", "2 AS quota")
    tgt = spark.createDataFrame([("a_x", 0.25, 3), ("b", 0.05, 2), ("c", 0.1, 1), ("d", 0.6, 2)], "corpus string, target_share double, max_repeats int").selectExpr("*", "7 AS own_bytes")
    got = {r.corpus: r for r in M.shares(seg, tgt).collect()}
    assert got["a_x"].own_bytes == 50 and got["b"].own_bytes == 0 and {c for c, r in got.items() if r.short} == {"a_x", "b"}
    assert got["a_x"].used_bytes == 150 and got["a_x"].n_repeats == 3
    assert abs(got["d"].used_bytes - 0.6 * 30_050) < 200
    order = sorted(((r.deadline, r.corpus, r.bytes) for r in M.schedule(seg, tgt).collect() if r.corpus == "d"))
    assert all(abs(d * 0.6 * 30_050 - 200 * (k + 1)) < 1e-6 for k, (d, _, _) in enumerate(order))
    assert M.shares(seg.limit(0), tgt).count() == 4 and M.shares(seg, tgt.limit(0)).count() == 0


def test_schedule_deviates_by_less_than_a_block_for_every_corpus(spark):
    t0 = dt.datetime(2024, 1, 1)
    size = lambda c, i: {"a": 50 + 37 * i % 90, "b": 120, "c": 30 + i % 200, "d": 77}[c]
    seg = spark.createDataFrame([(f"{c}/{i}", c, size(c, i), t0) for c in "abcd" for i in range(90)], "id string, corpus string, bytes long, updated_at timestamp")
    tgt = spark.createDataFrame([("a", 0.45, 3), ("b", 0.3, 2), ("c", 0.15, 1), ("d", 0.1, 1)], "corpus string, target_share double, max_repeats int")
    for per_span in (10_000, 40):
        rows = sorted(M.schedule(seg, tgt, per_span).collect(), key=lambda r: r.position)
        assert [r.position for r in rows] == list(range(1, len(rows) + 1)) and len({(r.id, r.repeat_no) for r in rows}) == len(rows)
        used = {c: sum(r.bytes for r in rows if r.corpus == c) for c in "abcd"}
        total, most, had, laid, off = sum(used.values()), max(r.bytes for r in rows), dict.fromkeys("abcd", 0), 0, dict.fromkeys("abcd", 0.0)
        for r in rows:
            had[r.corpus] += r.bytes
            laid += r.bytes
            assert r.laid_bytes == laid
            for c in "abcd":
                off[c] = max(off[c], abs(had[c] - used[c] / total * laid))
        assert all(x < most for x in off.values()), off
        told = {r.corpus: r for r in M.shares(seg, tgt, per_span).collect()}
        assert all(abs(told[c].deviation_bytes - off[c]) < 1e-6 and told[c].used_bytes == used[c] and told[c].block_bytes == most for c in "abcd")


def test_sentence_ends_outrank_line_ends():
    line = "and so the words went on and on over the border of the line\n"
    text = line * 50 + "Here it ended. " + line * 40
    (_, end), *_ = P.cuts(text)
    assert text[:end].endswith("ended. ")
    wrapped = "The words of the first part\nended here.\n" * 200
    assert all(wrapped[:e].endswith(".\n") for _, e in P.cuts(wrapped))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abc .\n!é日", min_size=0, max_size=900), st.integers(50, 120), st.integers(1, 20))
def test_cuts_round_trip(text, limit, overlap):
    got = P.cuts(text, limit, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for (s, e), (s2, e2) in zip(got, got[1:]):
        assert s < e and e2 > e and 1 <= e - s2 <= overlap
    assert all(e - s <= limit for s, e in got)


def test_wrapped_prose_and_an_early_paragraph():
    sentence = "The old miller walked slowly along the river and thought about the letter that his brother had sent. "
    lines, row = [], ""
    for w in (sentence * 120).split():
        if len(row) + len(w) > 71:
            lines.append(row)
            row = ""
        row = f"{row} {w}".strip()
    wrapped = "\n".join([*lines, row])
    assert all(wrapped[:e].rstrip().endswith(".") for _, e in P.cuts(wrapped))
    early = (sentence * 20)[:1801].strip() + "\n\n" + sentence * 60
    (_, end), *_ = P.cuts(early)
    assert early[:end].endswith("\n\n")


def brute(text, limit, overlap):
    """Least cost over all chains of pieces that keep the rule, by recursion over (start, end of the piece before)."""
    from functools import cache

    at, kinds = P.cut_points(text)
    kind = dict(zip(at.tolist(), kinds.tolist()))
    n = len(text)
    least = -(-(n - overlap) // (limit - overlap))
    target = min(limit, (n + (least - 1) * overlap) / least)

    @cache
    def best(s, e):
        if s + limit >= n:
            return ((n - s - target) / target) ** 2
        reach = [x for x in kind if e < x <= s + limit]
        low = min((kind[x] for x in reach), default=None)
        ends = [x for x in reach if kind[x] == low] or [s + limit]
        penalty = 1.0 if low is None else P._KINDS[low][1]
        out = float("inf")
        for x in ends:
            words = [w for w in kind if max(x - overlap, 1) <= w < x]
            out = min(out, penalty + ((x - s - target) / target) ** 2 + best(min(words) if words else max(x - overlap, 1), x))
        return out

    return best(0, 0)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(["ab ", "cde. ", "f.\n", "gh\n", "ijk\n\n", "lmnopqr"]), min_size=4, max_size=30).map("".join))
def test_cuts_cost_the_least(text):
    limit, overlap = 24, 5
    if len(text) <= limit:
        return
    at, kinds = P.cut_points(text)
    kind = dict(zip(at.tolist(), kinds.tolist()))
    least = -(-(len(text) - overlap) // (limit - overlap))
    target = min(limit, (len(text) + (least - 1) * overlap) / least)
    got = P.cuts(text, limit, overlap)
    cost = sum(((e - s - target) / target) ** 2 + (0 if e == len(text) else P._KINDS[kind[e]][1] if e in kind else 1.0) for s, e in got)
    assert abs(cost - brute(text, limit, overlap)) < 1e-9
    for s, e in got[:-1]:
        before = max((x for _, x in got if x < e), default=0)
        assert kind.get(e, 9) == min([kind[x] for x in kind if before < x <= s + limit], default=9)


def test_huge_texts_are_cut_span_by_span(make_chunks):
    text = "\n\n".join("A sentence of some words here. " * (5 + i % 9) for i in range(300)) + "x" * 3_000
    rows = sorted(P.split_texts(make_chunks([{"chunk_id": 1, "text": text}] * 2), 1_000, 100, 4_000).collect(), key=lambda r: r.piece_no)
    assert [r.piece_no for r in rows] == list(range(1, len(rows) + 1)) and {r.n_pieces for r in rows} == {len(rows)}
    assert rows[0].start_char == 0 and rows[-1].end_char == len(text) and all(r.piece == text[r.start_char:r.end_char] and len(r.piece) <= 1_000 for r in rows)
    assert all(1 <= a.end_char - b.start_char <= 100 and b.end_char > a.end_char for a, b in zip(rows, rows[1:]))


def test_natural_ends_and_rows(spark, make_chunks):
    text = "\n\n".join(["A sentence of some words here. " * 20] * 15)
    rows = [{"chunk_id": 1, "text": text}, {"chunk_id": 1, "text": text}, {"chunk_id": 2, "text": "short"}, {"chunk_id": 3}, {"chunk_id": 4, "text": "x" * 9000}, {"chunk_id": 5, "text": "y" * 4000}]
    got = P.split_texts(make_chunks(rows)).collect()
    assert {r.chunk_id for r in got} == {1, 4}
    one = sorted((r for r in got if r.chunk_id == 1), key=lambda r: r.piece_no)
    assert [r.piece_no for r in one] == list(range(1, len(one) + 1)) and all(r.piece.endswith("\n\n") for r in one[:-1])
    assert P.split_texts(make_chunks([])).count() == 0
