from hypothesis import given, settings, strategies as st

from proseloom.llm import boilerplate as B, quality as Q

from .conftest import PROSE


def test_lines_blocks_and_cleaning(spark, make_chunks):
    foot = ["Read more at the shelf, issue {0}!", "All rights reserved by us"]
    rows = []
    for i in range(40):
        text = f"Line number {i} of the tale tells of {'x' * (i + 1)}"
        if i % 4 == 0:
            text += "\n" + foot[0].format(i) + "\n" + foot[1].upper()
        rows.append({"chunk_id": i, "source_dataset": "s", "text": text})
    rows += [{"chunk_id": 100, "source_dataset": None, "text": foot[1]}, {"chunk_id": 101, "source_dataset": "s"}, {"chunk_id": 102, "source_dataset": "s", "text": ""}, rows[0]]
    df = make_chunks(rows)
    found = {(r.chunk_id, r.line_no) for r in B.found_lines(df).collect()}
    assert found == {(i, n) for i in range(0, 40, 4) for n in (2, 3)}
    blocks = B.blocks(df).collect()
    assert len(blocks) == 2 and len({b.block for b in blocks}) == 1 and {b.support for b in blocks} == {10}
    clean = {r.chunk_id: r.text for r in B.strip(df.select("chunk_id", "source_dataset", "text"), B.node_arrays(B.nodes(df))).collect()}
    assert "\n" not in clean[4] and clean[100] == foot[1] and clean[101] is None and clean[102] == ""
    small = B.node_arrays(B.nodes(df), most=0)
    assert "salt" in small.columns and {r.chunk_id: r.text for r in B.strip(df.select("chunk_id", "source_dataset", "text"), small).collect()} == clean
    assert {r.chunk_id: r.text for r in B.clean(df).collect()} == clean and {(r.n_lines, r.least_support) for r in B.block_sizes(df).collect()} == {(2, 10)}
    assert {(r.chunk_id, r.line_no) for r in B.occurrences(df, small).selectExpr("chunk_id", "inline(hits)").collect()} == found
    assert B.found_lines(make_chunks([])).count() == 0 and B.clean(make_chunks([])).count() == 0 and B.blocks(make_chunks([])).count() == 0


def test_verdicts(spark, make_chunks):
    junk = "\n".join(f"{i}\tkettle\t{i}.50\tNULL" for i in range(40))
    texts = [PROSE * 3, junk, PROSE + "\n" + junk, PROSE.upper(), "", None, " \n ", "- - -", "a" * 400, "harbor, mill, lane, boot, fox, rope, bell, coin, barn\n" * 5, "Das war der alte Müller, und er ging mit dem Brief in das Haus. " * 4]
    df = make_chunks([{"chunk_id": i, "source_dataset": "s", "text": t} for i, t in enumerate(texts)] * 2)
    got = {r.chunk_id: r for r in Q.stats(df, B.node_arrays(B.nodes(df.limit(0)))).collect()}
    want = {0: "prose", 1: "other", 3: "prose", 8: "other", 9: "other", 10: "prose"}
    assert {i: got[i].verdict for i in want} == want
    assert 4 not in got and 5 not in got and (6 not in got or got[6].verdict is None)
    assert got[0].n_words == 3 * len(PROSE.split())
    assert Q.stats(make_chunks([]), B.node_arrays(B.nodes(df.limit(0)))).count() == 0


def test_every_chunk_has_statistics(make_chunks):
    rows = [{"chunk_id": i, "source_dataset": "s", "text": "Read more at the shelf"} for i in range(6)]
    df = make_chunks(rows + [{"chunk_id": 10}, {"chunk_id": 11, "text": " \n"}, {"chunk_id": 12, "text": ""}, {"chunk_id": 13, "text": PROSE}, {"chunk_id": 10}])
    got = {r.chunk_id: r for r in Q.every_chunk(df, B.node_arrays(B.nodes(df))).collect()}
    assert set(got) == {*range(6), 10, 11, 12, 13} and got[13].verdict == "prose"
    assert all(got[i].verdict is None and got[i].n_words == got[i].n_lines == 0 and got[i].other_ratio == 0 for i in got if i != 13)


def test_pieces_of_huge_texts_add_up(spark, make_chunks):
    long = PROSE * 900 + "\n" + "x9k" * 40_000 + "\n" + PROSE * 300
    whole, *_ = Q.Counts.of(long, False, False)
    got = Q.merge(Q.partials(Q.pieces(make_chunks([{"chunk_id": 1, "text": long}] * 2)))).collect()
    assert len(got) == 1
    row = got[0].asDict()
    for name, v in zip(Q.Counts.NAMES, whole):
        if name in ("n_words", "n_letters", "n_common", "n_lines"):
            assert abs(row[name] - v) <= 2, name


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab .\n,1|", max_size=400), st.integers(5, 60))
def test_cut_loses_nothing_and_the_seams_join(text, size):
    parts = list(Q.cut(text, size))
    joined = ""
    for k, (p, left, right) in enumerate(parts):
        joined += p if k == 0 or left else "\n" + p
    assert joined == text
    folded = Q.fold_cut_lines([dict(zip(("totals", "head", "tail", "through"), Q.Counts.of(*p))) for p in parts])
    lines = folded[6] + sum(Q.Counts.of(*p)[0][6] for p in parts)
    assert abs(lines - sum(1 for x in text.split("\n") if x.strip())) <= len(parts)
