import pytest
from hypothesis import given, settings, strategies as st

from proseloom.llm import encoding as X

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(f"{X.FOLDER}/{X.NAME}.json")
    t.encode_special_tokens = True
    return t


def test_ids_match_the_library(spark, library):
    texts = [None, "", " ", "\n\n", "Hello world", "it's  the  end\r\n\r\nof  it ", "<|endoftext|> x", "naïve ﬁre ½ Ⅷ 日本語 🐉‍🚀 　x y", "a" * 500, "ab " * 300, "Привет, мир! " * 20, "0123456789" * 20, "x­y﻿"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, None)], "doc_id long, text string").selectExpr("*", "1 AS ids", "'t' AS t")
    enc = X.encode(df)
    got = {r.doc_id: r.ids for r in enc.collect()}
    for i, t in enumerate(texts):
        assert got[i] == library.encode(t or "", add_special_tokens=False).ids, t
    back = {r.doc_id: r.text for r in X.decode(enc).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert X.encode(df.limit(0)).count() == 0 and enc.count() == len(texts) + 1


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdefgh ", min_size=1, max_size=200).map(lambda s: s.replace(" ", "")).filter(bool))
def test_one_word_by_either_way(word):
    enc = test_one_word_by_either_way.enc = getattr(test_one_word_by_either_way, "enc", None) or X.Encoder(X.load())
    raw = word.encode()
    assert list(enc._short([raw])[0]) == list(enc._long(raw))
