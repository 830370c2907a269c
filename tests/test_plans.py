"""The plans are the ones wanted: pruned scans, pushed filters, no cross joins, one exchange where one is enough."""

import io
from contextlib import redirect_stdout

import pytest

from proseloom.plans import registry
from proseloom.session import spread

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not __import__("os").path.isdir(DATA), reason="needs the test tables")


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name, schema", [
    ("doc_word_stats", "struct<doc_id:bigint,text:string>"), ("prose_verdicts", "struct<doc_id:bigint,text:string>"),
    ("fiction_quality", "struct<doc_id:bigint,text:string,source:string>"), ("sample_k", "struct<doc_id:bigint>"),
    ("duplicate_keys", "struct<chunk_id:bigint>")])
def test_scans_read_only_what_is_used(spark, name, schema):
    assert f"ReadSchema: {schema}" in plan(registry.QUERIES[name](spark, DATA))


def test_filters_reach_the_scan(spark):
    text = plan(registry.QUERIES["union_batch"](spark, DATA))
    assert "PushedFilters: [IsNotNull(split), EqualTo(split,train)]" in text


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {"stream_last_wins"}))
def test_no_unbounded_cross_join(spark, name):
    assert "CartesianProduct" not in plan(registry.QUERIES[name](spark, DATA))


@pytest.mark.parametrize("name", ["doc_word_stats", "style_metrics", "prose_verdicts", "fiction_quality", "language_fallback", "sentences_exploded", "fixed_chunks", "instruction_pairs"])
def test_row_operators_do_not_shuffle(spark, name):
    text = plan(registry.QUERIES[name](spark, DATA))
    assert not any(x in text for x in ("hashpartitioning", "rangepartitioning", "SinglePartition"))


def test_only_tables_of_few_splits_are_dealt_out(spark):
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, 64)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(many) is many


def test_row_operators_stay_in_the_jvm(spark):
    for name in ("doc_word_stats", "style_metrics", "prose_verdicts", "fiction_quality", "reflowed_docs", "page_quality"):
        text = plan(registry.QUERIES[name](spark, DATA))
        assert "Python" not in text and "Arrow" not in text
