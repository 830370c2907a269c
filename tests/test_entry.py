import __spark_entry__ as entry


def test_every_query_is_checked_or_known_to_have_no_sql():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(o) >= 40


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
