import re

import __spark_entry__ as entry


def test_names_and_sql_belong_together():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 90
    assert all(re.fullmatch(r"[a-z0-9_]+", n) for n in queries)
    assert {f"p{n}_found" for n in (1, 5)} <= set(queries)


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "sentiment" in rows.columns
