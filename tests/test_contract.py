"""Driver contract: entry runs, every query has a name and the oracles cover them."""

import re

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "record_reference" in df.columns


def test_registry_and_oracles():
    q, o = E.queries(), E.oracle_sql()
    own = {n for n in q if not re.match(r"op\d+_|pipeline$", n)}      # the training-data queries have their own tests
    assert len(own) >= 50
    assert own <= set(o) <= set(q)
