"""Driver contract: every query has an oracle, names are plain, callables take (spark, sf_dir)."""

import inspect

import __spark_entry__ as entry
from pulsegrid.plans.catalog import QUERIES


def test_queries_and_oracles_line_up():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(o)
    assert len(QUERIES) == 57
    for name, fn in q.items():
        assert list(inspect.signature(fn).parameters) == ["spark", "sf_dir"], name
    for name in QUERIES:
        assert not name.startswith("op") and "pipeline" not in name, name
        assert o[name].lstrip().upper().startswith("WITH"), name
