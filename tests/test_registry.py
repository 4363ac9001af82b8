import importlib.util
import sys

import __spark_entry__ as entry
import presswerk.plans.registry as registry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_core_never_imports_the_corpus_operators():
    for name in list(sys.modules):
        if name.startswith("presswerk") and not name.startswith("presswerk.llm"):
            spec = importlib.util.find_spec(name)
            if spec and spec.origin and "__spark_entry__" not in spec.origin:
                assert "presswerk.llm" not in open(spec.origin).read(), name


def test_entry_runs(spark, small):
    df = registry.QUERIES["v2_feed_stories"](spark, small)
    assert df.columns == ["interest", "rank", "article_id", "place"] and df.count() > 0
