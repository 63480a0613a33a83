import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    m = load_entry()
    df = m.entry(spark)
    assert df.count() > 0
    assert "station_id" in df.columns


def test_registry_consistent():
    m = load_entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
    from stratus.catalog import QUERIES
    for name in QUERIES:  # the numbered names belong to the training-data operators
        assert not name.startswith("op")


def test_other_queries_stand_without_a_module_of_the_operators(monkeypatch):
    import sys

    from stratus.catalog import QUERIES
    for name in [m for m in sys.modules if m.startswith("stratus.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)  # as if it were not installed
    monkeypatch.setitem(sys.modules, "tiktoken", None)
    assert set(load_entry().queries()) == set(QUERIES)
