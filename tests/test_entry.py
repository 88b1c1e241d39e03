"""The contract of __spark_entry__."""

import sys

import __spark_entry__ as entry


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and "revenue_by_region" in queries
    assert all(callable(f) for f in queries.values())


def test_general_queries_do_without_the_training_data_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "quernstone.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    queries = entry.queries()
    assert "revenue_by_region" in queries and not any(name.startswith("op") and name[2:3].isdigit() or name == "pipeline" for name in queries)
    assert set(entry.oracle_sql()) <= set(queries)


def test_imports_need_no_session():
    """Modules are imported before there is a session, so no column is made while they load."""
    import os
    import subprocess

    code = "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 50)"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(entry.__file__))
    assert done.stdout.strip() == "True", done.stderr[-500:]
