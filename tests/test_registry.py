"""Rules for the registered queries."""

import re

from conftest import ROOT

from slotflow.plans.registry import ORACLE, QUERIES


def test_names_and_docs():
    for name, fn in QUERIES.items():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert "pipeline" not in name and not re.match(r"op\d+_", name)
        assert fn.__doc__ and fn.__doc__.strip(), name


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE)
    for name, sql in ORACLE.items():
        assert "SELECT" in sql.upper(), name
        # whole tables: no row caps in the oracle except the top-k report
        assert (" LIMIT " not in sql.upper()) or name == "latest_sources", name


def test_entry_works_without_the_corpus_operators():
    """The optional subpackage may be absent; other import errors are not hidden."""
    import subprocess
    import sys

    code = "import sys; sys.path.insert(0, '.'); sys.modules[{!r}] = None\nimport __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    for gone in ("slotflow.llm", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", code.format(gone)], capture_output=True, text=True, cwd=ROOT)
        assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))], out.stderr
    out = subprocess.run([sys.executable, "-c", code.format("slotflow.schemas")], capture_output=True, text=True, cwd=ROOT)
    assert out.returncode != 0
