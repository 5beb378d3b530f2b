"""Every span query against its SQL."""

import pytest

from lumenspan.plans.oracle import ORACLES
from lumenspan.queries import QUERIES
from tests.compare import same


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf, name):
    same(QUERIES[name](spark, sf), ORACLES[name], sf)


def test_entry_registers_queries_and_oracles(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 1


def test_entry_stands_without_the_training_data_queries(tmp_path):
    import os
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).parent.parent
    for name in ("lumenspan", "__spark_entry__.py"):
        copy = shutil.copytree if (root / name).is_dir() else shutil.copy
        copy(root / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True).stdout.split()
    assert run() == [str(len(QUERIES)), str(len(ORACLES)), "False"]  # without corpus_pipeline.py
    shutil.rmtree(tmp_path / "lumenspan" / "llm", ignore_errors=True)
    assert run() == [str(len(QUERIES)), str(len(ORACLES)), "False"]
