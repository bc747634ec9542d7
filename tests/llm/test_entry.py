import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from compare import compare, duck
from farebox.llm.oracle import ORACLE
from farebox.llm.queries import QUERIES


def test_all_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(names) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf_dir, name):
    problem, rows, _, _ = compare(spark, duck(sf_dir), name, QUERIES[name], ORACLE[name], sf_dir)
    assert problem is None and rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_whitening", "op13_centroids"}))
def test_a_row_for_every_document(spark, sf_dir, name):
    got = {r.doc_id for r in QUERIES[name](spark, sf_dir).select("doc_id").collect()}
    assert got == {i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{sf_dir}/documents.parquet'").fetchall()}


def test_tasks_need_no_copy_of_the_library(sf_dir, tmp_path):
    """From another folder, the library on the driver's path alone."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from farebox.session import local_session
from farebox.llm.queries import QUERIES
spark = local_session(2, shuffle_partitions=2)
for name in ("op2_context_tree", "op4_near_copies", "op7_repeated_strings", "op9_packing", "op11_language", "op12_whitening", "op13_centroids"):
    print(name, QUERIES[name](spark, {sf_dir!r}).count() > 0)
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=600)
    assert run.stdout.count("True") == 7, run.stderr[-2000:]
