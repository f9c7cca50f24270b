"""Registered queries against their SQL on the driver's smallest tables, and the contract when the llm folders are gone."""

import decimal
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry_point
from millrace.plans.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")


def plain(rows):
    def one(v):
        if isinstance(v, (float, decimal.Decimal, int)) and not isinstance(v, bool):
            return None if v != v else round(float(v), 6)
        return v

    return sorted((tuple(map(one, r)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return c


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, con, name):
    q = QUERIES[name](spark, SMALL)
    o = con.sql(ORACLE_SQL[name])
    cols = sorted(q.columns)
    assert cols == sorted(o.columns)
    quoted = ", ".join(f'"{c}"' for c in cols)
    assert plain(map(tuple, q.select(*cols).collect())) == plain(o.project(quoted).fetchall())


@needs_data
def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_contract_without_the_llm_folders(tmp_path):
    """Everything but the two folders and the pipeline's file: the entry imports, and core tests pass."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for keep_pipeline in (True, False):
        copy = tmp_path / str(keep_pipeline)
        subprocess.run(["cp", "-r", root, str(copy)], check=True)
        for folder in ("millrace/llm", "tests/llm"):
            os.rename(copy / folder, tmp_path / f"{keep_pipeline}-{folder.replace('/', '-')}")
        if not keep_pipeline:
            os.rename(copy / "corpus_pipeline.py", tmp_path / "gone.py")
        code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
        env = {**os.environ, "PYTHONPATH": ""}
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=env)
    subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", "-p", "no:cacheprovider", "tests/test_operators.py", "tests/test_queries.py", "-k", "code_labels or entry or flow_region_quarter"], cwd=copy, check=True, env=env)
