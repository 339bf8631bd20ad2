import ast
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from postlake import queries, query_sources

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    wanted = duck.execute(queries.oracle_sql()[name])
    assert sorted(d[0] for d in wanted.description) == columns
    order = [[d[0] for d in wanted.description].index(c) for c in columns]
    right = sorted(str([plain(r[i]) for i in order]) for r in wanted.fetchall())
    assert sorted(str([plain(r[c]) for c in columns]) for r in got.collect()) == right


def test_platform_responses_read_every_order(spark):
    """Pages of all customers and platforms reach the operator; those of jazzhr give no postings."""
    pages = query_sources.bronze(spark, SF)
    assert pages.count() == spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey").distinct().count()
    kinds = {r["ats_platform"] for r in queries.queries()["platform_responses"](spark, SF).select("ats_platform").distinct().collect()}
    assert kinds == set(query_sources.EXPECTED) - {"jazzhr", "phenom"}


def test_entry(spark):
    assert entry.entry(spark).count() == 149
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_import_without_a_session():
    root = Path(entry.__file__).parent
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_training_data_operators():
    root = Path(entry.__file__).parent
    for path in root.glob("postlake/**/*.py"):
        if "llm" not in path.parts:
            names = [n.module or "" if isinstance(n, ast.ImportFrom) else " ".join(a.name for a in n.names) for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, (ast.Import, ast.ImportFrom))]
            assert not any("llm" in n.split(".") for n in names), path
    assert "postlake.queries" in sys.modules
