"""The driver contract: every query equals its SQL, and all of it works without the training-data folder."""

import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from cohortloom.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _rows(pdf):
    columns = sorted(pdf.columns)
    return sorted(str(x) for x in pdf[columns].astype(object).where(pdf[columns].notna(), None).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry_and_registration(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(ORACLE_SQL) <= set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_training_data_folder(tmp_path):
    top = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    shutil.copytree(f"{top}/cohortloom", tmp_path / "cohortloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{top}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); assert q and not any(k.startswith('op') for k in q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}).returncode == 0


def test_nothing_else_imports_the_training_data_folder():
    top = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    for path in glob.glob(f"{top}/cohortloom/**/*.py", recursive=True):
        if "/llm/" not in path:
            with open(path) as f:
                assert "llm" not in f.read(), path
