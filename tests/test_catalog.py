"""Every named query against its SQL, on the smallest tables."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from samedays.catalog import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("lineitem", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normalized(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)]
    plain = [[None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in row] for row in frame.to_numpy(object)]
    return sorted(map(repr, plain))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


def test_contract_without_the_optional_part(tmp_path):
    """The training-data operators and the pipeline may be missing; everything else still stands."""
    root = Path(contract.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "samedays", tmp_path / "samedays", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    asked = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", asked], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert said.stdout.splitlines()[-2:] == [" ".join(sorted(QUERIES))] * 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.sql(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) == len(expected) > 0
    assert normalized(got) == normalized(expected)


def test_entry(spark):
    row = contract.entry(spark).collect()[0]
    assert (row.lon1, row.lat1, row.lon2, row.lat2, row.n_days) == (-36.2, -24.2, 179.5, 74.5, 136)
