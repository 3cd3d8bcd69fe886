"""Every registered query against its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks import ORACLES, QUERIES
from checks.compare import compare, database

from .conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    ok, note = compare(spark, con, SMALL, name)
    assert ok, note


def test_contract(spark):
    assert set(contract.queries()) >= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)
    df = contract.entry(spark)
    assert df.columns == [
        "order_id", "row_number", "line_item_id", "quantity", "price", "order_name", "created_at", "total",
    ]
    assert df.count() == 6000


def test_entry_without_the_corpus_package():
    """The other queries stay when that package and its pipeline are gone."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('orderloom.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "from checks import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(QUERIES)\n"
    )
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
