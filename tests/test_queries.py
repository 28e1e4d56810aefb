"""Every registered query against its SQL text on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402

from marketlake.catalog.oracle import ORACLE  # noqa: E402
from marketlake.catalog.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the provided tables")


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    verdict, rows, _ = check_queries.compare(spark, con, name, SF)
    assert verdict == "ok"
    assert rows > 0 or name in {"serve_headline_chosen"}


def test_every_query_has_a_sql_text():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
