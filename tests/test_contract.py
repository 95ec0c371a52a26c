"""Every query key against its oracle SQL on the smallest tables; the survey's ids are all covered."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, canonical
from contract.registry import QUERIES
from tests.conftest import SF_DIR

# These train five full-size classifiers, which takes minutes; `check.py` and the driver run them, tests/test_ml.py their parts.
TRAINED = ("m06", "m07", "m10", "m13", "o05")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if not n.startswith(TRAINED)])
def test_query_equals_oracle(spark, lake, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_every_inventory_id_has_a_key():
    sizes = {"s": 17, "p": 13, "j": 8, "a": 16, "w": 3, "o": 5, "f": 22, "t": 26, "q": 25, "c": 5, "m": 14, "l": 1}
    ids = {f"{group}{i:02d}" for group, n in sizes.items() for i in range(1, n + 1)}
    assert {name.split("_")[0] for name in QUERIES} == ids
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
