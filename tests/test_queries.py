"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check_queries import compare

EXPECTED = entry.oracle_sql()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(name, spark, duck, small):
    frame = entry.queries()[name](spark, small)
    plan = frame._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    if name in EXPECTED:
        problem, _ = compare(frame, duck, EXPECTED[name])
        assert problem is None, problem
    else:
        assert frame.count() > 0


def test_every_inventory_row_has_a_query():
    sizes = {"s": 18, "p": 12, "j": 14, "a": 14, "w": 10, "o": 3, "u": 1, "f": 31, "n": 7, "g": 13, "m": 14, "d": 6}
    ids = {f"{letter}{i}" for letter, n in sizes.items() for i in range(1, n + 1)}
    found = {name.split("_")[0] for name in entry.queries()}
    assert ids - found == set()


def test_expected_results_only_for_registered_queries():
    assert set(EXPECTED) <= set(entry.queries())


def test_entry_is_the_gold_table(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert {"store_id", "product_id", "ds", "stockout_next_7d"} <= set(frame.columns)
