"""Every registered query against its SQL on the smallest tables."""

import ast
import collections
from pathlib import Path

import pytest

import shelfcast
from shelfcast.plans.catalog import ORACLES, QUERIES
from tools.check_oracle import compare, connect

QUICK_ROWS_ONLY = ["attribution_top5", "rf_importance", "forecast_single"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, sf_dir, name):
    problem, _ = compare(spark, duck, name, sf_dir, QUERIES, ORACLES)
    assert problem is None


@pytest.mark.parametrize("name", QUICK_ROWS_ONLY)
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("path", sorted(Path(shelfcast.__file__).parent.glob("**/*.py")), ids=lambda p: p.stem)
def test_no_name_is_bound_twice_in_a_module(path):
    names = collections.Counter()
    for node in ast.parse(path.read_text()).body:
        if isinstance(node, (ast.FunctionDef, ast.ClassDef)):
            names[node.name] += 1
        for target in getattr(node, "targets", []):
            names.update(n.id for n in ast.walk(target) if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Store))
    assert [n for n, times in names.items() if times > 1 and n != "_"] == []
