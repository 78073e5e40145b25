"""Plan guards: no query builds all pairs, and the entry contract holds."""

import importlib.util
import os

import pytest

from tokenmill.plans.registry import load_all

from conftest import ROOT, SF_SMALL

QUERIES, ORACLES = load_all()
PAIRWISE = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PAIRWISE), name


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("entry_mod", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    rows = m.entry(spark).collect()
    assert len(rows) > 0
    assert set(m.oracle_sql()) <= set(m.queries())
