"""Invariants and plan shape of the yearly risk plan."""

import datetime as dt

from pyspark.sql import functions as F

from driftcast.fixtures import fixture
from driftcast.operators.risk import risk_days, risk_year
from driftcast.plans.registry import registry
from driftcast.plans.risk_q import inputs
from tests.conftest import SF_SMALL
from tests.helpers import rows_of


def _rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def test_region_run_equals_full_run_restricted(spark):
    full = risk_year(inputs(spark, SF_SMALL))
    reg = risk_year(inputs(spark, SF_SMALL, region="Île-de-France"))
    codes = fixture(spark, SF_SMALL, "fx_ift").where(F.col("code_insee_reg") == "11").select("insee_com")
    restricted = full.join(codes, "insee_com", "left_semi")
    assert _rows(reg.select(*full.columns)) == _rows(restricted)


def test_recompute_days_equals_year_on_those_days(spark):
    inp = inputs(spark, SF_SMALL)
    days = [dt.date(2024, 1, d) for d in (3, 9, 17, 30)] + [dt.date(2024, 7, 14)]
    part = risk_days(inp, F.array(*[F.lit(d) for d in days]))
    full = risk_year(inp).where(F.col("date").isin(days))
    assert _rows(part) == _rows(full)


def test_level_null_iff_risk_null(spark):
    df = risk_year(inputs(spark, SF_SMALL))
    bad = df.where(F.col("risque_0_4").isNull() != F.col("risque_brut").isNull()).count()
    assert bad == 0


def test_primary_key_unique(spark):
    df = risk_year(inputs(spark, SF_SMALL))
    assert df.groupBy("insee_com", "date").count().where("count > 1").count() == 0
    assert df.count() == fixture(spark, SF_SMALL, "fx_ift").where("ift_t IS NOT NULL").count() * 366


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_plan_has_no_nested_loop_or_python(spark):
    plan = _plan(risk_year(inputs(spark, SF_SMALL)))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_no_python_udf_in_any_query(spark):
    for name, (fn, _) in registry().items():
        if name.startswith(("a", "j1")):  # these write files while building
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan, name
