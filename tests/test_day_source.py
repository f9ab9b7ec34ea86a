"""Choosing the source on the weather equals choosing between the two
risk tables, for days in the file, in the year, in neither."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftcast.fixtures import fixture
from driftcast.operators.display import pick_source
from driftcast.operators.risk import RISK_COLUMNS, risk_days, risk_of_day
from driftcast.plans.risk_q import ANNEE, inputs
from driftcast.plans.surface_q import fc_day, fc_days
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(repr, df.select(*RISK_COLUMNS, "is_forecast").collect()))


@pytest.mark.parametrize("prefer", ["forecast", "history"])
@pytest.mark.parametrize("which", ["file", "year", "neutral", "neither"])
def test_source_of_a_day(spark, prefer, which):
    first = fc_days(spark, SF_SMALL).agg(F.min("date")).first()[0]
    day = {"file": first, "year": dt.date(ANNEE, 1, 10), "neutral": dt.date(ANNEE, 12, 24),
           "neither": dt.date(ANNEE + 7, 5, 5)}[which]
    inp = inputs(spark, SF_SMALL)
    got = rows(risk_of_day(inp, fixture(spark, SF_SMALL, "fx_meteo_prev"), F.lit(day), prefer))
    year = spark.range(1).select(F.explode(F.sequence(F.lit(dt.date(ANNEE, 1, 1)), F.lit(dt.date(ANNEE, 12, 31)))).alias("date"))
    history = risk_days(inp, F.array(F.lit(day)), F.lit(day), F.lit(day))
    want = rows(pick_source(history, fc_day(spark, SF_SMALL, F.lit(day), inp), F.lit(day), prefer, year,
                            fc_days(spark, SF_SMALL)))
    assert got == want
    assert bool(got) == (which != "neither" or prefer == "forecast")


def test_one_day_is_one_risk_plan(spark):
    inp = inputs(spark, SF_SMALL)
    df = risk_of_day(inp, fixture(spark, SF_SMALL, "fx_meteo_prev"), F.lit(dt.date(ANNEE, 1, 10)))
    assert df._jdf.queryExecution().analyzed().toString().count("RepartitionByExpression [insee_com") == 1
