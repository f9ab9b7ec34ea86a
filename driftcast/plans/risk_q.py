"""Queries of the risk family (E1–E9, E18–E21, J2) over the fixtures."""

from __future__ import annotations

from driftcast.fixtures import fixture
from driftcast.operators.risk import load_inputs, risk_forecast, risk_year
from driftcast.plans.sqlparts import risk_sql

ANNEE = 2024  # the fixture weather covers January 2024


def inputs(spark, sf, annee=ANNEE, region=None):
    return load_inputs(fixture(spark, sf, "fx_ift"), fixture(spark, sf, "fx_calendrier"),
                       fixture(spark, sf, "fx_meteo"), annee, region)


def e8_risk_year(spark, sf):
    return risk_year(inputs(spark, sf))


def e8_risk_year_region(spark, sf):
    return risk_year(inputs(spark, sf, region="Île-de-France"))


def e9_risk_forecast(spark, sf):
    return risk_forecast(inputs(spark, sf), fixture(spark, sf, "fx_meteo_prev"))


QUERIES = {
    "e8_risk_year": (e8_risk_year, risk_sql(ANNEE)),
    "e8_risk_year_region": (e8_risk_year_region, risk_sql(ANNEE, region_code="11")),
    "e9_risk_forecast": (e9_risk_forecast, risk_sql(
        ANNEE, days_sql="SELECT DISTINCT time AS day FROM fx_meteo_prev",
        weather="fx_meteo_prev", neutral=False)),
}
