"""All named queries: {name: (spark_fn, oracle_sql | None)}."""

from __future__ import annotations

from driftcast import fixtures
from driftcast.plans import coverage_q, crops_q, measures_q, misc_q, risk_extra_q, risk_q, sources_q, surface_q

FAMILIES = (risk_q, risk_extra_q, crops_q, measures_q, surface_q, sources_q, misc_q, coverage_q)


def registry() -> dict:
    out = {}
    for fam in FAMILIES:
        for name, (fn, sql) in fam.QUERIES.items():
            if name in out:
                raise KeyError(f"duplicate query {name}")
            out[name] = (fn, fixtures.oracle(sql) if sql else None)
    return out
