"""Raw "sheet" tables: landed as Parquet/CSV with their original headers
(the XLSX codec itself is not built, see README)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# FIXED VALUES — original headers of the measurement sheet, in sheet order
MEASURE_SHEET_HEADERS = (
    "AASQA", "Commune", "Code INSEE", "xlamb93", "ylamb93", "Debut prelevement",
    "Fin prelevement", "Annee", "Semaine", "jours de prelevement", "Coupure PM",
    "prelevement", "substance active", "Concentration (ng/m3)", "LQ (ng/m3)",
)


def measurement_sheet(fx_raw: DataFrame) -> DataFrame:
    """The raw measurement fixture under the sheet's own headers."""
    cols = ["aasqa", "commune", "code_insee_txt", "xlamb93", "ylamb93", "debut_ts", "fin_ts",
            "annee", "semaine", "jours", "coupure", "prelevement", "substance",
            "concentration_txt", "lq"]
    return fx_raw.select(*[fx_raw[c].alias(h) for c, h in zip(cols, MEASURE_SHEET_HEADERS)])
