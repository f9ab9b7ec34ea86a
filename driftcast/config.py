"""Thresholds and fixed lookup values.

Everything in the "FIXED VALUES" blocks must stay equal to the published
method for results to match; they are data, not logic.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    """Weather and level thresholds (m/s, mm, cumulative daily IFT)."""

    # FIXED VALUES — weather thresholds of the method
    wind_forbidden: float = 19.0      # spraying forbidden at or above
    wind_strong: float = 11.0         # spraying discouraged at or above
    wind_calm: float = 5.0            # calm air at or below
    rain_limit: float = 2.0           # rain above this washes the day out
    # FIXED VALUES — risk level cut points (fixed-value method)
    level_cuts: tuple[float, float, float] = (1.0, 2.0, 4.0)


DEFAULT_THRESHOLDS = Thresholds()

# Earlier notebook variant of the weather flags.
# FIXED VALUES — wind max, rain, dispersion lower bound
V0_WIND_MAX = 11.0
V0_RAIN = 0.0
V0_DISPERSION = 4.0

# Day-window around a sampling period for targeted weather.
# FIXED VALUE
WINDOW_DAYS = 15

# Weather request batch sizes.
# FIXED VALUES
BATCH_REMOTE = 100
BATCH_LOCAL = 50

# FIXED VALUES — region name -> region code (18 regions)
REGION_CODES: dict[str, str] = {
    "Guadeloupe": "01",
    "Martinique": "02",
    "Guyane": "03",
    "La Réunion": "04",
    "Mayotte": "06",
    "Île-de-France": "11",
    "Centre-Val de Loire": "24",
    "Bourgogne-Franche-Comté": "27",
    "Normandie": "28",
    "Hauts-de-France": "32",
    "Grand Est": "44",
    "Pays de la Loire": "52",
    "Bretagne": "53",
    "Nouvelle-Aquitaine": "75",
    "Occitanie": "76",
    "Auvergne-Rhône-Alpes": "84",
    "Provence-Alpes-Côte d'Azur": "93",
    "Corse": "94",
}

# FIXED VALUES — crop name of the IFT table -> crop name of the spraying
# calendar (61 entries); names absent from this map have no calendar crop.
CROP_MAP: dict[str, str] = {
    "Blé tendre": "Blé tendre",
    "Blé dur": "Blé dur",
    "Orge d'hiver": "Orge d'hiver",
    "Orge de printemps": "Orge de printemps",
    "Triticale": "Céréales d'hiver",
    "Épeautre": "Céréales d'hiver",
    "Seigle d'hiver": "Céréales d'hiver",
    "Avoine": "Céréales",
    "Seigle de printemps": "Céréales",
    "Mélange de céréales": "Céréales",
    "Maïs": "Maïs",
    "Maïs ensilage": "Maïs",
    "Maïs doux": "Maïs",
    "Colza": "Colza",
    "Tournesol": "Tournesol",
    "Lin fibres": "Lin printemps",
    "Lin oléagineux": "Lin printemps",
    "Sorgho": "Sorgho",
    "Millet": "Millet",
    "Sarrasin": "Céréales",
    "Riz": "Céréales",
    "Betterave non fourragère / Bette": "Betterave",
    "Pomme de terre de consommation": "Pomme de terre de consommation",
    "Pomme de terre féculière": "Pomme de terre de consommation",
    "Pomme de terre primeur": "Pomme de terre de consommation",
    "Féverole": "Féverole",
    "Pois protéagineux": "Pois protéagineux",
    "Petits pois": "Pois de printemps",
    "Lentille cultivée (non fourragère)": "Pois de printemps",
    "Pois chiche": "Pois de printemps",
    "Mélange de légumineuses": "Pois protéagineux",
    "Mélange de légumineuses fourragères": "Luzerne",
    "Mélange de légumineuses fourragères (entre elles)": "Luzerne",
    "Mélange de protéagineux": "Pois protéagineux",
    "Autre mélange de plantes fixant l'azote": "Luzerne",
    "Soja": "Féverole d'hiver",
    "Lin d'hiver": "Lin d'hiver",
    "Luzerne déshydratée": "Luzerne",
    "Autre luzerne": "Luzerne",
    "Autre sainfoin": "Luzerne",
    "Autre trèfle": "Luzerne",
    "Prairie permanente": "Prairies",
    "Prairie en rotation longue (6 ans ou plus)": "Prairies",
    "Autre prairie temporaire de 5 ans ou moins": "Prairies",
    "Ray-grass de 5 ans ou moins": "Prairies",
    "Surface pastorale (SPH)": "Prairies",
    "Surface pastorale (SPL)": "Prairies",
    "Bois pâturé": "Prairies",
    "Vigne": "Vigne",
    "Vigne : raisins de cuve": "Vigne",
    "Vergers": "Arboriculture",
    "Cerise bigarreau pour transformation": "Arboriculture",
    "Prune d'Ente pour transformation": "Arboriculture",
    "Noisette": "Arboriculture",
    "Noix": "Arboriculture",
    "Châtaigne": "Arboriculture",
    "Châtaigneraie": "Arboriculture",
    "Agrume": "Arboriculture",
    "Oliveraie": "Arboriculture",
    "Petit fruit rouge": "Arboriculture",
    "Fraise": "Arboriculture",
}

# FIXED VALUES — French month names (lower case) in calendar order
MONTHS_FR: tuple[str, ...] = (
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
)

# FIXED VALUES — display states of the map: key, label, colour
DISPLAY_STATES: tuple[tuple[str, str, str], ...] = (
    ("no_calendar", "Hors calendrier (culture non couverte)", "#78909C"),
    ("no_data", "Données de risque non disponibles", "#CFD8DC"),
    ("0", "Aucun traitement ce jour", "#A5D6A7"),
    ("1", "Risque faible", "#FFF176"),
    ("2", "Risque modéré", "#FFB300"),
    ("3", "Risque élevé", "#F57C00"),
    ("4", "Risque très élevé", "#B71C1C"),
)

# FIXED VALUES — map centre when a selection is empty (lat, lon)
DEFAULT_CENTRE = (46.5, 2.3)

# FIXED VALUES — Lambert-93 (EPSG:2154) projection constants
L93_A = 6378137.0
L93_E = 0.081819191042816
L93_N = 0.7256077650532670
L93_C = 11754255.426096
L93_XS = 700000.0
L93_YS = 12655612.049876
L93_LON0_DEG = 3.0

# Standard daily weather columns kept after normalisation, in order.
# FIXED VALUES
WEATHER_COLUMNS: tuple[str, ...] = (
    "code_insee", "time",
    "temperature_2m_max", "temperature_2m_min",
    "precipitation_sum", "wind_speed_10m_mean",
)

# FIXED VALUES — measurement sheet header -> column name
MEASURE_RENAME: dict[str, str] = {
    "AASQA": "reseau",
    "Commune": "nom_commune",
    "Code INSEE": "code_insee",
    "xlamb93": "x_lamb93",
    "ylamb93": "y_lamb93",
    "Debut prelevement": "debut_prelevement",
    "Fin prelevement": "fin_prelevement",
    "Annee": "annee",
    "Semaine": "semaine",
    "jours de prelevement": "nb_jours_prelevement",
    "Coupure PM": "type_filtre",
    "prelevement": "nb_prelevement",
    "substance active": "substance",
    "Concentration (ng/m3)": "concentration_ng_m3",
}
