"""Names, schemas and thresholds shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal the published data set for results to agree.
# ---------------------------------------------------------------------------

# Raw file header -> column name used here.
RAW_HEADER = {
    "JOUR": "day",
    "CODE_STIF_TRNS": "carrier",
    "CODE_STIF_RES": "network",
    "CODE_STIF_ARRET": "stop_code",
    "ID_ZDC": "zone_id",
    "LIBELLE_ARRET": "stop",
    "CATEGORIE_TITRE": "category",
    "NB_VALD": "n",
}

UNDEFINED = "NON DEFINI"

CATEGORIES = [
    "Forfait Navigo",
    "Imagine R",
    "Amethyste",
    "Forfaits courts",
    "Contrat Solidarité Transport",
    "Autres titres",
    UNDEFINED,
]

CATEGORY_FIXES = {"Contrat Solidarite Transport": "Contrat Solidarité Transport"}

HOLIDAY = "ferie"
VACATION_TYPES = ["vacances", "rentree"]

# Values taken by an appended row when the submitter leaves a code out.
SUBMISSION_DEFAULTS = {"carrier": "100", "network": "110", "stop_code": "0", "zone_id": 0}

WEEKDAYS_FR = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
WEEKDAYS_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

PROFILE_NAMES_K2 = {"hub": "Méga-hubs", "standard": "Réseau standard"}
PROFILE_NAMES_K5 = {
    "hub": "Méga-hubs",
    "large": "Grands pôles multi-usages",
    "standard": "Arrêts urbains standards",
    "residential": "Résidentiel domicile-travail",
    "irregular": "Arrêts irréguliers / événementiels",
}

# Message patterns of an anomaly answer: observed count, stop mean.
ANOMALY_MESSAGES = {
    "low": "Trafic anormalement bas — possible grève, incident ou fermeture (%s vs moyenne %s)",
    "high": "Trafic anormalement élevé — possible événement exceptionnel (%s vs moyenne %s)",
    "normal": "Trafic normal (%s validations)",
}

# Published names of the feature columns, for consumers of the exported table.
PUBLISHED_FEATURE_NAMES = {
    "stop": "LIBELLE_ARRET",
    "day": "JOUR",
    "n": "NB_VALD",
    "carrier": "CODE_STIF_TRNS",
    "network": "CODE_STIF_RES",
    "stop_code": "CODE_STIF_ARRET",
    "zone_id": "ID_ZDC",
    "weekday": "jour_semaine",
    "is_weekend": "is_weekend",
    "month": "mois",
    "iso_week": "semaine_annee",
    "year": "annee",
    "is_holiday": "is_ferie",
    "is_vacation": "is_vacances",
    "lag1": "NB_VALD_lag1",
    "lag7": "NB_VALD_lag7",
    "mean7": "rolling_mean_7j",
    "std7": "rolling_std_7j",
    "congestion": "score_congestion",
    "carrier_index": "transporteur_encoded",
}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

VALIDATIONS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("network", T.StringType()),
        T.StructField("stop_code", T.StringType()),
        T.StructField("zone_id", T.LongType()),
        T.StructField("stop", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)

CALENDAR_FILE = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

# Model inputs in training order.
FEATURES = [
    "weekday",
    "is_weekend",
    "month",
    "iso_week",
    "is_holiday",
    "is_vacation",
    "lag1",
    "lag7",
    "mean7",
    "std7",
    "congestion",
    "carrier_index",
]

PROFILE_MEASURES = ["weekday_mean", "weekend_mean", "weekend_ratio", "volume", "variation"]

FOREST_INPUTS = ["norm", "gap", "z"]

DRIFT_SETS = {
    "traffic": ["n", "weekday", "is_weekend", "month", "lag1", "lag7", "mean7", "std7", "congestion"],
    "anomaly": ["n", "mean7", "std7", "congestion"],
    "clustering": PROFILE_MEASURES,
}

#: The test of numeric features of each set: many days or few stops.
DRIFT_TESTS = {"traffic": "wasserstein", "anomaly": "wasserstein", "clustering": "kolmogorov-smirnov"}


@dataclass(frozen=True)
class Settings:
    """Every tunable threshold, with the published defaults."""

    incomplete_days: int = 60
    z_threshold: float = 3.0
    z_message: float = 2.0
    contamination: float = 0.02
    forest_trees: int = 100
    forest_sample: int = 256
    train_share: float = 0.80
    overfit_gap: float = 0.05
    underfit_r2: float = 0.5
    forecast_min_days: int = 180
    forecast_min_mean: float = 500.0
    forecast_holdout: int = 30
    forecast_interval: float = 0.80
    forecast_changepoint_scale: float = 0.01
    forecast_changepoint_range: float = 0.8
    suspect_ratio: float = 0.5
    drift_share: float = 0.3
    drift_distance: float = 0.1
    drift_p_value: float = 0.05
    kmeans_restarts: int = 10
    seed: int = 42
    density_eps: float = 0.8
    density_min_points: int = 5


DEFAULTS = Settings()
