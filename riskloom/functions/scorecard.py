"""Points-to-double-the-odds scores, bands, decisions."""

import math

from pyspark.sql import functions as F

# Calibration, limits and band floors.
BASE_SCORE, BASE_ODDS, PDO = 660.0, 50.0, 35.0
P_MIN, P_MAX = 0.0001, 0.9999
SCORE_MIN, SCORE_MAX = 300, 850
BAND_FLOORS = [("Excellent", 750), ("Good", 670), ("Fair", 580)]
LOWEST_BAND = "Poor"
DECISION_OF_BAND = {
    "Excellent": "Approved", "Good": "Approved", "Fair": "ManualReview", "Poor": "Declined",
}
BAND_LABELS = {
    "Excellent": "Excelente", "Good": "Bueno", "Fair": "Moderado", "Poor": "Alto Riesgo",
}
DECISION_LABELS = {
    "Approved": "Aprobado", "ManualReview": "Revisión Manual", "Declined": "Rechazado",
}


def _lookup(col, mapping):
    result = None
    for key, value in mapping.items():
        hit = col == key
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result


def pdo_score(p, base=BASE_SCORE, odds=BASE_ODDS, pdo=PDO, clamp=True):
    """Score 300..850 of a default probability; NULL stays NULL, NaN is the lowest score."""
    factor = pdo / math.log(2.0)
    offset = base - factor * math.log(odds)
    safe = F.greatest(F.least(p, F.lit(P_MAX)), F.lit(P_MIN)) if clamp else p
    raw = F.lit(offset) + F.lit(factor) * F.log((F.lit(1.0) - safe) / safe)
    bounded = F.greatest(F.least(F.round(raw), F.lit(float(SCORE_MAX))), F.lit(float(SCORE_MIN)))
    return (
        F.when(p.isNull(), F.lit(None))
        .when(F.isnan(p), F.lit(SCORE_MIN))
        .otherwise(bounded.cast("int"))
    )


def risk_band(score):
    """Scores outside 300..850 fall into the lowest band, as do those below every floor."""
    result = None
    ceiling = SCORE_MAX
    for name, floor in BAND_FLOORS:
        hit = score.between(floor, ceiling)
        result = F.when(score.isNull(), F.lit(None)).when(hit, name) if result is None else result.when(hit, name)
        ceiling = floor - 1
    return result.otherwise(LOWEST_BAND)


def decision(band):
    return _lookup(band, DECISION_OF_BAND)


def band_label(band):
    return _lookup(band, BAND_LABELS)


def decision_label(name):
    return _lookup(name, DECISION_LABELS)
