"""Factor explanations: one struct per feature, ordered by the model's importances.

Importances and means are model constants, so the order is fixed when the plan is built.
"""

from pyspark.sql import functions as F

from riskloom.schemas import FEATURES

FALLBACK_IMPORTANCE = 0.05
GOOD, BAD, NEUTRAL = "Positivo", "Negativo", "Neutro"

# Display name, favourable side, text around the numbers, decimals, factor.
# The side is compared with the portfolio mean where no bound is given.
RULES = {
    "age_years": ("Edad del Cliente", ">=", None, "{} años (Promedio: {} años)", 1, 1.0),
    "employment_years": ("Años de Empleo", ">=", None, "{} años de estabilidad laboral", 1, 1.0),
    "annual_income": ("Ingreso Total Anual", ">=", None, "${} ingresos declarados", 0, 1.0),
    "income_per_family_member": ("Ingreso por Dependiente", ">=", None, "${} / miembro", 0, 1.0),
    "credit_history_length_months": (
        "Madurez del Historial", ">=", 12.0, "{} meses observados en buró", 0, 1.0),
    "historical_delinquency_rate": (
        "Tasa de Mora Histórica", "<=", 0.05, "{}% meses con mora registrada", 1, 100.0),
    "max_past_due_severity": (
        "Atraso Máximo Registrado", "<=", 1.0, "Nivel de severidad {} en buró", 0, 1.0),
    "delinquency_rate_last_6m": (
        "Mora Reciente (Últimos 6m)", "=", 0.0, "{}% en últimos meses", 1, 100.0),
}
DEFAULT_TEXT, DEFAULT_DECIMALS = "Valor: {}", 2


def decimals(x, places):
    """Fixed-point text, correctly rounded, without separators."""
    return F.when(F.isnan(x), "NaN").otherwise(
        F.call_function("format_number", x, F.lit("0." + "0" * places if places else "0")))


def _sentence(text, numbers):
    """The text with a number in place of each ``{}``: plain concatenation, no format parsing."""
    pieces = text.split("{}")
    parts = [F.lit(pieces[0])]
    for number, after in zip(numbers, pieces[1:]):
        parts += [number, F.lit(after)]
    return F.concat(*parts)


def _factor(name, importance, mean):
    value = F.col(name)
    known = ~F.isnan(value)
    if name not in RULES:
        display, text, places, scale = name, DEFAULT_TEXT, DEFAULT_DECIMALS, 1.0
        direction = F.when(known & (value > 0), GOOD).otherwise(NEUTRAL)
    else:
        display, side, bound, text, places, scale = RULES[name]
        limit = F.lit(bound) if bound is not None else (value if mean is None else F.lit(mean))
        hit = {">=": value >= limit, "<=": value <= limit, "=": value == limit}[side]
        direction = F.when(known & hit, GOOD).otherwise(BAD)
    numbers = [decimals(value * F.lit(scale), places)]
    if text.count("{}") == 2:
        numbers.append(decimals(value if mean is None else F.lit(mean), places))
    return F.struct(
        F.lit(name).alias("feature_name"),
        F.lit(display).alias("display_name"),
        value.alias("feature_value"),
        direction.alias("impact_direction"),
        F.lit(float(importance)).alias("relative_importance"),
        _sentence(text, numbers).alias("description"),
    )


def order_factors(importances, names=FEATURES):
    """Feature positions by falling importance; equal ones keep the feature order."""
    def weight(i):
        return importances[i] if i < len(importances) else FALLBACK_IMPORTANCE

    return sorted(range(len(names)), key=lambda i: -weight(i))


def factor_impacts(importances, means, names=FEATURES):
    """The ordered array of factor structs of a row. ``means``: feature name to portfolio mean."""
    return F.array(*[
        _factor(names[i], importances[i] if i < len(importances) else FALLBACK_IMPORTANCE,
                means.get(names[i]))
        for i in order_factors(importances, names)
    ])


def top_factors(col, k=5):
    return F.slice(col, 1, k)
