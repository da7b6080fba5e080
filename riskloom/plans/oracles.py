"""DuckDB statements for the registered queries, built from shared common table expressions."""

import re

from riskloom.models import compare, forest, logistic
from riskloom.functions.scorecard import BASE_ODDS, BASE_SCORE, PDO
from riskloom.operators.scoring import ACTIVE_MODEL
from riskloom.operators.ties import TIE_EPS
from riskloom.plans import proxies as X, queries as Q, tree_sql as TS
from riskloom.schemas import FEATURES, LABEL, LEAKAGE_FREE_FEATURES, TEXT_LENGTHS

INT = r"regexp_full_match({0}, '[+-]?[0-9]+')"
REAL = r"regexp_full_match(lower({0}), '[+-]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)')"


def _int(c, kind, default):
    return f"coalesce(CASE WHEN {INT.format(c)} THEN try_cast({c} AS {kind}) END, {default})"


def _real(c, default):
    return f"coalesce(CASE WHEN {REAL.format(c)} THEN try_cast({c} AS double) END, {default})"


def _r(expr, name=None, digits=6):
    return f"round(cast({expr} AS double), {digits}) AS {name or expr}"


SEVERITY = ("CASE {0} WHEN '1' THEN 2 WHEN '2' THEN 3 WHEN '3' THEN 4 WHEN '4' THEN 5 WHEN '5' THEN 6 "
            "WHEN '0' THEN 1 ELSE 0 END")
MART_SEVERITY = ("CASE WHEN status_raw IN ('C', 'X') THEN 0 WHEN regexp_full_match(trim(status_raw), "
                 "'[+-]?[0-9]+') THEN cast(trim(status_raw) AS int) + 1 ELSE 0 END")
LATE, SEVERE = "status NOT IN ('C', 'X')", "status IN ('2', '3', '4', '5')"
MART_LATE = "status_raw IN ('0', '1', '2', '3', '4', '5')"
MART_SEVERE = "status_raw IN ('2', '3', '4', '5')"


def _rate(late):
    return ("CASE WHEN count(*) FILTER (months_balance >= -5) > 0 THEN count(*) FILTER "
            f"(months_balance >= -5 AND {late}) / count(*) FILTER (months_balance >= -5) ELSE 0.0 END")


def _score(p, clamp=True):
    safe = f"greatest(least({p}, 0.9999), 0.0001)" if clamp else p
    factor = f"({PDO}e0 / ln(2.0e0))"
    raw = f"{BASE_SCORE}e0 - {factor} * ln({BASE_ODDS}e0) + {factor} * ln((1.0e0 - {safe}) / {safe})"
    return f"cast(greatest(least(round({raw}), 850), 300) AS int)"


def _band(s):
    return (f"CASE WHEN {s} BETWEEN 750 AND 850 THEN 'Excellent' WHEN {s} BETWEEN 670 AND 749 THEN 'Good' "
            f"WHEN {s} BETWEEN 580 AND 669 THEN 'Fair' ELSE 'Poor' END")


def _band_label(b):
    return (f"CASE {b} WHEN 'Excellent' THEN 'Excelente' WHEN 'Good' THEN 'Bueno' "
            f"WHEN 'Fair' THEN 'Moderado' ELSE 'Alto Riesgo' END")


def _decision(b):
    return (f"CASE {b} WHEN 'Excellent' THEN 'Approved' WHEN 'Good' THEN 'Approved' "
            f"WHEN 'Fair' THEN 'ManualReview' ELSE 'Declined' END")


def _decision_label(d):
    return (f"CASE {d} WHEN 'Approved' THEN 'Aprobado' WHEN 'ManualReview' THEN 'Revisión Manual' "
            f"ELSE 'Rechazado' END")


def _sigmoid(z):
    return f"CASE WHEN {z} >= 35 THEN 1.0 WHEN {z} <= -35 THEN 0.0 ELSE 1.0 / (1.0 + exp(-({z}))) END"


def _gauss(prefix):
    return " + ".join(
        f"-0.5 * (ln(2 * pi()) + ln(greatest({prefix}v_{f}, 1e-9)) + ({f} - {prefix}m_{f}) * "
        f"({f} - {prefix}m_{f}) / greatest({prefix}v_{f}, 1e-9))" for f in FEATURES)


def _bayes_p(source):
    return (f"SELECT *, {_sigmoid('z')} AS p FROM (SELECT d.*, (ln(pp) + {_gauss('p')}) - "
            f"(ln(pn) + {_gauss('n')}) AS z FROM {source} d, nb) q")


def _scored(source):
    return (f"SELECT *, {_band('credit_score')} AS risk_band FROM (SELECT *, {_score('p')} AS credit_score "
            f"FROM ({_bayes_p(source)}) b) c")


FACTOR_TEXT = {
    "age_years": ("Edad del Cliente", "v >= m", "printf('%.1f años (Promedio: %.1f años)', v, m)"),
    "employment_years": ("Años de Empleo", "v >= m", "printf('%.1f años de estabilidad laboral', v)"),
    "annual_income": ("Ingreso Total Anual", "v >= m", "printf('$%.0f ingresos declarados', v)"),
    "income_per_family_member": ("Ingreso por Dependiente", "v >= m", "printf('$%.0f / miembro', v)"),
    "credit_history_length_months": ("Madurez del Historial", "v >= 12", "printf('%.0f meses observados en buró', v)"),
    "historical_delinquency_rate": ("Tasa de Mora Histórica", "v <= 0.05e0", "printf('%.1f%% meses con mora registrada', v * 100)"),
    "max_past_due_severity": ("Atraso Máximo Registrado", "v <= 1", "printf('Nivel de severidad %.0f en buró', v)"),
    "delinquency_rate_last_6m": ("Mora Reciente (Últimos 6m)", "v = 0", "printf('%.1f%% en últimos meses', v * 100)"),
}


def _factors():
    parts = []
    for i, f in enumerate(FEATURES):
        display, good, text = FACTOR_TEXT.get(f, (f, "v > 0", "printf('Valor: %.2f', v)"))
        bad = "Negativo" if f in FACTOR_TEXT else "Neutro"
        parts.append(
            f"SELECT customer_id, {i} AS idx, '{f}' AS feature_name, '{display}' AS display_name, v AS feature_value, "
            f"CASE WHEN {good} THEN 'Positivo' ELSE '{bad}' END AS impact_direction, imp AS relative_importance, "
            f"{text} AS description FROM (SELECT customer_id, {f} AS v, (SELECT avg({f}) FROM dataset) AS m, "
            f"(SELECT importance FROM nb_importance WHERE feature = '{f}') AS imp FROM dataset) t")
    union = " UNION ALL ".join(parts)
    return (f"SELECT customer_id, cast(row_number() OVER (PARTITION BY customer_id ORDER BY "
            f"relative_importance DESC, idx) - 1 AS int) AS position, feature_name, display_name, "
            f"round(feature_value, 6) AS feature_value, impact_direction, "
            f"round(relative_importance, 6) AS relative_importance, description FROM ({union}) u")


_DEMOGRAPHIC = f"""
 -days_birth / 365.25e0 AS age_years,
 CASE WHEN days_employed > 0 THEN 0.0 ELSE -days_employed / 365.25e0 END AS employment_years,
 CASE WHEN days_employed > 0 THEN 1.0e0 ELSE 0.0e0 END AS is_unemployed_or_retired,
 total_income AS annual_income,
 total_income / CASE WHEN family_members_count > 0 THEN family_members_count ELSE 1.0e0 END AS income_per_family_member,
 cast(children_count AS double) AS children_count,
 CASE WHEN family_members_count > 0 THEN family_members_count ELSE 1.0e0 END AS family_members_count,
 cast(own_car AS double) AS own_car, cast(own_realty AS double) AS own_realty,
 cast(has_work_phone AS double) AS has_work_phone, cast(has_email AS double) AS has_email,
 cast(coalesce(total_months_observed, 0) AS double) AS credit_history_length_months,
 coalesce(delinquency_rate, 0.0e0) AS historical_delinquency_rate,
 coalesce(max_severity, 0.0e0) AS max_past_due_severity,
 coalesce(recent_delinquency_rate_6m, 0.0e0) AS delinquency_rate_last_6m,
 cast(is_bad_customer AS double) AS is_default
"""


def _confusion(source, limit):
    return f"""
SELECT model_name, count(*) FILTER (y = 1 AND p >= {limit!r}) AS true_positives,
 count(*) FILTER (y = 0 AND p >= {limit!r}) AS false_positives, count(*) FILTER (y = 0 AND p < {limit!r}) AS true_negatives,
 count(*) FILTER (y = 1 AND p < {limit!r}) AS false_negatives, count(*) AS total_samples FROM {source} GROUP BY ALL"""


def _split(source):
    return f"""
SELECT customer_id, is_default, rn <= round(0.8e0 * n) AS is_train FROM (SELECT customer_id, is_default,
 row_number() OVER (PARTITION BY is_default ORDER BY md5(concat('{Q.SEED}:', customer_id))) AS rn,
 count(*) OVER (PARTITION BY is_default) AS n FROM {source}) t"""


# name: (names it builds on, body)
CTES = {
    "app_raw": ([], X.duckdb_text(X.APPLICATION_RAW)),
    "credit_raw": ([], X.duckdb_text(X.CREDIT_RAW)),
    "scored": ([], X.duckdb_text(X.SCORED)),
    "close": ([], X.duckdb_text(X.CLOSE)),
    "score_log": ([], X.duckdb_text(X.SCORE_LOG)),
    "reqs": ([], X.duckdb_text(X.SCORE_REQUESTS)),
    "apps_typed": (["app_raw"], f"""
SELECT seq, cast(ID AS bigint) AS customer_id, CODE_GENDER AS gender, FLAG_OWN_CAR = 'Y' AS own_car,
 FLAG_OWN_REALTY = 'Y' AS own_realty, {_int('CNT_CHILDREN', 'int', 0)} AS children_count,
 {_real('AMT_INCOME_TOTAL', '0.0e0')} AS total_income, NAME_INCOME_TYPE AS income_type,
 NAME_EDUCATION_TYPE AS education_type, NAME_FAMILY_STATUS AS family_status,
 NAME_HOUSING_TYPE AS housing_type, {_int('DAYS_BIRTH', 'int', 0)} AS days_birth,
 {_int('DAYS_EMPLOYED', 'int', 0)} AS days_employed, FLAG_MOBIL = '1' AS has_mobile,
 FLAG_WORK_PHONE = '1' AS has_work_phone, FLAG_PHONE = '1' AS has_phone, FLAG_EMAIL = '1' AS has_email,
 CASE WHEN trim(OCCUPATION_TYPE) <> '' THEN OCCUPATION_TYPE END AS occupation_type,
 {_real('CNT_FAM_MEMBERS', '1.0e0')} AS family_members_count
FROM app_raw WHERE {INT.format('ID')}"""),
    "apps": (["apps_typed"], "SELECT * EXCLUDE (seq) FROM (SELECT *, row_number() OVER (PARTITION BY "
             "customer_id ORDER BY seq DESC) AS rn FROM apps_typed) t WHERE rn = 1"),
    "recs": (["credit_raw"], f"""
SELECT cast(ID AS bigint) AS customer_id, cast(MONTHS_BALANCE AS int) AS months_balance,
 CASE WHEN trim(STATUS) IN ('C','X','0','1','2','3','4','5') THEN trim(STATUS) ELSE '0' END AS status,
 STATUS AS status_raw FROM credit_raw WHERE {INT.format('ID')} AND {INT.format('MONTHS_BALANCE')}"""),
    "summary": (["recs"], f"""
SELECT customer_id, count(*) AS total_months_observed, least(0, min(months_balance)) AS min_month_balance,
 max(months_balance) AS max_month_balance, count(*) FILTER ({SEVERE}) AS severe_delinquency_count,
 count(*) FILTER ({LATE}) AS any_delinquency_count, count(*) FILTER ({SEVERE}) > 0 AS is_bad_customer,
 count(*) FILTER ({LATE}) / count(*) AS delinquency_rate,
 cast(max({SEVERITY.format('status')}) AS double) AS max_severity,
 cast({_rate(LATE)} AS double) AS recent_delinquency_rate_6m,
 -max(months_balance) FILTER ({LATE}) AS months_since_last_delinquency
FROM recs GROUP BY customer_id"""),
    "msummary": (["recs"], f"""
SELECT customer_id, cast(count(*) AS int) AS total_months_observed,
 cast(count(*) FILTER ({MART_LATE}) AS int) AS delinquent_months_count,
 cast(count(*) FILTER ({MART_SEVERE}) AS int) AS severe_delinquency_count,
 round_even(count(*) FILTER ({MART_LATE}) / count(*), 4) AS historical_delinquency_rate,
 cast(max({MART_SEVERITY}) AS int) AS max_past_due_severity,
 round_even(cast({_rate(MART_LATE)} AS double), 4) AS delinquency_rate_last_6m,
 CASE WHEN count(*) FILTER ({MART_SEVERE}) > 0 THEN 1 ELSE 0 END AS is_default
FROM recs GROUP BY customer_id"""),
    "mart_summary": (["msummary", "apps"],
                     "SELECT * FROM msummary WHERE customer_id IN (SELECT customer_id FROM apps)"),
    "mart_apps": (["apps", "recs"], """
SELECT customer_id, gender, own_car, own_realty, children_count, total_income AS annual_income, income_type,
 education_type, family_status, housing_type, round_even(-days_birth / 365.25e0, 2) AS age_years,
 CASE WHEN days_employed > 0 THEN 0.0e0 ELSE round_even(-days_employed / 365.25e0, 2) END AS employment_years,
 days_employed > 0 AS is_unemployed_or_retired, has_mobile, has_work_phone, has_phone, has_email,
 occupation_type, greatest(family_members_count, 1.0e0) AS family_members_count,
 round_even(total_income / greatest(family_members_count, 1.0e0), 2) AS income_per_family_member
FROM apps WHERE customer_id IN (SELECT customer_id FROM recs)"""),
    "dataset": (["apps", "summary"],
                f"SELECT a.customer_id, {_DEMOGRAPHIC} FROM apps a JOIN summary s ON a.customer_id = s.customer_id"),
    "all_features": (["apps", "summary"],
                     f"SELECT a.customer_id, {_DEMOGRAPHIC} FROM apps a LEFT JOIN summary s ON a.customer_id = s.customer_id"),
    "log": (["score_log"], f"""
SELECT score_id, customer_id, credit_score, round(probability_of_default, 5) AS probability_of_default,
 {_band_label('band')} AS risk_band, {_decision_label('dec')} AS decision, '{Q.MODEL_VERSION}' AS model_version,
 scored_at FROM (SELECT *, {_decision('band')} AS dec FROM
 (SELECT *, {_band('credit_score')} AS band FROM score_log) b) c"""),
    "latest": (["log"], "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY "
               "scored_at DESC NULLS FIRST, score_id DESC) AS rn FROM log) t WHERE rn = 1"),
    "rules": (["mart_summary"], f"""
SELECT customer_id, credit_score, p AS probability_of_default, {_band_label(_band('credit_score'))} AS risk_band,
 {_decision_label(_decision(_band('credit_score')))} AS decision FROM
 (SELECT customer_id, p, {_score('p', False)} AS credit_score FROM (SELECT customer_id,
  CASE WHEN is_default = 1 THEN 0.85e0 WHEN historical_delinquency_rate > 0.3e0 THEN 0.25e0
       WHEN historical_delinquency_rate > 0 THEN 0.08e0 ELSE 0.005e0 END AS p FROM mart_summary) a) b"""),
    "moments": (["dataset"], "SELECT cast(is_default = 1 AS int) AS class, count(*) AS samples, " + ", ".join(
        f"avg({f}) AS m_{f}, var_pop({f}) + 1e-6 AS v_{f}" for f in FEATURES) + " FROM dataset GROUP BY 1"),
    "nb": (["moments"], "SELECT p.samples / (p.samples + n.samples) AS pp, n.samples / (p.samples + n.samples) AS pn, "
           + ", ".join(f"p.m_{f} AS pm_{f}, p.v_{f} AS pv_{f}, n.m_{f} AS nm_{f}, n.v_{f} AS nv_{f}" for f in FEATURES)
           + " FROM moments p JOIN moments n ON p.class = 1 AND n.class = 0"),
    "nb_importance": (["nb"], "SELECT feature, d / sum(d) OVER () AS importance FROM (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, abs(pm_{f} - nm_{f}) / greatest(sqrt((pv_{f} + nv_{f}) / 2), 1e-6) AS d FROM nb"
        for f in FEATURES) + ") t"),
    "normal": (["reqs"], """
SELECT coalesce(customer_id, 9999999) AS customer_id, age_years, employment_years,
 coalesce(is_unemployed_or_retired, CASE WHEN employment_years <= 0 THEN 1.0e0 ELSE 0.0e0 END) AS is_unemployed_or_retired,
 annual_income, coalesce(income_per_family_member, annual_income /
   CASE WHEN family_members_count > 0 THEN family_members_count ELSE 1.0e0 END) AS income_per_family_member,
 children_count, CASE WHEN family_members_count > 0 THEN family_members_count ELSE 1.0e0 END AS family_members_count,
 own_car, own_realty, has_work_phone, has_email, credit_history_length_months, historical_delinquency_rate,
 max_past_due_severity, delinquency_rate_last_6m FROM reqs"""),
    "by_model": (["scored"], "SELECT *, concat('m', customer_id % 3) AS model_name FROM scored"),
    "conf": (["by_model"], _confusion("by_model", 0.2)),
    "conf_all": (["conf"], "SELECT cast(sum(true_positives) AS bigint) AS true_positives, cast(sum(false_positives) AS bigint) "
                 "AS false_positives, cast(sum(true_negatives) AS bigint) AS true_negatives, cast(sum(false_negatives) AS bigint) "
                 "AS false_negatives, cast(sum(total_samples) AS bigint) AS total_samples FROM conf"),
}


def _anchors(source, part):
    """Anchors of the tie groups: upwards from the least score, the first at least eps above the last one.

    Scores are first parted where neighbours are that far apart; within such a run the walk recurses.
    """
    part = part or "0"
    return {
        f"runs_{source}": ([source], f"""
SELECT part, p, sum(gap) OVER (PARTITION BY part ORDER BY p) AS run FROM (
 SELECT part, p, CASE WHEN p - lag(p) OVER (PARTITION BY part ORDER BY p) < {TIE_EPS!r} THEN 0 ELSE 1 END AS gap
 FROM (SELECT DISTINCT {part} AS part, p FROM {source}) v) g"""),
        f"anchors_{source}": ([f"runs_{source}"], f"""
SELECT part, run, min(p) AS anchor FROM runs_{source} GROUP BY ALL UNION ALL
SELECT a.part, a.run, min(r.p) FROM anchors_{source} a JOIN runs_{source} r
 ON r.part = a.part AND r.run = a.run AND r.p - a.anchor >= {TIE_EPS!r} GROUP BY a.part, a.run"""),
    }


def _ranked(source, part):
    over = f"PARTITION BY {part} " if part else ""
    group = f"{part}, anchor" if part else "anchor"
    return (f"SELECT *, rank() OVER ({over}ORDER BY anchor) + (count(*) OVER (PARTITION BY {group}) - 1) / 2.0e0 AS ar "
            f"FROM (SELECT s.*, a.anchor FROM {source} s ASOF JOIN anchors_{source} a ON {part or '0'} = a.part AND s.p >= a.anchor) s")


def _roc(source, part=None):
    head, tail = (f"{part}, ", f" GROUP BY {part}") if part else ("", "")
    return (f"SELECT {head}(sum(ar) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0e0) / "
            f"(count(*) FILTER (y = 1) * cast(count(*) FILTER (y <> 1) AS double)) AS roc_auc FROM ({_ranked(source, part)}) r{tail}")


def _curve(source, part=None):
    over = f"PARTITION BY {part} " if part else ""
    w = f"({over}ORDER BY p DESC, customer_id ROWS UNBOUNDED PRECEDING)"
    return (f"SELECT *, row_number() OVER {w} AS rank, cast(sum(y) OVER {w} AS bigint) AS hits FROM {source}")


def _pr(source, part=None):
    head, tail = (f"{part}, ", f" GROUP BY {part}") if part else ("", "")
    return f"SELECT {head}avg(hits / rank) FILTER (y = 1) AS pr_auc FROM ({_curve(source, part)}) c{tail}"


for _source, _part in (("scored", None), ("close", None), ("by_model", "model_name")):
    CTES.update(_anchors(_source, _part))
CTES["roc_all"] = (["scored", "anchors_scored"], _roc("scored"))
CTES["roc_close"] = (["close", "anchors_close"], _roc("close"))
CTES["pr_all"] = (["scored"], _pr("scored"))
CTES["roc_by"] = (["by_model", "anchors_by_model"], _roc("by_model", "model_name"))
CTES["pr_by"] = (["by_model"], _pr("by_model", "model_name"))


def _rates(digits=6):
    tp, fp, tn, fn, n = ("true_positives", "false_positives", "true_negatives", "false_negatives", "total_samples")
    return (f"round(({tp} + {tn}) / {n}, {digits}) AS accuracy, round({tp} / ({tp} + {fp}), {digits}) AS precision, "
            f"round({tp} / ({tp} + {fn}), {digits}) AS recall, round(({tp} + {fn}) / {n}, {digits}) AS positive_rate, "
            f"round(2 * ({tp} / ({tp} + {fp})) * ({tp} / ({tp} + {fn})) / (({tp} / ({tp} + {fp})) + ({tp} / ({tp} + {fn}))), {digits}) AS f1_score")


def _all(columns, source, digits=6, **renamed):
    return f"SELECT {', '.join(_r(c, digits=digits) for c in columns)} FROM {source}"


def _head(needs):
    """Every common table expression that is needed, in order."""
    order = []

    def visit(name):
        for base in CTES[name][0]:
            visit(base)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    return ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)


def _with(body, *needs):
    """The statement behind the expressions it needs."""
    return f"WITH RECURSIVE {_head(needs)}\n{body}" if needs else body


def _with_recursive(body, *needs):
    """The same for a body that goes on with expressions of its own, a recursive one among them."""
    return f"WITH RECURSIVE {_head(needs)},\n{body}"


_APP_COLUMNS = ("customer_id, gender, own_car, own_realty, children_count, round(total_income, 6) AS total_income, "
                "income_type, education_type, family_status, housing_type, days_birth, days_employed, has_mobile, "
                "has_work_phone, has_phone, has_email, occupation_type, round(family_members_count, 6) AS family_members_count")
_FEATURES = "customer_id, " + ", ".join(_r(f) for f in FEATURES)
_FEATURE_ROW = f"{_FEATURES}, {_r(LABEL)}"
_CARD = ("customer_id, round(p, 6) AS probability_of_default, credit_score, risk_band, "
         f"{_decision('risk_band')} AS decision")
_PAGE = (Q.PAGE - 1) * Q.LIMIT


def _split_stats():
    long = " UNION ALL ".join(
        f"SELECT {i} AS pos, '{f}' AS feature, {f} AS v, {LABEL} AS y FROM dataset"
        for i, f in enumerate(LEAKAGE_FREE_FEATURES))

    def gini(pos, n):
        return f"(1 - (({pos} / {n}) * ({pos} / {n}) + (1 - {pos} / {n}) * (1 - {pos} / {n})))"

    return f"""
SELECT feature, round(v, 6) AS threshold, round(gain, 6) AS gain, cast(ln AS bigint) AS left_rows,
 cast(tn AS bigint) AS node_rows FROM (
 SELECT *, round({gini('tp', 'tn')} - (ln * {gini('lp', 'ln')} + (tn - ln) * {gini('(tp - lp)', '(tn - ln)')}) / tn, 12) AS gain FROM (
  SELECT pos, feature, v, sum(n) OVER u AS ln, sum(s) OVER u AS lp, sum(n) OVER a AS tn, sum(s) OVER a AS tp,
   row_number() OVER (PARTITION BY pos ORDER BY v) - 1 AS k, count(*) OVER a AS l FROM (
   SELECT pos, feature, v, count(*) AS n, sum(y) AS s FROM ({long}) x GROUP BY ALL) y
  WINDOW u AS (PARTITION BY pos ORDER BY v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY pos)) z
 WHERE k % greatest(l // 15, 1) = 0 AND ln < tn) q ORDER BY gain DESC, pos, v LIMIT 1"""


def _violations():
    not_null = {
        "applications": ("mart_apps", [f.name for f in Q.portfolio.MART_APPLICATIONS if not f.nullable]),
        "customer_credit_summary": ("msummary", [f.name for f in Q.portfolio.MART_SUMMARY if not f.nullable]),
        "credit_scores": ("log", [f.name for f in Q.MART_SCORES if not f.nullable]),
    }
    parts = [
        f"SELECT '{t}.{k} is unique' AS rule, count(*) AS violations FROM (SELECT {k} FROM {s} GROUP BY {k} HAVING count(*) > 1) q"
        for t, s, k in [("applications", "mart_apps", "customer_id"),
                        ("customer_credit_summary", "msummary", "customer_id"),
                        ("credit_scores", "log", "score_id")]]
    parts.append("SELECT 'customer_credit_summary.customer_id is in applications', count(*) FROM msummary "
                 "WHERE customer_id NOT IN (SELECT customer_id FROM mart_apps)")
    parts.append("SELECT 'credit_scores.credit_score is in 300..850', count(*) FROM log "
                 "WHERE credit_score NOT BETWEEN 300 AND 850")
    for table, (source, columns) in not_null.items():
        parts += [f"SELECT '{table}.{c} is not null', count(*) FROM {source} WHERE {c} IS NULL" for c in columns]
    sources = {"applications": "mart_apps", "credit_scores": "log"}
    parts += [f"SELECT '{t}.{c} has at most {n} characters', count(*) FROM {sources[t]} WHERE length({c}) > {n}"
              for t in sources for c, n in TEXT_LENGTHS[t].items()]
    return " UNION ALL ".join(parts)


def _bootstrap():
    steps = forest._poisson_steps()
    cases = " ".join(f"WHEN u < {t!r} THEN {k}" for k, t in enumerate(steps[:-1]))
    return f"""SELECT customer_id, CAST(tree AS INTEGER) AS tree, CAST(draws AS INTEGER) AS draws FROM (
    SELECT customer_id, tree, CASE {cases} ELSE {len(steps) - 1} END AS draws FROM (
      SELECT customer_id, t.tree, CAST('0x' || substr(md5(concat_ws(':', '{Q.SEED}', t.tree, customer_id)), 1, 13) AS bigint)
        * {2.0**-52!r} AS u
      FROM dataset, range({forest.TREES}) AS t(tree)) q) q WHERE draws > 0"""


def _logistic(result):
    """Gradient descent as a recursion over the epochs; ``result`` reads the row ``fitted``."""
    k = range(len(FEATURES))
    moments = ", ".join(f"avg({f}) AS m{j}, CASE WHEN stddev_pop({f}) < 1e-7 THEN 1e0 ELSE stddev_pop({f}) END AS s{j}"
                        for j, f in enumerate(FEATURES))
    rows = ", ".join(f"({f} - m{j}) / CASE WHEN s{j} > 1e-8 THEN s{j} ELSE 1e0 END AS x{j}"
                     for j, f in enumerate(FEATURES))
    z = " + ".join(["b", *[f"w{j} * x{j}" for j in k]])
    return f"""lr_moments AS (SELECT {moments} FROM dataset),
    lr_rows AS MATERIALIZED (SELECT cast(is_default = 1 AS int) AS y, {rows} FROM dataset, lr_moments),
    lr_counts AS (SELECT count(*)::double AS n, greatest(sum(y), 1)::double AS n_pos,
      greatest(count(*) - greatest(sum(y), 1), 1)::double AS n_neg FROM lr_rows),
    lr_fit AS (
      SELECT 0 AS epoch, ln(n_pos / n_neg) AS b, {", ".join(f"0e0 AS w{j}" for j in k)} FROM lr_counts
      UNION ALL
      SELECT epoch + 1, b - rate * gb / n, {", ".join(f"w{j} - rate * (g{j} / n + {logistic.L2!r} * w{j})" for j in k)}
      FROM (
        SELECT epoch, b, {", ".join(f"w{j}" for j in k)}, any_value(n) AS n,
          {logistic.LEARNING_RATE!r} / (1e0 + {logistic.DECAY!r} * epoch) AS rate,
          sum(e) AS gb, {", ".join(f"sum(e * x{j}) AS g{j}" for j in k)}
        FROM (
          SELECT *, (CASE WHEN z >= {logistic.LOGIT_LIMIT!r} THEN 1e0 WHEN z <= -{logistic.LOGIT_LIMIT!r} THEN 0e0
            ELSE 1e0 / (1e0 + exp(-z)) END - y) * n / (2e0 * CASE WHEN y = 1 THEN n_pos ELSE n_neg END) AS e
          FROM (SELECT *, {z} AS z FROM lr_fit, lr_rows, lr_counts WHERE epoch < {logistic.EPOCHS}) q) q
        GROUP BY epoch, b, {", ".join(f"w{j}" for j in k)}) q),
    fitted AS (SELECT * FROM lr_fit WHERE epoch = {logistic.EPOCHS})
    {result}""".rstrip()


_LR_WEIGHTS = " UNION ALL ".join(f"SELECT '{f}' AS feature, w{j} AS weight FROM fitted" for j, f in enumerate(FEATURES))
_LR = " + ".join([f"{Q.FIXED_BIAS}e0"] + [
    f"({w}e0) * (({f} - {m}e0) / {s}e0)"
    for w, f, m, s in zip(Q.FIXED_WEIGHTS, FEATURES, Q.FIXED_MEANS, Q.FIXED_DEVIATIONS)])

_PREDICTED = f"SELECT customer_id, {_r('p', 'probability_of_default')} FROM predicted"
_FEATURE_VALUES = " UNION ALL ".join(
    f"SELECT customer_id, {j} AS j, '{f}' AS feature, {f} AS value FROM dataset" for j, f in enumerate(FEATURES))
_FOREST = TS.random_forest(FEATURES, _bootstrap(), Q.SEED)
_MART_APPS = ("customer_id, gender, own_car, own_realty, children_count, round(annual_income, 2) AS annual_income, income_type, "
              "education_type, family_status, housing_type, age_years, employment_years, is_unemployed_or_retired, has_mobile, "
              "has_work_phone, has_phone, has_email, occupation_type, family_members_count, income_per_family_member")

_OWN_NAMES = ("train_values|tree_rows|tree_features|grown|tree_nodes|splits|asked|walk|leaves|predicted|"
              "all_features|prior|boosted")


def _own(prefix, text):
    """The expressions of a model under names of their own."""
    return re.sub(rf"\b({_OWN_NAMES})\b", rf"{prefix}_\1", text)


def _compare():
    """Split, fit four models on the training part, measure them on the rest."""
    held = "SELECT * FROM held_rows"
    z = " + ".join(["b", *[f"w{j} * (({f} - m{j}) / CASE WHEN s{j} > 1e-8 THEN s{j} ELSE 1e0 END)" for j, f in enumerate(FEATURES)]])
    tree = lambda prefix, kind, text: _own(prefix, f"{text}, {TS.predicted(kind, held, 'held_values')}")
    per_model = {
        compare.LOGISTIC: f"SELECT customer_id, {_sigmoid('z')} AS p FROM (SELECT customer_id, {z} AS z FROM held_rows, fitted, lr_moments) q",
        compare.BAYES: f"SELECT customer_id, p FROM ({_bayes_p('held_rows')}) q",
        compare.FOREST: "SELECT customer_id, p FROM rf_predicted",
        compare.BOOSTING: "SELECT customer_id, p FROM gb_predicted",
    }
    scored = " UNION ALL ".join(f"SELECT '{m}' AS model_name, * FROM ({t}) m" for m, t in per_model.items())
    anchors = "".join(f"{n} AS ({text}),\n" for n, (_, text) in _anchors("held_out", "model_name").items())
    whole = _head(["dataset"]).replace("dataset AS (", "whole AS (", 1)
    return f"""WITH RECURSIVE {whole},
    marked AS ({_split('whole')}),
    dataset AS MATERIALIZED (SELECT w.* FROM whole w JOIN marked m USING (customer_id) WHERE is_train),
    held_rows AS MATERIALIZED (SELECT w.* FROM whole w JOIN marked m USING (customer_id) WHERE NOT is_train),
    held_values AS MATERIALIZED ({TS.long_rows(FEATURES, "held_rows")}),
    moments AS ({CTES["moments"][1]}), nb AS ({CTES["nb"][1]}),
    {tree("rf", "forest", _FOREST)},
    {tree("gb", "boosting", TS.boosted(FEATURES))},
    {_logistic("")},
    held_out AS (SELECT s.*, CAST({LABEL} = 1 AS INTEGER) AS y FROM ({scored}) s JOIN held_rows USING (customer_id)),
    {anchors}
    conf AS ({_confusion("held_out", 0.5)}),
    roc_by AS ({_roc("held_out", "model_name")}), pr_by AS ({_pr("held_out", "model_name")})
    SELECT c.*, {_rates()}, {_r('roc_auc')}, {_r('pr_auc')} FROM conf c JOIN roc_by r ON c.model_name = r.model_name
      JOIN pr_by q ON c.model_name = q.model_name"""


ORACLES = {
    "flagship": _with(f"""
SELECT d.customer_id, round(age_years, 4) AS age_years, annual_income, credit_history_length_months,
 {_r('historical_delinquency_rate')}, is_default, credit_score, probability_of_default, risk_band, decision
FROM dataset d JOIN rules r ON d.customer_id = r.customer_id""", "dataset", "rules"),
    "scan_applications": _with(f"SELECT {_APP_COLUMNS} FROM apps_typed", "apps_typed"),
    "scan_credit_records": _with("SELECT * FROM recs", "recs"),
    "scan_requests": _with(f"SELECT {_FEATURES} FROM reqs", "reqs"),
    "insert_if_absent": _with("""
SELECT customer_id, credit_score FROM latest UNION ALL
SELECT customer_id, credit_score FROM (SELECT o_custkey AS customer_id, cast(300 + o_orderkey % 551 AS int) AS credit_score,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) o
WHERE rn = 1 AND customer_id NOT IN (SELECT customer_id FROM latest)""", "latest"),
    "append_scores": _with(f"""
SELECT score_id, customer_id, credit_score, {_r('probability_of_default')}, risk_band, decision, model_version,
 strftime(scored_at, '%Y-%m-%d %H:%M:%S') AS scored_at FROM log UNION ALL
SELECT (SELECT max(score_id) FROM log) + row_number() OVER (ORDER BY customer_id), customer_id, credit_score,
 probability_of_default, risk_band, decision, '{Q.MODEL_VERSION}-append', '{Q.SCORED_AT}' FROM rules""", "log", "rules"),
    "mart_applications": _with(f"SELECT {_MART_APPS} FROM mart_apps", "mart_apps"),
    "parse_number": _with(f"""
SELECT seq, ID AS raw_id, CASE WHEN {INT.format('ID')} THEN try_cast(ID AS bigint) END AS id,
 {_real('AMT_INCOME_TOTAL', '0.0e0')} AS income, {_real('CNT_FAM_MEMBERS', '1.0e0')} AS family,
 {_int('CNT_FAM_MEMBERS', 'int', -1)} AS family_int, {_int('DAYS_EMPLOYED', 'int', 0)} AS days_employed FROM app_raw""", "app_raw"),
    "flags": _with("""
SELECT seq, ID, FLAG_OWN_CAR = 'Y' AS own_car, FLAG_OWN_REALTY = 'Y' AS own_realty, FLAG_MOBIL = '1' AS has_mobile,
 FLAG_WORK_PHONE = '1' AS has_work_phone, FLAG_PHONE = '1' AS has_phone, FLAG_EMAIL = '1' AS has_email FROM app_raw""", "app_raw"),
    "blank_to_null": _with("SELECT seq, ID, CASE WHEN trim(OCCUPATION_TYPE) <> '' THEN OCCUPATION_TYPE END AS occupation_type "
                           "FROM app_raw", "app_raw"),
    "parse_status": _with("SELECT ID, MONTHS_BALANCE, STATUS, CASE WHEN trim(STATUS) IN ('C','X','0','1','2','3','4','5') "
                          "THEN trim(STATUS) ELSE '0' END AS code FROM credit_raw", "credit_raw"),
    "severity": _with(f"""
SELECT customer_id, months_balance, status, cast({SEVERITY.format('status')} AS int) AS severity,
 cast({MART_SEVERITY} AS int) AS mart_severity, {SEVERE} AS is_severe, {LATE} AS is_past_due,
 {MART_LATE} AS mart_past_due FROM recs""", "recs"),
    "demographics": _with(f"""
SELECT customer_id, {_r('-days_birth / 365.25e0', 'age_strict')},
 {_r('CASE WHEN days_employed > 0 THEN 0 ELSE -days_employed / 365.25e0 END', 'employment_strict')},
 CASE WHEN days_employed > 0 THEN 1.0e0 ELSE 0.0e0 END AS idle_strict,
 CASE WHEN family_members_count > 0 THEN family_members_count ELSE 1.0e0 END AS family_strict,
 {_r('total_income / CASE WHEN family_members_count > 0 THEN family_members_count ELSE 1 END', 'share_strict')},
 round_even(-days_birth / 365.25e0, 2) AS age_mart,
 CASE WHEN days_employed > 0 THEN 0.0e0 ELSE round_even(-days_employed / 365.25e0, 2) END AS employment_mart,
 CASE WHEN days_employed > 0 THEN 1.0e0 ELSE 0.0e0 END AS idle_mart,
 greatest(family_members_count, 1.0e0) AS family_mart,
 round_even(total_income / greatest(family_members_count, 1.0e0), 2) AS share_mart FROM apps""", "apps"),
    "sigmoid": f"SELECT event_id, {_r(_sigmoid('((value - 50.0e0) * 2.0e0)'), 'p')} FROM events",
    "normalize_requests": _with(f"SELECT {_FEATURES} FROM normal", "normal"),
    "recent_rate": _with(f"SELECT customer_id, count(*) FILTER (months_balance >= -5) AS recent_rows, "
                         f"{_r(_rate(LATE), 'recent_rate')} FROM recs GROUP BY customer_id", "recs"),
    "search_customers": _with("SELECT customer_id, annual_income FROM dataset WHERE contains(cast(customer_id AS varchar), '17')", "dataset"),
    "get_customer": _with(f"SELECT {_CARD} FROM ({_scored('dataset')}) s WHERE customer_id = {Q.SAMPLE_CUSTOMER}", "dataset", "nb"),
    "hard_predict": _with("SELECT customer_id, CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS prediction, "
                          "CASE WHEN p >= 0.2e0 THEN 1 ELSE 0 END AS prediction_low FROM scored", "scored"),
    "build_dataset": _with(f"SELECT {_FEATURE_ROW} FROM dataset", "dataset"),
    "semi_join_apps": _with("SELECT customer_id, gender, own_car FROM apps WHERE customer_id IN (SELECT customer_id FROM recs)", "apps", "recs"),
    "left_default": _with(f"SELECT {_FEATURE_ROW} FROM all_features", "all_features"),
    "latest_score": _with("SELECT a.customer_id, a.gender, l.credit_score, round(l.probability_of_default, 6) AS probability_of_default, "
                          "l.risk_band, l.decision FROM apps a LEFT JOIN latest l ON a.customer_id = l.customer_id", "apps", "latest"),
    "scored_portfolio": _with("SELECT l.score_id, l.customer_id, round(a.annual_income, 2) AS annual_income, s.is_default, l.credit_score FROM log l "
                              "JOIN mart_apps a ON a.customer_id = l.customer_id JOIN mart_summary s ON s.customer_id = l.customer_id",
                              "log", "mart_apps", "mart_summary"),
    "portfolio_kpis": _with("""
SELECT l.risk_band, l.decision, count(*) AS total_customers, round(avg(cast(annual_income AS double)), 2) AS avg_annual_income,
 round(avg(cast(age_years AS double)), 1) AS avg_age,
 round(avg(cast(historical_delinquency_rate AS double)) * 100, 2) AS avg_delinquency_rate_pct,
 round(avg(l.credit_score), 0) AS avg_credit_score, round(avg(is_default) * 100, 2) AS empirical_default_rate_pct
FROM log l JOIN mart_apps a ON a.customer_id = l.customer_id JOIN mart_summary s ON s.customer_id = l.customer_id
GROUP BY l.risk_band, l.decision""", "log", "mart_apps", "mart_summary"),
    "credit_summary": _with(f"""
SELECT customer_id, total_months_observed, min_month_balance, max_month_balance, severe_delinquency_count,
 any_delinquency_count, is_bad_customer, {_r('delinquency_rate')}, {_r('max_severity')},
 {_r('recent_delinquency_rate_6m')}, months_since_last_delinquency FROM summary""", "summary"),
    "mart_summary": _with("SELECT * FROM mart_summary", "mart_summary"),
    "target_stats": _with("SELECT count(*) FILTER (is_default = 1) AS bad_count, count(*) AS total_count, "
                          "round(count(*) FILTER (is_default = 1) / count(*) * 100, 6) AS default_rate_pct FROM dataset", "dataset"),
    "feature_means": _with("SELECT " + ", ".join(_r(f"avg({f})", f, 4) for f in FEATURES) + " FROM dataset", "dataset"),
    "zscore_fit": _with("SELECT " + ", ".join(
        f"{_r(f'avg({f})', f'mean_{f}', 4)}, {_r(f'CASE WHEN stddev_pop({f}) < 1e-7 THEN 1 ELSE stddev_pop({f}) END', f'sd_{f}', 4)}"
        for f in FEATURES) + " FROM dataset", "dataset"),
    "nb_fit": _with("SELECT class, samples, " + ", ".join(
        f"{_r(f'm_{f}', f'mean_{f}', 4)}, {_r(f'sqrt(v_{f})', f'sd_{f}', 4)}" for f in FEATURES) + " FROM moments", "moments"),
    "class_weights": _with(f"""
SELECT samples, n_pos, n_neg, {_r('samples / (2.0e0 * n_pos)', 'w_pos')}, {_r('samples / (2.0e0 * n_neg)', 'w_neg')} FROM (
 SELECT samples, n_pos, greatest(samples - n_pos, 1) AS n_neg FROM (SELECT count(*) AS samples,
 greatest(count(*) FILTER (is_default = 1), 1) AS n_pos FROM dataset) a) b""", "dataset"),
    "confusion": _with("SELECT * FROM conf_all", "conf_all"),
    "service_summary": _with(f"SELECT 'ok' AS status, count(*) AS total_customers, '{ACTIVE_MODEL}' AS active_model FROM dataset", "dataset"),
    "dedupe_keep_last": _with(f"SELECT {_APP_COLUMNS} FROM apps", "apps"),
    "score_rank": _with("SELECT customer_id, row_number() OVER (ORDER BY p, customer_id) AS rank FROM scored", "scored"),
    "tie_average_rank": _with(f"SELECT round(p, 9) AS p, count(*) AS n, any_value(ar) AS average_rank FROM ({_ranked('close', None)}) r "
                              "GROUP BY r.p", "close", "anchors_close"),
    "cumulative_pr": _with(f"SELECT customer_id, rank, hits, {_r('hits / rank', 'precision_at_row')} FROM ({_curve('scored')}) c", "scored"),
    "roc_auc": _with(f"SELECT {_r('roc_auc')} FROM roc_close", "roc_close"),
    "pr_auc": _with(f"SELECT {_r('pr_auc')} FROM pr_all", "pr_all"),
    "stratified_split": _with(_split("dataset"), "dataset"),
    "list_customers": _with(f"""
SELECT customer_id, round(age_years, 6) AS age, round(annual_income, 6) AS annual_income,
 {_r('historical_delinquency_rate', 'delinquency_rate')}, credit_score, {_band_label('risk_band')} AS risk_band,
 {_decision_label(_decision('risk_band'))} AS decision FROM ({_scored('dataset')}) s
WHERE contains(cast(customer_id AS varchar), '17') ORDER BY customer_id LIMIT {Q.LIMIT} OFFSET {_PAGE}""", "dataset", "nb"),
    "list_recent": _with(f"SELECT {_FEATURE_ROW} FROM dataset ORDER BY customer_id LIMIT 25 OFFSET 100", "dataset"),
    "total_count": _with("SELECT count(*) AS total FROM dataset WHERE contains(cast(customer_id AS varchar), '17')", "dataset"),
    "best_split": _with(_split_stats(), "dataset"),
    "zscore": _with("SELECT customer_id, " + ", ".join(
        _r(f"({f} - avg({f}) OVER ()) / CASE WHEN stddev_pop({f}) OVER () < 1e-7 THEN 1 ELSE stddev_pop({f}) OVER () END", f)
        for f in FEATURES) + " FROM dataset", "dataset"),
    "lr_predict": _with(f"SELECT customer_id, {_r(_sigmoid('z'), 'probability_of_default')} FROM (SELECT customer_id, {_LR} AS z FROM dataset) t", "dataset"),
    "nb_predict": _with(f"SELECT customer_id, {_r('p', 'probability_of_default')} FROM ({_bayes_p('dataset')}) b", "dataset", "nb"),
    "nb_importance": _with(f"SELECT feature, {_r('importance')} FROM nb_importance", "nb_importance"),
    "classification_metrics": _with(f"SELECT *, {_rates()} FROM conf_all", "conf_all"),
    "evaluate": _with(f"SELECT 'proxy' AS model_name, c.*, {_rates()}, (SELECT {_r('roc_auc')} FROM roc_all) AS roc_auc, "
                      f"(SELECT {_r('pr_auc')} FROM pr_all) AS pr_auc FROM conf_all c", "conf_all", "roc_all", "pr_all"),
    "auc_by_model": _with(f"SELECT r.model_name, {_r('roc_auc')}, {_r('pr_auc')} FROM roc_by r JOIN pr_by q ON r.model_name = q.model_name",
                          "roc_by", "pr_by"),
    "evaluate_by_model": _with(f"SELECT c.*, {_rates()}, {_r('roc_auc')}, {_r('pr_auc')} FROM conf c JOIN roc_by r ON c.model_name = r.model_name "
                               "JOIN pr_by q ON c.model_name = q.model_name", "conf", "roc_by", "pr_by"),
    "model_info": _with(f"SELECT c.*, {_rates()}, {_r('roc_auc')}, {_r('pr_auc')}, '{ACTIVE_MODEL}' AS active_model, "
                        f"'{','.join(FEATURES)}' AS feature_names FROM conf c JOIN roc_by r ON c.model_name = r.model_name "
                        "JOIN pr_by q ON c.model_name = q.model_name", "conf", "roc_by", "pr_by"),
    "feature_array": _with(" UNION ALL ".join(
        f"SELECT customer_id, {i} AS position, round({f}, 6) AS value FROM dataset" for i, f in enumerate(FEATURES)), "dataset"),
    "gb_importance": _with(" UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(1.0e0 / {len(FEATURES)}, 6) AS importance FROM (SELECT count(*) FROM dataset) t"
        for f in FEATURES), "dataset"),
    "pdo_score": _with(f"SELECT customer_id, {_score('p')} AS credit_score FROM scored", "scored"),
    "risk_band": _with(f"SELECT score_id, credit_score, {_band('credit_score')} AS band, {_band_label(_band('credit_score'))} AS band_label, "
                       f"{_decision(_band('credit_score'))} AS decision, {_decision_label(_decision(_band('credit_score')))} AS decision_label "
                       "FROM score_log", "score_log"),
    "score_customers": _with(f"SELECT {_CARD} FROM ({_scored('dataset')}) s", "dataset", "nb"),
    "factor_impacts": _with(_factors(), "dataset", "nb_importance"),
    "top_factors": _with(f"SELECT * FROM ({_factors()}) f WHERE position < 5", "dataset", "nb_importance"),
    "rule_scores": _with("SELECT * FROM rules", "rules"),
    "score_requests": _with(f"SELECT {_CARD} FROM ({_scored('normal')}) s", "normal", "nb"),
    "score_stream": _with(f"SELECT {_CARD} FROM ({_scored('normal')}) s", "normal", "nb"),
    "mart_bureau": _with(f"SELECT customer_id, months_balance, status AS status_code, cast({SEVERITY.format('status')} AS int) AS severity_level, "
                         f"{LATE} AS is_past_due, {SEVERE} AS is_severe_delinquency FROM recs", "recs"),
    "customer_risk_profile": _with("""
SELECT a.customer_id, gender, age_years, employment_years, round(annual_income, 2) AS annual_income, income_per_family_member,
 income_type, education_type, housing_type, family_status, own_car, own_realty, total_months_observed,
 historical_delinquency_rate, s.max_past_due_severity, delinquency_rate_last_6m, is_default, l.credit_score,
 l.probability_of_default, l.risk_band, l.decision
FROM mart_apps a JOIN mart_summary s ON a.customer_id = s.customer_id LEFT JOIN latest l ON l.customer_id = a.customer_id""",
                                   "mart_apps", "mart_summary", "latest"),
    "bootstrap": _with(_bootstrap(), "dataset"),
    "lr_fit": _with_recursive(_logistic(
        f"SELECT feature, {_r('weight')} FROM (SELECT 'bias' AS feature, b AS weight FROM fitted UNION ALL {_LR_WEIGHTS}) q"), "dataset"),
    "lr_importance": _with_recursive(_logistic(
        f"SELECT feature, {_r('abs(weight) / sum(abs(weight)) OVER ()', 'importance')} FROM ({_LR_WEIGHTS}) q"), "dataset"),
    "dt_fit": _with_recursive(f"{TS.single_tree(LEAKAGE_FREE_FEATURES)} {TS.node_table(LEAKAGE_FREE_FEATURES)}", "dataset"),
    "dt_predict": _with_recursive(f"{TS.single_tree(LEAKAGE_FREE_FEATURES)}, {TS.predicted('tree')} {_PREDICTED}", "dataset"),
    "feature_subsets": _with(f"""
SELECT CAST(tree AS INTEGER) AS tree, CAST(s.position AS INTEGER) AS position, f.feature, CAST(sum(draws) AS BIGINT) AS draws,
 round(sum(draws * value) / sum(draws), 4) AS mean
FROM ({TS.subsets(len(FEATURES), forest.TREES, Q.SEED)}) s JOIN ({_bootstrap()}) b USING (tree) JOIN ({_FEATURE_VALUES}) f
 ON f.customer_id = b.customer_id AND f.j = s.feature GROUP BY ALL""", "dataset"),
    "rf_fit": _with_recursive(f"{_FOREST} {TS.node_table(FEATURES)}", "dataset"),
    "rf_predict": _with_recursive(f"{_FOREST}, {TS.predicted('forest')} {_PREDICTED}", "dataset"),
    "rf_importance": _with_recursive(f"{_FOREST} {TS.importance(FEATURES)}", "dataset"),
    "gb_fit": _with_recursive(f"{TS.boosted(FEATURES)} {TS.node_table(FEATURES)}", "dataset"),
    "gb_predict": _with_recursive(f"{TS.boosted(FEATURES)}, {TS.predicted('boosting')} {_PREDICTED}", "dataset"),
    "compare_models": _compare(),
    "check_constraints": _with(_violations(), "mart_apps", "msummary", "log"),
}
