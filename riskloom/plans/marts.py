"""Reporting marts, the latest-score join, portfolio views and constraint checks."""

from pyspark.sql import functions as F

from riskloom.functions import demographics as D, status as S
from riskloom.operators.features import with_history
from riskloom.operators.history import summarize_history
from riskloom.schemas import (
    MART_APPLICATIONS, MART_BUREAU, MART_SCORES, MART_SUMMARY, TEXT_LENGTHS)
from riskloom.sources.tables import in_order, typed

PROFILE_APPLICATION = [
    "customer_id", "gender", "age_years", "employment_years", "annual_income",
    "income_per_family_member", "income_type", "education_type", "housing_type", "family_status",
    "own_car", "own_realty",
]
PROFILE_SUMMARY = [
    "total_months_observed", "historical_delinquency_rate", "max_past_due_severity",
    "delinquency_rate_last_6m", "is_default",
]
PROFILE_SCORE = ["credit_score", "probability_of_default", "risk_band", "decision"]


def mart_applications(apps, records):
    """Typed applications of the customers in the bureau; ``apps`` holds one row per customer."""
    years, idle = D.employment(F.col("days_employed"), "mart")
    family = D.family_members(F.col("family_members_count"), "mart")
    income = F.col("total_income")
    derived = with_history(apps, records).select(
        "customer_id", "gender", "own_car", "own_realty", "children_count",
        income.alias("annual_income"), "income_type", "education_type", "family_status",
        "housing_type",
        D.age_years(F.col("days_birth"), "mart").alias("age_years"),
        years.alias("employment_years"),
        (idle == 1).alias("is_unemployed_or_retired"),
        "has_mobile", "has_work_phone", "has_phone", "has_email", "occupation_type",
        family.alias("family_members_count"),
        D.income_per_member(income, family, "mart").alias("income_per_family_member"),
    )
    return typed(derived, MART_APPLICATIONS)


def mart_credit_summary(apps, records):
    """The report summary of the customers that have an application."""
    summary = summarize_history(records, "mart")
    return typed(summary.join(apps.select("customer_id"), "customer_id", "left_semi"), MART_SUMMARY)


def bureau_months(records):
    """Every bureau month with its severity, without an id."""
    code = F.col("status")
    return records.select(
        "customer_id", "months_balance",
        code.alias("status_code"),
        S.severity(code).alias("severity_level"),
        S.is_past_due(code).alias("is_past_due"),
        S.is_severe(code).alias("is_severe_delinquency"),
    )


def mart_bureau_records(records, start=0):
    """Every bureau month with its severity; record ids go on from ``start`` in the order of the
    records, without a sort: the same files read in the same splits always get the same ids."""
    return typed(in_order(bureau_months(records), "record_id", start)[0], MART_BUREAU)


def newest_scores(log, columns=PROFILE_SCORE):
    """Per customer the row latest by time. A missing time counts as latest, ids break ties."""
    recency = F.struct(F.col("scored_at").isNull(), F.col("scored_at"), F.col("score_id"))
    return (
        log.groupBy("customer_id").agg(F.max_by(F.struct(*columns), recency).alias("latest"))
        .select("customer_id", "latest.*")
    )


def latest_score(apps, log, columns=PROFILE_SCORE):
    """Applications with their latest score, NULL where none exists.

    The log is reduced to one row per customer before the join, however often one was scored.
    """
    return apps.join(newest_scores(log, columns), "customer_id", "left")


def customer_risk_profile(apps, summary, log):
    known = apps.select(PROFILE_APPLICATION).join(
        summary.select("customer_id", *PROFILE_SUMMARY), "customer_id")
    return latest_score(known, log).select(PROFILE_APPLICATION + PROFILE_SUMMARY + PROFILE_SCORE)


def scored_portfolio(apps, summary, log):
    """One row per log entry of a known customer.

    The two sides with one row per customer meet first, so the log takes part in a single join,
    whose hot partitions adaptive execution can split.
    """
    return log.join(apps.join(summary, "customer_id"), "customer_id")


def portfolio_kpis(apps, summary, log):
    """Per (band, decision) over all log rows: count and averages.

    The log is first counted per (customer, band, decision), so a customer with a third of the
    log reaches the join as a single weighted row; averages are weighted sums of exact decimals.
    """
    weighted = log.groupBy("customer_id", "risk_band", "decision").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("credit_score").alias("_score"))
    facts = apps.select("customer_id", "annual_income", "age_years").join(
        summary.select("customer_id", "historical_delinquency_rate", "is_default"), "customer_id")
    joined = weighted.join(facts, "customer_id")
    n = F.sum("_n")

    def mean(column):
        return F.sum(F.col(column) * F.col("_n")).cast("double") / n

    return joined.groupBy("risk_band", "decision").agg(
        n.alias("total_customers"),
        F.round(mean("annual_income"), 2).alias("avg_annual_income"),
        F.round(mean("age_years"), 1).alias("avg_age"),
        F.round(mean("historical_delinquency_rate") * 100, 2).alias("avg_delinquency_rate_pct"),
        F.round(F.sum("_score") / n, 0).alias("avg_credit_score"),
        F.round(mean("is_default") * 100, 2).alias("empirical_default_rate_pct"),
    ).orderBy(F.desc("avg_credit_score"))


def create_views(apps, summary, log):
    """The two reporting views, by name."""
    customer_risk_profile(apps, summary, log).createOrReplaceTempView("v_customer_risk_profile")
    portfolio_kpis(apps, summary, log).createOrReplaceTempView("v_portfolio_risk_kpis")


def _flags(name, df, schema):
    """{rule: condition that a row breaks it} for the columns that ``df`` has."""
    rules = {f"{name}.{f.name} is not null": F.col(f.name).isNull()
             for f in schema.fields if not f.nullable and f.name in df.columns}
    rules.update({f"{name}.{c} has at most {n} characters": F.length(c) > n
                  for c, n in TEXT_LENGTHS.get(name, {}).items() if c in df.columns})
    return rules


def _by_key(df, key, rules, prefix):
    """One row per key: its rows and how many of them break each rule, from a single scan."""
    return df.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias(f"{prefix}n"),
        *[F.count(F.when(broken, 1)).alias(f"{prefix}{i}") for i, broken in enumerate(rules.values())])


def _totals(keyed, sums):
    """(rule, violations) of a table of keys, all in one aggregation."""
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"v{i}").alias("violations"))
                      for i, rule in enumerate(sums)])
    return keyed.agg(*[F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(f"v{i}")
                       for i, column in enumerate(sums.values())]).select(F.inline(pairs))


def _sums(name, key, rules, prefix):
    """What to add up over the keys for each rule of a table."""
    return {f"{name}.{key} is unique": (F.col(f"{prefix}n") > 1).cast("int"),
            **{rule: F.col(f"{prefix}{i}") for i, rule in enumerate(rules)}}


def check_constraints(apps, summary, scores, bureau=None):
    """(rule, violations): keys that repeat, orphans, missing values, long texts, scores out of
    range; with ``bureau`` its keys and values too.

    Every table is read once: its rows are counted by key together with the rules they break. The
    two tables with a row per customer then meet on that key, already dealt by it.
    """
    app_rules = _flags("applications", apps, MART_APPLICATIONS)
    sum_rules = _flags("customer_credit_summary", summary, MART_SUMMARY)
    customers = _by_key(apps, "customer_id", app_rules, "a").join(
        _by_key(summary, "customer_id", sum_rules, "s"), "key", "full")
    found = _totals(customers, {
        **_sums("applications", "customer_id", app_rules, "a"),
        **_sums("customer_credit_summary", "customer_id", sum_rules, "s"),
        "customer_credit_summary.customer_id is in applications": F.when(F.col("an").isNull(), F.col("sn"))})
    score_rules = {**_flags("credit_scores", scores, MART_SCORES),
                   "credit_scores.credit_score is in 300..850": ~F.col("credit_score").between(300, 850)}
    logs = [("credit_scores", scores, "score_id", score_rules)]
    if bureau is not None:
        logs.append(("credit_bureau_records", bureau, "record_id", _flags("credit_bureau_records", bureau, MART_BUREAU)))
    for name, df, key, rules in logs:
        found = found.unionByName(_totals(_by_key(df, key, rules, "r"), _sums(name, key, rules, "r")))
    return found
