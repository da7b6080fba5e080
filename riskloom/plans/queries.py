"""One registered query per operator, over the whole given tables."""

from pyspark.sql import functions as F, types as T

from riskloom.functions import demographics as D, parsing as P, scorecard as C, status as S
from riskloom.functions.probability import hard_predict, stable_sigmoid
from riskloom.models import boosting, compare, forest, logistic, naive_bayes, splits, trees
from riskloom.operators import aggregates as A, explain, features as J, history as H, metrics as M
from riskloom.operators import paging, ranking as R, scoring, split, ties
from riskloom.plans import marts, portfolio, proxies as X
from riskloom.schemas import (
    APPLICATION_COLUMNS, CREDIT_COLUMNS, FEATURES, LABEL, LEAKAGE_FREE_FEATURES, MART_SCORES)
from riskloom.session import scratch_path
from riskloom.sources import csv, requests, tables
from riskloom.streaming import scoring as streaming

SEED = 42
SCORED_AT = "2024-06-30 12:00:00"
MODEL_VERSION = "rules-v1"
SAMPLE_CUSTOMER = 77
SEARCH, PAGE, LIMIT = " 017 ", 2, 15
# Rows per rank bucket here: few, so that small tables take the way of large ones too.
BUCKET = 2_500

# A fixed logistic model, so that prediction alone can be compared.
FIXED_WEIGHTS = [round((j - 7) / 10, 1) for j in range(len(FEATURES))]
FIXED_BIAS = -0.5
FIXED_MEANS = [40.0, 10.0, 0.2, 150000.0, 60000.0, 1.5, 3.0, 0.3, 0.3, 0.5, 0.1, 10.0, 0.3, 2.0, 0.2]
FIXED_DEVIATIONS = [15.0, 9.0, 0.4, 80000.0, 50000.0, 1.1, 1.4, 0.5, 0.5, 0.5, 0.3, 3.0, 0.2, 1.5, 0.3]


# --- inputs -----------------------------------------------------------------------------------

def _apps_typed(spark, sf):
    return csv.type_applications(X.application_raw(spark, sf))


def _apps(spark, sf):
    return H.dedupe_keep_last(_apps_typed(spark, sf), order="seq")


def _records(spark, sf):
    return csv.type_credit_records(X.credit_raw(spark, sf))


def _summary(spark, sf):
    return H.summarize_history(_records(spark, sf))


def _dataset(spark, sf):
    return J.build_dataset(_apps(spark, sf), _summary(spark, sf))


def _log(spark, sf):
    """The score log with bands, decisions and the column types of the mart."""
    log = scoring.with_labels(X.score_log(spark, sf)).withColumn("model_version", F.lit(MODEL_VERSION))
    return tables.typed(log, MART_SCORES)


def _bayes(spark, sf):
    data = _dataset(spark, sf)
    return data, naive_bayes.fit_naive_bayes(data)


def _means(model):
    """Portfolio means from the class means of the fit: the input is not read again."""
    return model.feature_means()


# --- output helpers ---------------------------------------------------------------------------

def _rounded(df, digits=6):
    """Doubles and decimals as doubles rounded alike in both engines."""
    return df.select(*[
        F.round(F.col(f.name).cast("double"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def _score_columns(df):
    return df.select("customer_id", F.round("probability_of_default", 6).alias("probability_of_default"),
                     "credit_score", "risk_band", "decision")


def _exploded_factors(df, column="factor_contributions"):
    return df.select("customer_id", F.posexplode(column).alias("position", "f")).select(
        "customer_id", "position", "f.feature_name", "f.display_name",
        F.round("f.feature_value", 6).alias("feature_value"), "f.impact_direction",
        F.round("f.relative_importance", 6).alias("relative_importance"), "f.description")


def _importance_table(spark, model):
    rows = [(n, float(v)) for n, v in zip(model.features, model.importances())]
    return _rounded(spark.createDataFrame(rows, "feature string, importance double"))


# --- sources and sinks ------------------------------------------------------------------------

def _add_lines(spark, path, lines):
    """A further text file in the folder."""
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(path)


def scan_applications(spark, sf):
    """With line breaks inside quotes, a short row and one without an id in the files."""
    path = scratch_path(spark, "applications")
    job = F.when(F.col("ID").try_cast("bigint") % 3 == 0, F.replace(
        F.col("OCCUPATION_TYPE"), F.lit(" "), F.lit("\n"))).otherwise(F.col("OCCUPATION_TYPE"))
    X.application_raw(spark, sf).select(APPLICATION_COLUMNS).withColumn("OCCUPATION_TYPE", job).write.option(
        "header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    _add_lines(spark, path, [",".join(APPLICATION_COLUMNS), "4,M,Y", "x" + "," * (len(APPLICATION_COLUMNS) - 1)])
    read = csv.read_applications(spark, path).drop("file_order")
    return _rounded(read.withColumn(
        "occupation_type", F.replace(F.col("occupation_type"), F.lit("\n"), F.lit(" "))))


def scan_credit_records(spark, sf):
    path = scratch_path(spark, "credit")
    X.credit_raw(spark, sf).select(CREDIT_COLUMNS).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return csv.read_credit_records(spark, path)


def _request_files(spark, sf):
    """Requests, among them a malformed one and one without its required numbers."""
    path = scratch_path(spark, "requests")
    X.score_requests(spark, sf).write.json(path)
    _add_lines(spark, path, ['{"age_years": 41', '{"customer_id": 3, "age_years": 30.0}'])
    return path


def scan_requests(spark, sf):
    return _rounded(requests.read_score_requests(spark, _request_files(spark, sf), "skip"))


def insert_if_absent(spark, sf):
    target = marts.newest_scores(_log(spark, sf), ["credit_score"])
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias("customer_id"),
        (F.lit(300) + F.col("o_orderkey") % 551).cast("int").alias("credit_score"), "o_orderkey")
    return tables.insert_if_absent(target, orders, order="o_orderkey")


def append_scores(spark, sf):
    new = scoring.rule_scores(H.summarize_history(_records(spark, sf), "mart"))
    log = tables.append_scores(_log(spark, sf), new, MODEL_VERSION + "-append", SCORED_AT)
    return _rounded(log.withColumn("scored_at", F.date_format("scored_at", "yyyy-MM-dd HH:mm:ss")))


# --- cleaning and scalar columns --------------------------------------------------------------

def parse_number(spark, sf):
    raw = X.application_raw(spark, sf)
    return raw.select(
        "seq", F.col("ID").alias("raw_id"),
        P.parse_number(F.col("ID"), "bigint").alias("id"),
        P.parse_number(F.col("AMT_INCOME_TOTAL"), "double", 0.0).alias("income"),
        P.parse_number(F.col("CNT_FAM_MEMBERS"), "double", 1.0).alias("family"),
        P.parse_number(F.col("CNT_FAM_MEMBERS"), "int", -1).alias("family_int"),
        P.parse_number(F.col("DAYS_EMPLOYED"), "int", 0).alias("days_employed"))


def flags(spark, sf):
    raw = X.application_raw(spark, sf)
    return raw.select(
        "seq", "ID", P.flag(F.col("FLAG_OWN_CAR"), "Y").alias("own_car"),
        P.flag(F.col("FLAG_OWN_REALTY"), "Y").alias("own_realty"),
        P.flag(F.col("FLAG_MOBIL"), "1").alias("has_mobile"),
        P.flag(F.col("FLAG_WORK_PHONE"), "1").alias("has_work_phone"),
        P.flag(F.col("FLAG_PHONE"), "1").alias("has_phone"),
        P.flag(F.col("FLAG_EMAIL"), "1").alias("has_email"))


def blank_to_null(spark, sf):
    return X.application_raw(spark, sf).select(
        "seq", "ID", P.blank_to_null(F.col("OCCUPATION_TYPE")).alias("occupation_type"))


def parse_status(spark, sf):
    return X.credit_raw(spark, sf).select(
        "ID", "MONTHS_BALANCE", "STATUS", S.parse_status(F.col("STATUS")).alias("code"))


def severity(spark, sf):
    return _records(spark, sf).select(
        "customer_id", "months_balance", "status",
        S.severity(F.col("status")).alias("severity"),
        S.severity(F.col("status_raw"), "mart").alias("mart_severity"),
        S.is_severe(F.col("status")).alias("is_severe"),
        S.is_past_due(F.col("status")).alias("is_past_due"),
        S.is_past_due(F.col("status_raw"), "mart").alias("mart_past_due"))


def demographics(spark, sf):
    columns = ["customer_id"]
    for v in ("strict", "mart"):
        years, idle = D.employment(F.col("days_employed"), v)
        family = D.family_members(F.col("family_members_count"), v)
        columns += [
            D.age_years(F.col("days_birth"), v).alias(f"age_{v}"), years.alias(f"employment_{v}"),
            idle.alias(f"idle_{v}"), family.alias(f"family_{v}"),
            D.income_per_member(F.col("total_income"), family, v).alias(f"share_{v}")]
    return _rounded(_apps(spark, sf).select(*columns))


def sigmoid(spark, sf):
    z = (F.col("value") - 50.0) * 2.0
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", F.round(stable_sigmoid(z), 6).alias("p"))


def normalize_requests(spark, sf):
    return _rounded(requests.normalize_requests(X.score_requests(spark, sf)))


# --- filters and projections ------------------------------------------------------------------

def recent_rate(spark, sf):
    late = S.is_past_due(F.col("status"))
    return _rounded(_records(spark, sf).groupBy("customer_id").agg(
        F.count(F.when(S.is_recent(F.col("months_balance")), 1)).alias("recent_rows"),
        H.recent_rate(F.col("months_balance"), late).alias("recent_rate")))


def search_customers(spark, sf):
    return _rounded(paging.search_customers(_dataset(spark, sf), SEARCH).select("customer_id", "annual_income"))


def get_customer(spark, sf):
    data, model = _bayes(spark, sf)
    return _score_columns(scoring.customer_scorecard(data, SAMPLE_CUSTOMER, model, _means(model)))


def feature_array(spark, sf):
    vectors = _dataset(spark, sf).select("customer_id", J.feature_array().alias("features"))
    return _rounded(vectors.select("customer_id", F.posexplode("features").alias("position", "value")))


def hard_predictions(spark, sf):
    return X.scored(spark, sf).select(
        "customer_id", hard_predict(F.col("p"), 0.5).alias("prediction"),
        hard_predict(F.col("p"), 0.2).alias("prediction_low"))


# --- joins ------------------------------------------------------------------------------------

def build_dataset(spark, sf):
    return _rounded(_dataset(spark, sf))


def semi_join_apps(spark, sf):
    return J.with_history(_apps(spark, sf), _records(spark, sf)).select("customer_id", "gender", "own_car")


def left_default(spark, sf):
    return _rounded(J.build_features(_apps(spark, sf), _summary(spark, sf)))


def latest_score(spark, sf):
    apps = _apps(spark, sf).select("customer_id", "gender")
    return _rounded(marts.latest_score(apps, _log(spark, sf)))


def scored_portfolio(spark, sf):
    apps, records = _apps(spark, sf), _records(spark, sf)
    joined = marts.scored_portfolio(
        marts.mart_applications(apps, records), marts.mart_credit_summary(apps, records), _log(spark, sf))
    return _rounded(joined.select("score_id", "customer_id", "annual_income", "is_default", "credit_score"))


# --- aggregations -----------------------------------------------------------------------------

def credit_summary(spark, sf):
    return _rounded(_summary(spark, sf))


def mart_summary(spark, sf):
    return _rounded(marts.mart_credit_summary(_apps(spark, sf), _records(spark, sf)))


def target_stats(spark, sf):
    return _rounded(A.target_stats(_dataset(spark, sf)))


def feature_means(spark, sf):
    return _rounded(A.feature_means(_dataset(spark, sf)), 4)


def zscore_fit(spark, sf):
    return _rounded(A.feature_moments(_dataset(spark, sf)), 4)


def nb_fit(spark, sf):
    moments = A.class_moments(_dataset(spark, sf))
    return _rounded(moments.select(
        "class", "samples", *[F.col(f"mean_{f}") for f in FEATURES],
        *[F.sqrt(f"var_{f}").alias(f"sd_{f}") for f in FEATURES]), 4)


def class_weights(spark, sf):
    return _rounded(A.class_weights(_dataset(spark, sf)))


def portfolio_kpis(spark, sf):
    apps, records = _apps(spark, sf), _records(spark, sf)
    return marts.portfolio_kpis(
        marts.mart_applications(apps, records), marts.mart_credit_summary(apps, records), _log(spark, sf))


def confusion(spark, sf):
    return M.confusion(X.scored(spark, sf), threshold=0.2)


def service_summary(spark, sf):
    return A.service_summary(_dataset(spark, sf), scoring.ACTIVE_MODEL)


# --- ranking, splits, pages -------------------------------------------------------------------

def dedupe_keep_last(spark, sf):
    return _rounded(_apps(spark, sf))


def score_rank(spark, sf):
    return R.distributed_rank(X.scored(spark, sf), "p", "customer_id", rows_per_bucket=BUCKET).select("customer_id", "rank")


def tie_average_rank(spark, sf):
    return _rounded(ties.tie_average_rank(X.close(spark, sf), rows_per_bucket=BUCKET), 9)


def cumulative_pr(spark, sf):
    return _rounded(M.cumulative_pr(X.scored(spark, sf), rows_per_bucket=BUCKET).select(
        "customer_id", "rank", "hits", "precision_at_row"))


def roc_auc(spark, sf):
    return _rounded(M.roc_auc(X.close(spark, sf), rows_per_bucket=BUCKET))


def pr_auc(spark, sf):
    return _rounded(M.pr_auc(X.scored(spark, sf), rows_per_bucket=BUCKET))


def stratified_split(spark, sf):
    return split.stratified_split(_dataset(spark, sf), 0.8, SEED).select("customer_id", LABEL, "is_train")


def list_customers(spark, sf):
    data = _dataset(spark, sf).persist()  # read by the fit, the page search and the page
    model = naive_bayes.fit_naive_bayes(data)
    return _rounded(scoring.list_customers(data, model, PAGE, LIMIT, SEARCH))


def list_recent(spark, sf):
    return _rounded(paging.list_recent(_dataset(spark, sf), 25, 100))


def total_count(spark, sf):
    return paging.total_count(paging.search_customers(_dataset(spark, sf), SEARCH))


def best_split(spark, sf):
    return _rounded(splits.best_split(_dataset(spark, sf), LEAKAGE_FREE_FEATURES, LABEL, rows_per_bucket=BUCKET))


# --- models -----------------------------------------------------------------------------------

def zscore(spark, sf):
    data = _dataset(spark, sf)
    m = A.feature_moments(data).first()
    columns = logistic.zscore(FEATURES, [m[f"mean_{f}"] for f in FEATURES], [m[f"sd_{f}"] for f in FEATURES])
    return _rounded(data.select("customer_id", *[c.alias(f) for c, f in zip(columns, FEATURES)]))


def _logistic(spark, sf):
    return logistic.fit_logistic(_dataset(spark, sf))


def lr_fit(spark, sf):
    model = _logistic(spark, sf)
    rows = [("bias", model.bias), *zip(model.features, model.weights)]
    return _rounded(spark.createDataFrame(rows, "feature string, weight double"))


def lr_predict(spark, sf):
    model = logistic.LogisticModel(FIXED_WEIGHTS, FIXED_BIAS, FIXED_MEANS, FIXED_DEVIATIONS, FEATURES)
    return _rounded(model.transform(_dataset(spark, sf)).select("customer_id", "probability_of_default"))


def lr_importance(spark, sf):
    return _importance_table(spark, _logistic(spark, sf))


def nb_predict(spark, sf):
    data, model = _bayes(spark, sf)
    return _rounded(model.transform(data).select("customer_id", "probability_of_default"))


def nb_importance(spark, sf):
    return _importance_table(spark, _bayes(spark, sf)[1])


def _tree(spark, sf):
    data = _dataset(spark, sf)
    return data, trees.fit_tree(data, names=LEAKAGE_FREE_FEATURES)


def dt_fit(spark, sf):
    return _rounded(_tree(spark, sf)[1].node_table(spark))


def dt_predict(spark, sf):
    data, model = _tree(spark, sf)
    return _rounded(model.transform(data).select("customer_id", "probability_of_default"))


def bootstrap(spark, sf):
    return forest.bootstrap_weights(_dataset(spark, sf), seed=SEED)


def feature_subsets(spark, sf):
    """Each tree's features in the order it tries them, with the rows it draws and their mean."""
    data = _dataset(spark, sf)
    return _rounded(forest.drawn_features(data, seed=SEED), 4)


def _forest(spark, sf):
    data = _dataset(spark, sf)
    return data, forest.fit_random_forest(data, seed=SEED)


def rf_fit(spark, sf):
    return _rounded(_forest(spark, sf)[1].node_table(spark))


def rf_predict(spark, sf):
    data, model = _forest(spark, sf)
    return _rounded(model.transform(data).select("customer_id", "probability_of_default"))


def rf_importance(spark, sf):
    return _importance_table(spark, _forest(spark, sf)[1])


def _boosting(spark, sf):
    data = _dataset(spark, sf)
    return data, boosting.fit_boosting(data)


def gb_fit(spark, sf):
    return _rounded(_boosting(spark, sf)[1].node_table(spark))


def gb_predict(spark, sf):
    data, model = _boosting(spark, sf)
    return _rounded(model.transform(data).select("customer_id", "probability_of_default"))


def gb_importance(spark, sf):
    return _importance_table(spark, _boosting(spark, sf)[1])


def compare_models(spark, sf):
    return _rounded(compare.compare_models(_dataset(spark, sf), SEED).metrics)


# --- evaluation -------------------------------------------------------------------------------

def classification_metrics(spark, sf):
    return _rounded(M.classification_metrics(M.confusion(X.scored(spark, sf), threshold=0.2)))


def evaluate(spark, sf):
    return _rounded(M.evaluate(X.scored(spark, sf), "proxy", threshold=0.2))


def _by_model(spark, sf):
    return X.scored(spark, sf).withColumn("model_name", F.concat(F.lit("m"), F.col("customer_id") % 3))


def auc_by_model(spark, sf):
    return _rounded(M.auc_by(_by_model(spark, sf), "model_name"))


def evaluate_by_model(spark, sf):
    return _rounded(M.evaluate_by(_by_model(spark, sf), "model_name", threshold=0.2))


# --- scoring, explanation, serving ------------------------------------------------------------

def pdo_score(spark, sf):
    return X.scored(spark, sf).select("customer_id", C.pdo_score(F.col("p")).alias("credit_score"))


def risk_band(spark, sf):
    band = C.risk_band(F.col("credit_score"))
    return X.score_log(spark, sf).select(
        "score_id", "credit_score", band.alias("band"), C.band_label(band).alias("band_label"),
        C.decision(band).alias("decision"), C.decision_label(C.decision(band)).alias("decision_label"))


def score_customers(spark, sf):
    data, model = _bayes(spark, sf)
    return _score_columns(scoring.score_customers(data, model, _means(model)))


def factor_impacts(spark, sf):
    data, model = _bayes(spark, sf)
    return _exploded_factors(scoring.score_customers(data, model, _means(model)))


def top_factors(spark, sf):
    data, model = _bayes(spark, sf)
    cards = scoring.score_customers(data, model, _means(model))
    return _exploded_factors(cards.select(
        "customer_id", explain.top_factors(F.col("factor_contributions")).alias("factor_contributions")))


def rule_scores(spark, sf):
    return _rounded(scoring.rule_scores(marts.mart_credit_summary(_apps(spark, sf), _records(spark, sf))))


def score_requests(spark, sf):
    data, model = _bayes(spark, sf)
    return _score_columns(scoring.score_requests(X.score_requests(spark, sf), model, _means(model)))


def score_stream(spark, sf):
    data, model = _bayes(spark, sf)
    source = streaming.request_stream(spark, _request_files(spark, sf))
    sink, checkpoint = scratch_path(spark, "scorecards"), scratch_path(spark, "stream-state")
    streaming.score_stream(source, model, _means(model), sink, checkpoint, "skip").awaitTermination()
    return _score_columns(spark.read.parquet(sink))


def model_info(spark, sf):
    info = scoring.model_info(_rounded(M.evaluate_by(_by_model(spark, sf), "model_name", threshold=0.2)))
    return info.withColumn("feature_names", F.array_join("feature_names", ","))


# --- marts ------------------------------------------------------------------------------------

def mart_applications(spark, sf):
    path = scratch_path(spark, "mart-applications")
    table = marts.mart_applications(_apps(spark, sf), _records(spark, sf))
    return _rounded(tables.write_mart(table, path, portfolio.MART_APPLICATIONS))


def mart_bureau(spark, sf):
    return marts.mart_bureau_records(_records(spark, sf)).drop("record_id")


def customer_risk_profile(spark, sf):
    apps, records = _apps(spark, sf), _records(spark, sf)
    return _rounded(marts.customer_risk_profile(
        marts.mart_applications(apps, records), marts.mart_credit_summary(apps, records), _log(spark, sf)))


def check_constraints(spark, sf):
    apps, records = _apps(spark, sf), _records(spark, sf)
    return marts.check_constraints(
        marts.mart_applications(apps, records),
        tables.typed(H.summarize_history(records, "mart"), portfolio.MART_SUMMARY), _log(spark, sf))


def flagship(spark, sf):
    return portfolio.flagship(_apps(spark, sf), _records(spark, sf))


REGISTRY = {f.__name__: f for f in [
    flagship,
    scan_applications, scan_credit_records, scan_requests, insert_if_absent, append_scores,
    mart_applications, parse_number, flags, blank_to_null, parse_status, severity, demographics,
    sigmoid, normalize_requests, recent_rate, search_customers, get_customer, feature_array,
    build_dataset, semi_join_apps, left_default, latest_score, scored_portfolio, portfolio_kpis,
    credit_summary, mart_summary, target_stats, feature_means, zscore_fit, nb_fit, class_weights,
    confusion, service_summary, dedupe_keep_last, score_rank, tie_average_rank, cumulative_pr,
    roc_auc, pr_auc, stratified_split, list_customers, list_recent, total_count, best_split, zscore,
    lr_fit, lr_predict, lr_importance, nb_predict, nb_importance, dt_fit, dt_predict, bootstrap, feature_subsets,
    rf_fit, rf_predict, rf_importance, gb_fit, gb_predict, gb_importance, compare_models,
    classification_metrics, evaluate, auc_by_model, evaluate_by_model, pdo_score, risk_band,
    score_customers, factor_impacts, top_factors, rule_scores, score_requests, score_stream,
    model_info, mart_bureau, customer_risk_profile, check_constraints,
]}
REGISTRY["hard_predict"] = hard_predictions
