import json
import re
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from riskloom.models import naive_bayes
from riskloom.models.base import Model
from riskloom.operators import aggregates, explain, scoring
from riskloom.plans import queries as Q
from riskloom.schemas import FEATURES
from riskloom.session import scratch_path
from riskloom.streaming.scoring import request_stream, score_stream
from test_sources import request


@dataclass
class Flat(Model):
    """Always the same probability; importances as given."""

    p: float = 0.08
    weights: tuple = (0.0,) * 15

    def probability(self):
        return F.lit(self.p)

    def importances(self):
        return list(self.weights)


def card(spark, means=None, model=None, **over):
    row = {f: 0.0 for f in FEATURES}
    row.update(over)
    df = spark.createDataFrame([(1, *[float(row[f]) for f in FEATURES])], ["customer_id", *FEATURES])
    return scoring.score_customers(df, model or Flat(), means or {}).first()


def factors(c):
    return {f.feature_name: f for f in c.factor_contributions}


def test_scorecard_of_a_known_probability(spark):
    c = card(spark)
    assert (c.credit_score, c.risk_band, c.decision) == (586, "Fair", "ManualReview")
    assert [f.feature_name for f in c.factor_contributions] == FEATURES  # equal importances keep the order


def test_factor_texts_and_directions(spark):
    means = {f: 10.0 for f in FEATURES}
    f = factors(card(spark, means, age_years=34.25, employment_years=9.95, annual_income=1234.5, own_car=1.0,
                     income_per_family_member=10.0, credit_history_length_months=12.0,
                     historical_delinquency_rate=0.05, max_past_due_severity=2.0, delinquency_rate_last_6m=0.125))
    assert f["age_years"].description == "34.2 años (Promedio: 10.0 años)"
    assert f["age_years"].display_name == "Edad del Cliente" and f["age_years"].impact_direction == "Positivo"
    assert f["employment_years"].description == "9.9 años de estabilidad laboral"
    assert f["employment_years"].impact_direction == "Negativo"
    assert f["annual_income"].description == "$1234 ingresos declarados"
    assert f["income_per_family_member"].description == "$10 / miembro"
    assert f["income_per_family_member"].impact_direction == "Positivo"
    assert f["credit_history_length_months"].description == "12 meses observados en buró"
    assert f["credit_history_length_months"].impact_direction == "Positivo"
    assert f["historical_delinquency_rate"].description == "5.0% meses con mora registrada"
    assert f["historical_delinquency_rate"].impact_direction == "Positivo"
    assert f["max_past_due_severity"].description == "Nivel de severidad 2 en buró"
    assert f["max_past_due_severity"].impact_direction == "Negativo"
    assert f["delinquency_rate_last_6m"].description == "12.5% en últimos meses"
    assert f["delinquency_rate_last_6m"].impact_direction == "Negativo"
    assert (f["own_car"].description, f["own_car"].impact_direction) == ("Valor: 1.00", "Positivo")
    assert (f["has_email"].description, f["has_email"].impact_direction) == ("Valor: 0.00", "Neutro")


def test_missing_mean_is_the_value_itself(spark):
    f = factors(card(spark, {}, age_years=20.0))
    assert f["age_years"].impact_direction == "Positivo"
    assert f["age_years"].description == "20.0 años (Promedio: 20.0 años)"


def test_factor_order_is_stable(spark):
    weights = [0.1] * 15
    weights[13], weights[4] = 0.5, 0.3
    names = [f.feature_name for f in card(spark, model=Flat(0.5, tuple(weights))).factor_contributions]
    rest = [f for i, f in enumerate(FEATURES) if i not in (13, 4)]
    assert names == [FEATURES[13], FEATURES[4], *rest]
    assert explain.order_factors([]) == list(range(15))


@pytest.fixture(scope="module")
def bayes(dataset):
    return naive_bayes.fit_naive_bayes(dataset), scoring.means_of(aggregates.feature_means(dataset))


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, bayes):
    model, means = bayes
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [request(customer_id=i, age_years=20.0 + i, historical_delinquency_rate=i / 40) for i in range(40)]
    for k in range(4):
        (folder / f"part{k}.json").write_text("\n".join(json.dumps(r) for r in rows[k::4]))
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        score_stream(request_stream(spark, str(folder), 1), model, means, sink, state).awaitTermination()
        return spark.read.parquet(sink)

    from riskloom.sources.requests import read_score_requests
    batch = scoring.score_requests(read_score_requests(spark, str(folder)), model, means)
    streamed = run()
    assert streamed.count() == 40 and streamed.exceptAll(batch).isEmpty()
    assert run().count() == 40
    (folder / "late.json").write_text(json.dumps(request(customer_id=99)))
    assert run().count() == 41


def test_only_the_page_is_scored(spark, dataset, bayes):
    page = scoring.list_customers(dataset, bayes[0], 1, 5, None)
    assert page.columns == ["customer_id", "age", "annual_income", "delinquency_rate", "credit_score", "risk_band", "decision"]
    assert page.count() == 5
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "_log_odds" in plan and re.search(r"Filter .*customer_id#\d+L (IN|INSET)", plan)
    assert scoring.list_customers(dataset, bayes[0], 10**6, 5, None).isEmpty()


def test_unknown_customer_has_no_scorecard(dataset, bayes):
    assert scoring.customer_scorecard(dataset, -1, *bayes).isEmpty()


def test_rule_scores_give_four_values(spark):
    rows = [(1, 1, 0.5), (2, 0, 0.31), (3, 0, 0.3), (4, 0, 0.0)]
    df = spark.createDataFrame(rows, "customer_id long, is_default int, historical_delinquency_rate double")
    got = {r.customer_id: (r.credit_score, r.risk_band, r.decision) for r in scoring.rule_scores(df).collect()}
    assert got == {1: (375, "Alto Riesgo", "Rechazado"), 2: (518, "Alto Riesgo", "Rechazado"),
                   3: (586, "Moderado", "Revisión Manual"), 4: (730, "Bueno", "Aprobado")}


def test_label_is_severity_three(dataset):
    assert dataset.where("(max_past_due_severity >= 3) <> (is_default = 1)").isEmpty()


def test_scratch_path_is_fresh(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(RuntimeError):
        scratch_path(Cluster, "a")


def test_training_tables_are_deleted(spark, dataset):
    import os

    from riskloom.models.base import TrainingTable

    with pytest.raises(ZeroDivisionError):
        with TrainingTable(dataset) as table:
            assert os.path.isdir(table.path)
            1 / 0
    assert not os.path.exists(table.path)


def test_left_join_defaults(spark, sf):
    from riskloom.operators.features import build_features
    features = build_features(Q._apps(spark, sf), Q._summary(spark, sf).where("customer_id > 10"))
    row = features.where("customer_id = 5").first()
    assert row.is_default is None and row.credit_history_length_months == 0.0
