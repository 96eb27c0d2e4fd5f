"""Every registered query with SQL gives the same rows in another engine, over whole tables."""

import pytest

import compare
from __spark_entry__ import entry
from cohortwise.plans.oracles import ORACLES
from cohortwise.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WITHOUT_SQL = {"file_digests", "oof_scores", "leaderboard", "training_metrics", "leakage_audit"}
WITHOUT_SQL |= {"score_table_trained", "score_stream_trained"}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_only_queries_without_an_sql_form_lack_one():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    _, _, verdict = compare.compare(spark, con, name, SF_DIR)
    assert verdict == "same"


def test_training_metrics_are_whole_and_agree(spark):
    numbers = {r["measure"]: r["value"] for r in QUERIES["training_metrics"](spark, SF_DIR).collect()}
    names = {n.split(".")[2] for n in numbers if n.startswith("leaderboard.cv_pr_auc.")}
    assert names == {"logistic_regression", "random_forest", "gradient_boosting", "svm", "stacking"}
    assert numbers["rows.train"] + numbers["rows.test"] == numbers["rows.total"] == 1500
    for part in ("test", "test_at_half"):
        tn, fp, fn, tp = (numbers[f"{part}.{c}"] for c in ("tn", "fp", "fn", "tp"))
        assert tn + fp + fn + tp == numbers["rows.test"]
        assert numbers[f"{part}.recall"] == pytest.approx(tp / (tp + fn), abs=1e-6)
        assert numbers[f"{part}.accuracy"] == pytest.approx((tp + tn) / numbers["rows.test"], abs=1e-6)
    assert numbers["floor.recall_over_floor"] == pytest.approx(numbers["test.recall"])


def test_batch_and_stream_score_alike_with_the_published_model(spark):
    batch = QUERIES["score_table_trained"](spark, SF_DIR).select("pid", "probability", "label", "source")
    stream = QUERIES["score_stream_trained"](spark, SF_DIR).select("pid", "probability", "label", "source")
    assert {r["source"] for r in batch.select("source").distinct().collect()} == {"trained"}
    assert batch.count() == 1500 and batch.exceptAll(stream).isEmpty()


def test_entry_has_rows(spark):
    assert entry(spark).count() == 5
