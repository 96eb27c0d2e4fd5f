import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortwise.learners import pipelines
from cohortwise.learners.artifact import load_scorer, publish
from cohortwise.learners.pipelines import Settings, Shared, candidates, fourier_columns, probability, support_vector
from cohortwise.learners.stacking import folded_table, keyed, leaderboard, out_of_fold, scores_table, stacking
from cohortwise.operators.evaluate import roc_auc
from cohortwise.operators.folds import stratified_folds
from cohortwise.plans import train_job
from cohortwise.plans.order_cohort import CONTRACT, KEY, TARGET
from cohortwise.sources.staging import new_path, stage
from cohortwise.streaming.scoring import arriving, score_stream

TINY = Settings(iterations=15, trees=5, forest_depth=3, rounds=3, svm_iterations=5, calibration_folds=2, stacking_folds=2)
FEATURES = ["max_price", "min_disc", "qty"]


@pytest.fixture(scope="module")
def table(spark):
    """A label that depends on two readings, some of them missing."""
    df = spark.range(400).select(
        F.col("id").alias(KEY),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 10.0).alias("max_price"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 10.0).alias("min_disc"),
        (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1000)) / 10.0).alias("qty"),
    )
    noisy = F.col("max_price") + F.col("min_disc") * 0.3 + F.pmod(F.xxhash64(KEY, F.lit(4)), F.lit(30))
    df = df.withColumn(TARGET, (noisy > 95).cast("int"))
    return stage(df.withColumn("max_price", F.when(F.col(KEY) % 7 != 0, F.col("max_price"))), "learning")


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest", "gradient_boosting", "svm"])
def test_every_candidate_gives_probabilities_for_rows_with_holes(table, name):
    learner = candidates(FEATURES, TARGET, TINY)[name]
    out = learner.fit(keyed(table, KEY)).transform(table)
    assert out.columns == [*table.columns, learner.output]
    low, high, n = out.agg(
        F.min(probability(learner.output)), F.max(probability(learner.output)), F.count(probability(learner.output))
    ).first()
    assert 0 <= low < high <= 1 and n == 400


def test_a_column_missing_in_training_still_scores(table):
    empty = table.withColumn("qty", F.lit(None).cast("double"))
    learner = candidates(FEATURES, TARGET, TINY)["logistic_regression"]
    out = learner.fit(keyed(empty, KEY)).transform(table)
    assert out.where(F.isnan(probability(learner.output))).count() == 0


def test_out_of_fold_predicts_every_row_once_and_ranks(table):
    learners = [candidates(FEATURES, TARGET, TINY)["logistic_regression"]]
    oof = train_job.compare(table, KEY, TARGET, learners, 3, 42)
    assert oof.count() == 400 and oof.select(KEY).distinct().count() == 400
    (row,) = leaderboard(oof, TARGET, ["logistic_regression"]).collect()
    assert row.cv_roc_auc > 0.8


def test_training_publishes_a_model_that_batch_and_stream_share(spark, table):
    out = new_path(spark, "training")
    run = train_job.run_training(table, CONTRACT, out, TINY, folds=2, with_singles=False)
    doc = run.metrics.first()
    assert (doc.rows.total, doc.rows.train + doc.rows.test, doc.features) == (400, 400, FEATURES)
    assert doc.test.roc_auc > 0.75 and len(doc.test.confusion_matrix) == 2
    tables = train_job.report_tables(spark.read.schema(run.metrics.schema).json(f"{out}/metrics"))
    assert tables["confusion"].count() == 2 and tables["deltas"].first().roc_auc_over_floor > 0.25

    scorer = load_scorer(spark, f"{out}/model", FEATURES)
    assert scorer.source == "trained" and scorer.threshold == run.threshold
    batch = scorer.score(table)
    assert batch.where(F.col("label") != (F.col("probability") >= run.threshold).cast("int")).count() == 0

    folder, sink = new_path(spark, "arriving"), new_path(spark, "scored")
    table.repartition(3).write.parquet(folder)
    for _ in range(2):  # the second run finds nothing new
        stream = arriving(spark, folder, table.schema, 1)
        score_stream(stream, scorer, sink, f"{sink}-checkpoint").awaitTermination()
    scored = spark.read.parquet(sink)
    assert scored.count() == 400
    assert scored.select(KEY, "probability").exceptAll(batch.select(KEY, "probability")).isEmpty()


def test_placeholder_without_a_model_is_deterministic(spark, table):
    scorer = load_scorer(spark, new_path(spark, "nothing"), FEATURES)
    assert scorer.source == "placeholder"
    first, second = scorer.score(table), scorer.score(table.repartition(7))
    assert first.exceptAll(second).isEmpty()
    assert first.where("probability < 0 OR probability >= 1").isEmpty()


def test_stack_uses_only_its_training_rows(spark, table):
    """The stack fitted without some rows does not change when those rows do."""
    train, held = table.where(F.col(KEY) < 300), table.where(F.col(KEY) >= 300)
    changed = train.unionByName(held.withColumn("max_price", F.lit(1e6)))
    models = [stacking(FEATURES, TARGET, TINY).fit(keyed(t.where(F.col(KEY) < 300), KEY)) for t in (table, changed)]
    a, b = (m.transform(train).select(KEY, F.round(probability("p_stacking"), 9).alias("p")) for m in models)
    assert a.exceptAll(b).isEmpty()


def test_label_filled_readings_inflate_the_forest(table):
    """A reading that says nothing, missing in half of the rows, tells the label once it is filled by class."""
    holes = F.pmod(F.xxhash64(KEY, F.lit(9)), F.lit(2)) == 0
    noisy = table.withColumn("qty", F.when(~holes, F.col("qty"))).withColumn("max_price", F.when(~holes, F.col("max_price")))
    settings = Settings(trees=20, forest_depth=5, stacking_folds=2)
    rows = {r.data: r for r in train_job.leakage_audit(stage(noisy, "noisy"), CONTRACT, settings, 3).collect()}
    assert rows["label_filled"].pr_auc > rows["fold_filled"].pr_auc + 0.05
    assert rows["label_filled"].recall > rows["fold_filled"].recall


def test_fits_side_by_side_equal_fits_in_turn(table):
    learners = [m for name, m in candidates(FEATURES, TARGET, TINY).items() if name in ("logistic_regression", "random_forest")]
    folded = folded_table(keyed(table, KEY), KEY, TARGET, 2, 7)
    one, many = (scores_table(out_of_fold(folded, learners, 2, [KEY], n), learners, [KEY]).toPandas().sort_values(KEY) for n in (1, 8))
    assert len(one) == len(many) == 400
    for m in learners:
        assert abs(one[m.name].to_numpy() - many[m.name].to_numpy()).max() < 1e-6


def test_fits_over_the_same_rows_share_what_they_fit(table, monkeypatch):
    """Medians are fitted once per set of rows, and a stack takes the members already fitted to its rows."""
    asked, real = [], pipelines.fit_median
    monkeypatch.setattr(pipelines, "fit_median", lambda *a: asked.append(a) or real(*a))
    settings = Settings(**{**vars(TINY), "learners": ("logistic_regression", "random_forest")})
    learners = [*candidates(FEATURES, TARGET, settings).values(), stacking(FEATURES, TARGET, settings)]
    folded = folded_table(keyed(table, KEY), KEY, TARGET, 2, 7)
    together = scores_table(out_of_fold(folded, learners, 2, [KEY]), learners, [KEY])
    assert len(asked) == 2 * (1 + settings.stacking_folds)
    alone = None
    for i in range(2):
        held = folded.where(F.col("fold") == i)
        for m in learners:
            held = m.fit(folded.where(F.col("fold") != i)).transform(held).withColumnRenamed(m.output, f"held_{m.output}")
        held = held.select(KEY, *[probability(f"held_{m.output}").alias(m.name) for m in learners])
        alone = held if alone is None else alone.unionByName(held)
    one, many = (d.toPandas().sort_values(KEY) for d in (alone, together))
    assert len(one) == len(many) == 400
    for m in learners:
        assert abs(one[m.name].to_numpy() - many[m.name].to_numpy()).max() < 1e-9


def test_what_fails_once_fails_for_all_that_share_it():
    shared, made = Shared(), []
    for _ in range(2):
        with pytest.raises(ZeroDivisionError):
            shared.once("medians", lambda: made.append(1) or 1 / 0)
    assert made == [1] and shared.once("sizes", lambda: 3) == 3


def test_kernel_margin_separates_rings_a_line_cannot(spark):
    draw = np.random.default_rng(7)
    y = np.arange(600) % 3 // 2
    angle, radius = draw.uniform(0, 2 * np.pi, 600), np.where(y == 1, 1.0, 3.0) + draw.normal(0, 0.2, 600)
    rings = pd.DataFrame({"id": range(600), "a": radius * np.cos(angle), "b": radius * np.sin(angle), "y": y})
    df = stage(stratified_folds(keyed(spark.createDataFrame(rings), "id"), "id", "y", 3, 1), "rings")
    scores = {}
    for terms in (0, 64):
        learner = support_vector(["a", "b"], "y", Settings(kernel_terms=terms, calibration_folds=2, svm_iterations=20))
        model = learner.fit(df.where("fold != 0"))
        held = model.transform(df.where("fold = 0")).select("y", probability(learner.output).alias("p"))
        scores[terms] = roc_auc(held, "y", "p").first()[0]
    assert scores[0] < 0.75 and scores[64] > 0.95


def test_fourier_features_approach_the_radial_kernel(spark):
    draw = np.random.default_rng(1)
    points = draw.normal(0, 1, (12, 3))
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "a double, b double, c double")
    waves = np.array(df.selectExpr(*fourier_columns(["a", "b", "c"], 400, 3)).collect())
    kernel = np.exp(-((points[:, None] - points[None]) ** 2).sum(axis=2) / 3)
    assert np.abs(waves @ waves.T - kernel).max() < 5 / np.sqrt(400)
