"""The registered queries: every operator run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit, placeholder_score
from ..functions.scalar import class_label, clip, decide, display_id, position_in_range
from ..operators import clean, cohort, density, evaluate, features, folds, profile, rank_tests, scale
from ..sources import gate, readers, sinks, synthetic
from ..sources.staging import new_path, stage
from ..learners.artifact import load_scorer, publish
from ..learners.pipelines import Settings, logistic_regression
from ..learners.stacking import keyed
from ..streaming.scoring import arriving, score_stream
from . import jobs, train_job
from . import order_cohort as oc

Query = Callable[[SparkSession, str], DataFrame]

KEY, TARGET = oc.KEY, oc.TARGET
NUMERIC = oc.CONTRACT.numeric
HIDDEN = oc.CONTRACT.disguised
CAPPED = ["max_price", "min_disc", "min_tax", "qty", "total"]
SCORE = "score"


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for output, so sums in another order read the same."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def staged_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, because a fit and its application both scan it."""
    return stage(oc.readings(spark, sf_dir), "readings")


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = staged_readings(spark, sf_dir)
    return clean.fit_group_median(base, HIDDEN, TARGET, (0, 1)).apply(base)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = filled(spark, sf_dir)
    return clean.fit_limits(base, CAPPED).apply(base)


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.derive(cleaned(spark, sf_dir), oc.DERIVATIONS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score with ties, for the evaluation queries."""
    base = oc.order_cohort(spark, sf_dir)
    return base.select(KEY, TARGET, F.round(F.col("total") / 500000, 3).alias(SCORE))


def finely_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same score unrounded, whose quantiles do not fall on a rounding boundary."""
    base = oc.order_cohort(spark, sf_dir)
    return stage(base.select(KEY, TARGET, (F.col("total") / 500000).alias(SCORE)), "scores")


# --- sources and checks ----------------------------------------------------------------------


def csv_scan(spark, sf_dir):
    path = sinks.write_table(oc.order_cohort(spark, sf_dir), new_path(spark, "cohort-csv"), "csv")
    df = readers.read_table(spark, [path + "-absent", path], oc.CONTRACT)
    return tidy(df.withColumn(KEY, F.col(KEY).cast("bigint")))


def file_digests(spark, sf_dir):
    found = readers.file_digests(spark, f"{sf_dir}/orders.parquet")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "bytes", "sha256")


def source_fallback(spark, sf_dir):
    sources = [
        ("engineered", f"{sf_dir}/orders_engineered.parquet", "parquet"),
        ("processed", f"{sf_dir}/orders.parquet", "parquet"),
    ]
    keys = lambda: spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    df, source = readers.load_first(
        spark, sources, lambda: synthetic.synthesize(keys(), "o_orderkey", oc.CONTRACT)
    )
    return df.select("o_orderkey", "o_totalprice", F.lit(source).alias("source"))


def synthetic_records(spark, sf_dir):
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias(KEY))
    return tidy(synthetic.synthesize(keys, KEY, oc.CONTRACT))


def modelling_frame(spark, sf_dir):
    return tidy(readers.modelling_frame(oc.order_cohort(spark, sf_dir), oc.CONTRACT))


def screening_columns(spark, sf_dir):
    df = oc.readings(spark, sf_dir)
    limits = {f.name: (float(f.low), float(f.high)) for f in oc.CONTRACT.features}
    inside = {f"{n}_inside": clip(F.col(n).cast("double"), lo, hi) for n, (lo, hi) in limits.items()}
    place = {f"{n}_position": position_in_range(F.col(n), lo, hi) for n, (lo, hi) in limits.items()}
    probability = F.col("total") / 500000
    return tidy(
        df.select(
            KEY,
            display_id(F.col(KEY)).alias("record_id"),
            class_label(F.col(TARGET), "finished", "open").alias("class"),
            decide(probability, 0.366).alias("decision"),
            *[e.alias(n) for n, e in {**inside, **place}.items()],
        )
    )


def placeholder_scores(spark, sf_dir):
    df = oc.order_cohort(spark, sf_dir)
    probability = placeholder_score({n: F.col(n) for n in NUMERIC})
    return df.select(KEY, F.round(probability, 9).alias("probability"), decide(probability, 0.5).alias("label"))


# --- cleaning --------------------------------------------------------------------------------


def _imputed(strategy: str) -> Query:
    def query(spark, sf_dir):
        base = staged_readings(spark, sf_dir)
        return tidy(clean.impute(base, strategy, HIDDEN, by=TARGET, key=KEY))

    return query


def impute_knn(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    return tidy(clean.impute(base, "knn", by=TARGET, key=KEY))


def _capped(method: str) -> Query:
    def query(spark, sf_dir):
        base = staged_readings(spark, sf_dir)
        return tidy(clean.limit_outliers(base, CAPPED, method))

    return query


def _scaled(kind: str) -> Query:
    def query(spark, sf_dir):
        base = staged_readings(spark, sf_dir)
        return tidy(scale.scale(base, NUMERIC, kind)[0])

    return query


# --- profile ---------------------------------------------------------------------------------


def summary_stats(spark, sf_dir):
    return profile.summary_statistics(staged_readings(spark, sf_dir), NUMERIC, 3)


def lineitem_profile(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return profile.summary_statistics(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 3)


def lineitem_group_medians(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = ["l_quantity", "l_extendedprice"]
    return profile.group_statistics(lines, columns, "l_returnflag", ("A", "N", "R"), 6)


def documents_profile(spark, sf_dir):
    return profile.summary_statistics(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["n_chars"], 3)


def column_info(spark, sf_dir):
    return profile.column_info(oc.readings(spark, sf_dir))


def missing_share(spark, sf_dir):
    return profile.missing_share(oc.readings(spark, sf_dir), HIDDEN)


def missingness(spark, sf_dir):
    return profile.missingness(oc.order_cohort(spark, sf_dir), HIDDEN, [KEY, TARGET])


def before_after(spark, sf_dir):
    raw = stage(oc.order_cohort(spark, sf_dir), "cohort")
    base = clean.zeros_to_missing(raw, HIDDEN)
    done = clean.fit_group_median(base, HIDDEN, TARGET, (0, 1)).apply(base)
    return profile.before_after(raw, done, HIDDEN, [KEY, TARGET])


def mann_whitney(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    tests = rank_tests.rank_tests(base, NUMERIC, TARGET)
    return tests.select(
        "feature", "n0", "n1", F.round("u0", 1).alias("u0"), F.round("z", 6).alias("z"),
        F.round("p_value", 6).alias("p_value"), "significant",
    )


def bivariate(spark, sf_dir):
    table = rank_tests.group_comparison(staged_readings(spark, sf_dir), NUMERIC, TARGET, digits=6)
    return table.drop("p_value")


def spearman(spark, sf_dir):
    return rank_tests.rank_correlation(filled(spark, sf_dir), [*NUMERIC, TARGET])


def spearman_in_buckets(spark, sf_dir):
    """The same ranks from buckets of a few values, the way taken where a column has very many."""
    return rank_tests.rank_correlation(filled(spark, sf_dir), [*NUMERIC, TARGET], bucket_rows=500)


def spearman_pairwise(spark, sf_dir):
    return rank_tests.rank_correlation(staged_readings(spark, sf_dir), ["max_price", "min_disc", "min_tax", "total"])


def _curve(df):
    return df.withColumns({"x": F.round("x", 6), "density": F.round("density", 12)})


def density_raw(spark, sf_dir):
    base = stage(oc.order_cohort(spark, sf_dir), "cohort")
    return _curve(density.density(base, ["max_price", "qty"]))


def density_by_class(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    return _curve(density.density(base, ["total", "qty"], TARGET, (0, 1)))


# --- cohort ----------------------------------------------------------------------------------


def rate_by_risk_score(spark, sf_dir):
    return tidy(cohort.rate_by_level(engineered(spark, sf_dir), "risk_score", TARGET))


def rate_by_band_level(spark, sf_dir):
    order = ["Low", "Normal", "High", "Extreme", "Unknown"]
    return tidy(cohort.rate_by_level(engineered(spark, sf_dir), "price_band", TARGET, order))


def folded_categories(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    return tidy(cohort.folded_categories(parts, "p_brand"))


def category_counts(spark, sf_dir):
    return tidy(cohort.category_counts(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_mktsegment"))


def histograms(spark, sf_dir):
    return tidy(cohort.histogram(staged_readings(spark, sf_dir), NUMERIC))


def lineitem_histogram(spark, sf_dir):
    return tidy(cohort.histogram(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_extendedprice"))


def scatter_sample(spark, sf_dir):
    return tidy(cohort.scatter_sample(oc.readings(spark, sf_dir), KEY, ["total", "qty"], TARGET))


def rate_by_category(spark, sf_dir):
    df = features.derive(oc.readings(spark, sf_dir), oc.DERIVATIONS)
    return tidy(cohort.rate_by_category(df, "price_band", TARGET))


def record_vs_cohort(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    return tidy(cohort.record_comparison(base, base, KEY, oc.CONTRACT))


def percentile_lookup(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    records = lines.groupBy(F.col("l_orderkey").alias(KEY)).agg(F.min("l_extendedprice").alias("max_price"))
    return tidy(cohort.percentile_lookup(records, base, "max_price"))


def label_leak(spark, sf_dir):
    df = filled(spark, sf_dir)
    return tidy(cohort.label_spikes(df, NUMERIC, TARGET, 0.01, 0.25))


def duplicates(spark, sf_dir):
    base = stage(oc.order_cohort(spark, sf_dir).drop(KEY), "cohort")  # the key is unique by definition
    return cohort.duplicate_report(base, oc.CONTRACT)


def document_duplicates(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").drop("doc_id")
    return cohort.duplicate_report(df, oc.CONTRACT)


# --- splits ----------------------------------------------------------------------------------


def split(spark, sf_dir):
    base = stage(oc.order_cohort(spark, sf_dir).select(KEY, TARGET), "labels")
    return folds.stratified_split(base, KEY, TARGET)


def fold_table(spark, sf_dir):
    base = stage(oc.order_cohort(spark, sf_dir).select(KEY, TARGET), "labels")
    return folds.stratified_folds(base, KEY, TARGET)


def hash_folds(spark, sf_dir):
    base = oc.order_cohort(spark, sf_dir).select(KEY, TARGET)
    drawn = folds.stratified_folds(base, KEY, TARGET, 5, 7, exact=False)
    return tidy(drawn.withColumn("u", hash_unit(F.col(KEY), 7, "draw")), 9)


def class_weights(spark, sf_dir):
    base = oc.order_cohort(spark, sf_dir).select(KEY, TARGET)
    weights = folds.class_weights(base, TARGET)
    return tidy(base.select(KEY, TARGET, folds.weight_column(TARGET, weights).alias("weight")))


# --- learners and jobs -----------------------------------------------------------------------

#: small learners, so that a query stays a query
LIGHT = Settings(
    iterations=8, trees=4, forest_depth=3, rounds=2, svm_iterations=4, calibration_folds=2, stacking_folds=2,
    mode="approx",
)


def oof_scores(spark, sf_dir):
    learners = [logistic_regression(NUMERIC, TARGET, LIGHT)]
    return tidy(train_job.compare(staged_readings(spark, sf_dir), KEY, TARGET, learners, 3, 42), 4)


def leaderboard_table(spark, sf_dir):
    run, _ = _trained(spark, sf_dir)
    return tidy(run.board, 3)


def _trained(spark, sf_dir):
    """The run behind the training queries, with its model published: all learners and the stack."""
    out = new_path(spark, "training")
    run = train_job.run_training(staged_readings(spark, sf_dir), oc.CONTRACT, out, LIGHT, folds=2)
    return run, out


def training_metrics(spark, sf_dir):
    """The metrics document as it was written, read back, in long form: one row per number."""
    run, out = _trained(spark, sf_dir)
    record = spark.read.schema(run.metrics.schema).json(f"{out}/metrics")
    marks = ("pr_auc", "roc_auc", "recall", "precision", "f1", "accuracy", "threshold")
    pairs = {f"rows.{c}": F.col(f"rows.{c}") for c in ("total", "train", "test")}
    pairs |= {"seed": F.col("seed"), "split.test_share": F.col("split.test_share"), "split.folds": F.col("split.folds")}
    for part in ("test", "test_at_half"):
        pairs |= {f"{part}.{c}": F.col(f"{part}.{c}") for c in marks}
        cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
        pairs |= {f"{part}.{c}": F.col(f"{part}.confusion_matrix")[i][j] for c, (i, j) in cells.items()}
    numbers = record.select(F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), v.cast("double").alias("value")) for n, v in pairs.items()])))
    floor = record.select(F.explode("always_negative").alias("m", "value")).select(F.concat(F.lit("always_negative."), "m").alias("measure"), "value")
    tables = train_job.report_tables(record)
    board = tables["leaderboard"].select(F.inline(F.array(*[F.struct(F.concat(F.lit(f"leaderboard.{c}."), "model").alias("measure"), F.col(c).alias("value")) for c in ("cv_pr_auc", "cv_roc_auc")])))
    deltas = tables["deltas"].select(F.inline(F.array(*[F.struct(F.lit(f"floor.{c}").alias("measure"), F.col(c).alias("value")) for c in tables["deltas"].columns])))
    return tidy(numbers.unionByName(floor).unionByName(board).unionByName(deltas), 6)


#: one learner at the full settings, for the queries that score with a published model
SCORING = Settings()


def _published(spark, sf_dir, base):
    """A logistic regression at full settings, saved and loaded again."""
    path, train = new_path(spark, "model"), keyed(base, KEY)
    learner = logistic_regression(NUMERIC, TARGET, SCORING)
    publish(spark, path, learner.fit(train), learner.output, 0.5, NUMERIC)
    return load_scorer(spark, path, NUMERIC)


def score_table_trained(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    placed, _ = jobs.score_records(base, _published(spark, sf_dir, base), base, oc.CONTRACT, "total")
    return tidy(placed.select(KEY, "probability", "label", "source", "primary_percentile"), 4)


def score_stream_trained(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    folder, sink = new_path(spark, "arriving"), new_path(spark, "scored")
    base.write.parquet(folder)
    stream = arriving(spark, folder, base.schema)
    score_stream(stream, _published(spark, sf_dir, base), sink, new_path(spark, "scored-checkpoint")).awaitTermination()
    return tidy(spark.read.parquet(sink).select(KEY, "probability", "label", "source"), 4)


def score_table(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    scorer = load_scorer(spark, new_path(spark, "no-model"), NUMERIC)
    placed, _ = jobs.score_records(base, scorer, base, oc.CONTRACT, "total")
    return tidy(placed.select(KEY, "probability", "label", "source", "primary_percentile"), 9)


def score_stream_table(spark, sf_dir):
    base = staged_readings(spark, sf_dir)
    folder = base.inputFiles()[0].rsplit("/", 1)[0]
    sink = new_path(spark, "scored")
    scorer = load_scorer(spark, new_path(spark, "no-model"), NUMERIC)
    stream = arriving(spark, folder, base.schema)
    score_stream(stream, scorer, sink, new_path(spark, "scored-checkpoint")).awaitTermination()
    return tidy(spark.read.parquet(sink).select(KEY, "probability", "label", "source"), 9)


def clean_job(spark, sf_dir):
    done = jobs.run_cleaning(
        oc.order_cohort(spark, sf_dir), oc.CONTRACT, oc.DERIVATIONS, outlier_columns=CAPPED
    )
    return tidy(done.engineered)


def cohort_report(spark, sf_dir):
    base = stage(engineered(spark, sf_dir), "engineered")
    roles = {"primary": "max_price", "body": "qty", "age": "total"}
    tables = jobs.cohort_report(base, oc.CONTRACT, "risk_score", ["price_band"], roles)
    return tidy(tables["rate_by_score"])


def leakage_audit(spark, sf_dir):
    audit = train_job.leakage_audit(staged_readings(spark, sf_dir), oc.CONTRACT, LIGHT, 2)
    return tidy(audit, 3)


def _on_scan(operator: Callable[..., DataFrame], *args) -> Query:
    """For operators that read their input once, which need no written copy."""
    return lambda spark, sf_dir: tidy(operator(oc.readings(spark, sf_dir), *args))


def _on_readings(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: tidy(operator(staged_readings(spark, sf_dir), *args))


def _on_cohort(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: tidy(operator(oc.order_cohort(spark, sf_dir), *args))


def _on_engineered(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: tidy(operator(engineered(spark, sf_dir), *args))


def _on_scored(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: tidy(operator(scored(spark, sf_dir), TARGET, SCORE, *args))


def _on_staged_scores(operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: tidy(operator(finely_scored(spark, sf_dir), TARGET, SCORE, *args))


QUERIES: dict[str, Query] = {
    "cohort": lambda spark, sf_dir: tidy(oc.order_cohort(spark, sf_dir)),
    "csv_scan": csv_scan,
    "file_digests": file_digests,
    "source_fallback": source_fallback,
    "schema_gate": _on_cohort(gate.gate_report, oc.CONTRACT),
    "range_violations": _on_cohort(gate.conformance, oc.CONTRACT),
    "modelling_frame": modelling_frame,
    "preview": _on_cohort(sinks.preview, KEY, 20),
    "synthetic": synthetic_records,
    "screening_columns": screening_columns,
    "placeholder_scores": placeholder_scores,
    "impute_median": _imputed("median"),
    "impute_mean": _imputed("mean"),
    "impute_group_median": _imputed("median_by_group"),
    "impute_knn": impute_knn,
    "winsorize": _capped("winsorize"),
    "iqr_cap": _capped("iqr_cap"),
    "scale_standard": _scaled("standard"),
    "scale_robust": _scaled("robust"),
    "scale_minmax": _scaled("minmax"),
    "features": lambda spark, sf_dir: tidy(engineered(spark, sf_dir)),
    "summary_stats": summary_stats,
    "lineitem_profile": lineitem_profile,
    "lineitem_group_medians": lineitem_group_medians,
    "documents_profile": documents_profile,
    "describe": _on_readings(profile.describe, NUMERIC),
    "column_info": column_info,
    "corrected_skewness": _on_scan(profile.corrected_skewness, NUMERIC),
    "missingness": missingness,
    "missing_share": missing_share,
    "before_after": before_after,
    "group_stats": _on_readings(profile.group_statistics, NUMERIC, TARGET, (0, 1), 6),
    "bivariate": bivariate,
    "mann_whitney": mann_whitney,
    "iqr_outliers": _on_readings(profile.outlier_fences, NUMERIC, 1.5, 6),
    "class_balance": _on_cohort(profile.class_balance, TARGET, "finished", "open"),
    "target_shares": _on_cohort(profile.class_balance, TARGET),
    "crosstab": _on_engineered(profile.crosstab, "price_band", TARGET),
    "corr_long": _on_readings(profile.correlation, [*NUMERIC, TARGET]),
    "corr_heatmap": _on_readings(profile.correlation, [*NUMERIC, TARGET], 2),
    "spearman": spearman,
    "spearman_in_buckets": spearman_in_buckets,
    "spearman_pairwise": spearman_pairwise,
    "box_stats": _on_readings(profile.box_statistics, NUMERIC),
    "box_by_class": _on_readings(profile.box_statistics, NUMERIC, TARGET, (0, 1)),
    "density": density_raw,
    "density_by_class": density_by_class,
    "headline": _on_engineered(cohort.headline, TARGET, "risk_score"),
    "headline_complete": _on_scan(cohort.headline, TARGET),
    "top_risk": _on_engineered(cohort.top_records, KEY, ["risk_score", "max_price", "qty"], TARGET),
    "folded_categories": folded_categories,
    "category_counts": category_counts,
    "histogram": histograms,
    "lineitem_histogram": lineitem_histogram,
    "scatter_sample": scatter_sample,
    "completeness": _on_scan(cohort.completeness),
    "rate_by_category": rate_by_category,
    "rate_by_band": _on_readings(cohort.rate_by_band, "qty", TARGET),
    "prevalence_line": _on_readings(cohort.prevalence_line, "max_price", TARGET),
    "cdf": _on_readings(cohort.cumulative_distribution, "total"),
    "cdf_marker": _on_scan(cohort.share_at_or_below, "total", 123456.78),
    "record_vs_cohort": record_vs_cohort,
    "percentile_lookup": percentile_lookup,
    "majority_floor": _on_cohort(cohort.majority_floor, TARGET),
    "ordinal_counts": _on_cohort(cohort.ordinal_counts, "n_lines"),
    "rate_by_level": _on_cohort(cohort.rate_by_level, "n_lines", TARGET),
    "rate_by_risk_score": rate_by_risk_score,
    "rate_by_band_level": rate_by_band_level,
    "implausible_zeros": _on_cohort(cohort.implausible_zeros, oc.CONTRACT),
    "label_leak": label_leak,
    "duplicates": duplicates,
    "document_duplicates": document_duplicates,
    "average_precision": _on_scored(evaluate.average_precision),
    "roc_auc": _on_scored(evaluate.roc_auc),
    "confusion": _on_scored(evaluate.confusion, 0.366),
    "confusion_table": _on_scored(evaluate.confusion_table, 0.366),
    "scores_at_threshold": _on_scored(evaluate.scores_at, 0.366),
    "threshold_table": _on_staged_scores(evaluate.threshold_table),
    "threshold_search": _on_staged_scores(evaluate.best_threshold, 0.70),
    "split": split,
    "folds": fold_table,
    "hash_folds": hash_folds,
    "class_weights": class_weights,
    "oof_scores": oof_scores,
    "leaderboard": leaderboard_table,
    "training_metrics": training_metrics,
    "leakage_audit": leakage_audit,
    "score_table_trained": score_table_trained,
    "score_stream_trained": score_stream_trained,
    "score_table": score_table,
    "score_stream": score_stream_table,
    "clean_job": clean_job,
    "cohort_report": cohort_report,
}
