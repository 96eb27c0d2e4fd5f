"""A third of the rows under one key, and whole results all the same."""

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import cohort, evaluate, profile, quantiles
from cohortwise.plans.order_cohort import order_cohort


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    ids = spark.range(3000)
    hot = F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 500).cast("long")
    ids.select(
        hot.alias("l_orderkey"), (F.col("id") % 50 + 1.0).alias("l_quantity"),
        (F.col("id") * 1.5 + 1).alias("l_extendedprice"), F.lit(0.02).alias("l_discount"), F.lit(0.0).alias("l_tax"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    copies = F.when(F.col("id") < 200, 7).otherwise(F.col("id")).cast("long")
    spark.range(600).select(
        copies.alias("o_orderkey"), F.lit("F").alias("o_orderstatus"), (copies * 10.0).alias("o_totalprice")
    ).write.parquet(f"{folder}/orders.parquet")
    return folder


def test_the_cohort_equals_a_plain_join(spark, skewed):
    lines, orders = (spark.read.parquet(f"{skewed}/{t}.parquet") for t in ("lineitem", "orders"))
    plain = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey").agg(
        F.count("l_orderkey").alias("n"), F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("q")
    )
    got = order_cohort(spark, skewed)
    assert got.count() == plain.count()
    assert got.select("pid", "n_lines", "qty").exceptAll(plain).isEmpty()


def test_hot_values_in_quantiles_ranks_and_spikes(spark):
    df = spark.range(9000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 1000.0).alias("x"),
        (F.col("id") % 3 == 0).cast("int").alias("y"),
    )
    probs = [0.05, 0.3, 0.5, 0.62, 0.9]
    whole = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
    fit = quantiles.column_quantiles(df, ["x"], probs, map_limit=0, pick_limit=10)["x"]
    assert fit.values == pytest.approx(whole)
    one, many = (evaluate.ranking_scores(df, "y", ["x"], b).first() for b in (None, 500))
    assert (one.pr_auc, one.roc_auc) == (pytest.approx(many.pr_auc), pytest.approx(many.roc_auc))
    (spike,) = cohort.label_spikes(df, ["x"], "y").collect()
    assert (spike.value, spike.records) == (5.0, 3001)  # id 5000 reads 5.0 as well
    assert profile.class_balance(df, "y").agg(F.sum("records")).first()[0] == 9000
