import math

from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortwise.contract import CLINICAL, Contract, Field
from cohortwise.functions.scalar import band, clip, interval_number, points, ratio, zero_to_null
from cohortwise.operators import clean, cohort, density, evaluate, folds, knn, moments, profile, quantiles, rank_tests, ranks, scale
from cohortwise.sources.staging import stage
from cohortwise.operators.features import CLINICAL_DERIVATIONS, derive
from cohortwise.sources import gate, readers, sinks, synthetic
from cohortwise.sources.staging import new_path, stage

PROBS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]


def rows(df):
    return [tuple(r) for r in df.collect()]


def column(df, *names):
    return [tuple(r) if len(names) > 1 else r[0] for r in df.select(*names).collect()]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    n = 3000
    frame = pd.DataFrame(
        {
            "k": np.arange(n),
            "smooth": rng.normal(0, 10, n),
            "skewed": np.exp(rng.normal(0, 3, n)),
            "hot": np.where(rng.random(n) < 0.4, 7.5, rng.normal(7.5, 1, n)),
            "few": rng.integers(0, 5, n).astype(float),
            "same": 2.0,
            "y": (rng.random(n) < 0.35).astype(int),
        }
    )
    frame.loc[rng.random(n) < 0.1, "smooth"] = np.nan
    df = spark.createDataFrame(frame).withColumn("smooth", F.nanvl("smooth", F.lit(None)))
    return stage(df, "numbers"), frame


# --- scalar expressions ----------------------------------------------------------------------


def test_scalar_expressions_keep_nulls_and_edges(spark):
    df = spark.sql("SELECT * FROM VALUES (18.5D, 0D, 0), (24.9D, -0.0D, 3), (30D, 2D, 4), (NULL, NULL, 0) t(x, z, n)")
    out = df.select(
        band(F.col("x"), (18.5, 24.9, 29.9), ("u", "n", "o", "b")),
        clip(F.col("x"), 20.0, 25.0),
        zero_to_null(F.col("z")),
        ratio(F.col("x"), F.col("n")),
        points({"x": 24, "z": 2}),
        interval_number(F.col("x"), [18.5, 24.9, 30.0]),
    )
    assert rows(out) == [
        ("u", 20.0, None, None, 0, 1),
        ("n", 24.9, None, 24.9 / 3, 1, 1),
        ("b", 25.0, 2.0, 7.5, 2, 2),
        (None, None, None, None, 0, None),
    ]


def test_clinical_derivations_skip_absent_columns(spark):
    df = spark.sql("SELECT 0 AS Pregnancies, 148D AS Glucose, 72D AS BloodPressure, 33.6D AS BMI, 50 AS Age")
    out = derive(df, CLINICAL_DERIVATIONS)
    assert "HOMA_IR_Proxy" not in out.columns
    row = out.first()
    assert (row.BMI_Category, row.Glucose_Risk, row.Age_Group) == ("Obese", "Prediabetes", "Senior")
    assert (row.Pregnancy_Rate, row.Metabolic_Risk_Score) == (0.0, 3)


# --- quantiles and ranks ---------------------------------------------------------------------


@pytest.mark.parametrize("limits", [{}, {"map_limit": 0}, {"map_limit": 0, "pick_limit": 5}])
def test_quantiles_are_exact_on_every_path(numbers, limits):
    df, frame = numbers
    names = ["smooth", "skewed", "hot", "few", "same"]
    fits = quantiles.column_quantiles(df, names, PROBS, **limits)
    for name in names:
        present = frame[name].dropna()
        assert fits[name].count == len(present)
        assert np.allclose(fits[name].values, np.quantile(present, PROBS), rtol=1e-12)


def test_many_quantiles_and_groups_by_narrowing(numbers):
    df, frame = numbers
    probs = [i / 199 for i in range(200)]
    fit = quantiles.column_quantiles(df, ["skewed"], probs, map_limit=0, pick_limit=50)["skewed"]
    assert np.allclose(fit.values, np.quantile(frame["skewed"], probs), rtol=1e-12)
    grouped = quantiles.group_quantiles(df, ["hot"], [0.5], "y", map_limit=0)
    for y in (0, 1):
        assert grouped[y, "hot"].values[0] == pytest.approx(frame.loc[frame.y == y, "hot"].median())


def test_quantiles_without_values(spark):
    df = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, 'NaN' AS t").withColumn("z", F.lit(float("nan")))
    for limits in ({}, {"map_limit": -1, "pick_limit": 1}):
        fits = quantiles.column_quantiles(df, ["x", "z"], [0.5], **limits)
        assert fits["x"] == quantiles.Fit(0, [None]) and fits["z"].count == 0


def test_approximate_quantiles_are_close(numbers):
    df, frame = numbers
    fit = quantiles.column_quantiles(df, ["skewed"], [0.5], "approx")["skewed"]
    share = (frame["skewed"] <= fit.values[0]).mean()
    assert abs(share - 0.5) < 0.01
    with pytest.raises(ValueError):
        quantiles.column_quantiles(df, ["skewed"], [0.5], "guess")


@pytest.mark.parametrize("bucket_rows", [None, 100])
def test_average_ranks_in_one_or_many_buckets(numbers, bucket_rows):
    df, frame = numbers
    out = rank_tests.attach_ranks(df, {c: F.col(c) for c in ("smooth", "hot")}, bucket_rows=bucket_rows)
    got = out.orderBy("k").toPandas()
    for c in ("smooth", "hot"):
        want = frame[c].rank().to_numpy()
        assert np.allclose(got[f"rank_{c}"].astype(float), want, equal_nan=True)


def test_rank_lookup_by_shuffle_with_hot_values(numbers, monkeypatch):
    df, frame = numbers
    monkeypatch.setattr("cohortwise.operators.lookup.BROADCAST_ROWS", 0)
    out = rank_tests.attach_ranks(df, {"hot": F.col("hot"), "smooth": F.col("smooth")}).orderBy("k").toPandas()
    assert len(out) == len(frame)
    for c in ("hot", "smooth"):
        assert np.allclose(out[f"rank_{c}"].astype(float), frame[c].rank(), equal_nan=True)


@pytest.mark.parametrize("bucket_rows", [None, 100])
def test_rank_correlation_is_pairwise(numbers, bucket_rows):
    df, frame = numbers
    names = ["smooth", "skewed", "hot"]
    got = {(r[0], r[1]): r[2] for r in rows(rank_tests.rank_correlation(df, names, 9, bucket_rows))}
    for a in names:
        for b in names:
            both = frame[[a, b]].dropna() if a != b else frame[[a]].dropna()
            want = both[a].rank().corr(both[b].rank())
            assert got[a, b] == pytest.approx(want, abs=1e-8)


def test_u_statistic_against_counting(numbers):
    df, frame = numbers
    for buckets in (None, 50):
        got = {r.feature: r for r in rank_tests.rank_sums(df, ["few", "smooth"], "y", buckets).collect()}
        for c in ("few", "smooth"):
            a = frame.loc[(frame.y == 0), c].dropna().to_numpy()
            b = frame.loc[(frame.y == 1), c].dropna().to_numpy()
            pairs = (a[:, None] > b[None, :]).sum() + 0.5 * (a[:, None] == b[None, :]).sum()
            assert got[c].u0 == pytest.approx(pairs)


def test_exact_p_value_at_every_size(spark):
    for n0, n1 in ((1, 6), (3, 4), (5, 5), (2, 9)):
        us = [sum(sum(b > a for b in range(n0 + n1) if b not in own) for a in own) for own in combinations(range(n0 + n1), n0)]
        for u in set(us):
            tail = sum(v >= max(u, n0 * n1 - u) for v in us)
            assert rank_tests.exact_p_value(u, n0, n1) == pytest.approx(min(1.0, 2 * tail / len(us)))
    near = [rank_tests.exact_p_value(1.2 * n, 2, n) for n in (10**5, 10**6, 10**12)]  # any size, no jump
    assert max(near) - min(near) < 1e-4
    with pytest.raises(ValueError):
        rank_tests.exact_p_value(40, 9, 9)


def test_exact_p_value_for_small_samples(spark):
    # all 35 ways to pick 3 ranks of 7: U >= 11 happens in 2 of them, on both sides 4
    assert rank_tests.exact_p_value(11, 3, 4) == pytest.approx(4 / 35)
    df = spark.sql("SELECT * FROM VALUES (0,1D),(0,2D),(0,4D),(1,3D),(1,5D),(1,6D),(1,7D) t(y, x)")
    row = rank_tests.rank_tests(df, ["x"], "y").first()
    assert (row.u0, row.p_value) == (1.0, pytest.approx(4 / 35))
    assert not row.significant


# --- cleaning and scaling --------------------------------------------------------------------


@pytest.fixture(scope="module")
def holes(spark):
    return spark.sql(
        "SELECT * FROM VALUES (1,0,2D,1D),(2,0,NULL,NULL),(3,0,4D,NULL),(4,1,10D,NULL),(5,1,NULL,NULL),"
        "(6,NULL,NULL,5D) t(k, y, a, b)"
    )


def test_group_median_falls_back_to_the_filled_column(holes):
    out = clean.impute(holes, "median_by_group", by="y", key="k").orderBy("k")
    assert column(out, "a") == [2.0, 3.0, 4.0, 10.0, 10.0, 4.0]
    # class 1 has no b at all: the median of 1, 1, 1, 5 fills it
    assert column(out, "b") == [1.0, 1.0, 1.0, 1.0, 1.0, 5.0]


def test_other_strategies_and_names(holes):
    assert column(clean.impute(holes, "mean", ["a"]).orderBy("k"), "a")[1] == pytest.approx(16 / 3)
    assert column(clean.impute(holes, "median", ["a"]).orderBy("k"), "a")[1] == 4.0
    assert clean.impute(holes.select("k"), "mean").columns == ["k"]
    with pytest.raises(ValueError):
        clean.impute(holes, "magic")
    with pytest.raises(ValueError):
        clean.fit_limits(holes, ["a"], "magic")
    with pytest.raises(ValueError):
        scale.fit_scaler(holes, ["a"], "magic")


def test_limits_floor_and_identity(spark):
    df = spark.sql("SELECT * FROM VALUES (1D),(2D),(3D),(4D),(100D),(NULL) t(x)")
    assert clean.fit_limits(df, ["x", "gone"], "iqr_cap").bounds == {"x": (0.0, 7.0)}
    assert clean.limit_outliers(df, ["x"], "none") is not None
    assert sorted(column(clean.limit_outliers(df, ["x"], "iqr_cap").where("x > 3.5"), "x")) == [4.0, 7.0]


def test_scalers(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, 5D),(2D, 5D),(6D, 5D) t(x, c)")
    for kind, want in (("minmax", [0.0, 0.2, 1.0]), ("robust", [-0.4, 0.0, 1.6])):
        out, scaler = scale.scale(df, ["x", "c"], kind)
        assert column(out.orderBy("x"), "x") == pytest.approx(want)
        assert column(scaler.apply(df), "c") == [0.0] * 3
    out, _ = scale.scale(df, ["x"], "standard")
    assert sum(v * v for v in column(out, "x")) == pytest.approx(3)


def _nearest_by_hand(frame, names, k):
    x = frame[names].to_numpy(dtype=float)
    out = x.copy()
    for r in range(len(x)):
        for j in np.flatnonzero(np.isnan(x[r])):
            near = []
            for t in range(len(x)):
                both = ~np.isnan(x[r]) & ~np.isnan(x[t])
                if not np.isnan(x[t, j]) and both.any():
                    gap = ((x[r] - x[t])[both] ** 2).sum()
                    near.append((math.sqrt(gap * len(names) / both.sum()), x[t, j]))
            out[r, j] = np.mean([v for _, v in sorted(near)[:k]]) if near else np.nanmean(x[:, j])
    return out


@pytest.mark.parametrize("options", [{}, {"donor_rows": 0, "cell_rows": 15}, {"donor_rows": 0, "cell_rows": 500}])
def test_nearest_neighbours_equal_brute_force(spark, options):
    rng = np.random.default_rng(5)
    n, names = 240, ["a", "b", "c"]
    frame = pd.DataFrame(
        {"k": range(n), "a": rng.integers(0, 9, n) * 1.0, "b": rng.normal(0, 90, n).round(1), "c": rng.normal(0, 9, n)}
    )
    for c in names:
        frame.loc[rng.random(n) < 0.25, c] = np.nan
    frame.loc[: n // 3, names] = [3.0, np.nan, 5.0]  # a third of the rows alike
    df = spark.createDataFrame(frame).withColumns({c: F.nanvl(c, F.lit(None)) for c in names})
    got = knn.impute_nearest(df, names, 5, **options).orderBy("k").toPandas()[names].to_numpy()
    assert np.allclose(got, _nearest_by_hand(frame, names, 5))


def test_nearest_neighbours_hot_rows_survive_the_split(spark, monkeypatch):
    monkeypatch.setattr(knn, "HOT_SHARE", 0.2)
    monkeypatch.setattr(knn, "VISIT_ROWS", 3)
    frame = pd.DataFrame({"k": range(60), "a": [1.0] * 30 + [float(i) for i in range(30)], "b": [None] * 30 + [i * 2.0 for i in range(29)] + [None]})
    df = spark.createDataFrame(frame, "k long, a double, b double").withColumn("b", F.nanvl("b", F.lit(None)))
    got = knn.impute_nearest(df, ["a", "b"], 3, donor_rows=0, cell_rows=4).orderBy("k").toPandas()
    assert len(got) == 60 and set(got["b"][:30]) == {2.0} and got["b"][59] == pytest.approx(54.0)


def test_rows_inside_their_cell_ask_no_other(spark, monkeypatch):
    """Rows far from the walls of their cell are settled there, and the rest comes out as by hand."""
    rng, kept = np.random.default_rng(2), {}
    monkeypatch.setattr(knn, "stage", lambda df, name: kept.setdefault(name, stage(df, name)))
    frame = pd.DataFrame({"k": range(3000), "a": rng.uniform(0, 1e3, 3000), "b": rng.uniform(0, 1e3, 3000), "c": rng.normal(0, 9, 3000)})
    frame.loc[rng.random(3000) < 0.3, "c"] = np.nan
    df = spark.createDataFrame(frame).withColumn("c", F.nanvl("c", F.lit(None)))
    got = knn.impute_nearest(df, ["a", "b", "c"], 5, donor_rows=0, cell_rows=400).orderBy("k").toPandas()
    holes = int(frame["c"].isna().sum())
    asked = kept["home"].where("cell >= 0").select("row").distinct().count()
    assert 0 < asked < 0.6 * holes
    assert kept["home"].where("cell = -1").count() == holes - asked
    assert np.allclose(got[["a", "b", "c"]].to_numpy(), _nearest_by_hand(frame, ["a", "b", "c"], 5))


def test_nearest_neighbours_of_a_rare_column_a_lattice_and_a_row_that_shares_nothing(spark):
    rng, n, names = np.random.default_rng(3), 300, ["a", "b", "c", "d"]
    frame = pd.DataFrame({"k": range(n), "a": rng.integers(0, 4, n) * 1.0, "b": rng.integers(0, 300, n) * 1.0, "c": np.nan, "d": rng.normal(0, 5, n)})
    frame.loc[[5, 90, 200], "c"] = [1.0, 2.0, 4.0]  # most cells hold none of them
    frame.loc[rng.random(n) < 0.3, "d"] = np.nan
    frame.loc[rng.random(n) < 0.3, "b"] = np.nan
    frame.loc[[7, 8], names] = np.nan
    df = spark.createDataFrame(frame).withColumns({c: F.nanvl(c, F.lit(None)) for c in names})
    got = knn.impute_nearest(df, names, 2, donor_rows=0, cell_rows=20).orderBy("k").toPandas()[names].to_numpy()
    assert np.allclose(got, _nearest_by_hand(frame, names, 2))


def test_nearest_neighbours_of_infinite_readings(spark):
    frame = pd.DataFrame({"k": range(6), "a": [1.0, 2.0, np.inf, np.inf, -np.inf, 3.0], "b": [5.0, 7.0, 9.0, None, None, None], "c": [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]})
    df = spark.createDataFrame(frame).withColumn("b", F.nanvl("b", F.lit(None)))
    for options in ({}, {"donor_rows": 0, "cell_rows": 2}):
        got = knn.impute_nearest(df, ["a", "b", "c"], 1, **options).orderBy("k").toPandas()["b"].tolist()
        assert got == [5.0, 7.0, 9.0, 9.0, 7.0, 7.0]  # the opposite infinity has no neighbour and gets the mean


# --- profile and cohort ----------------------------------------------------------------------


def test_exact_cuts_read_the_hash_from_a_kept_column(spark, monkeypatch):
    """The passes of the fit see a plain column, and nothing stays cached."""
    plans, real = [], folds.fit_quantiles
    monkeypatch.setattr(folds, "fit_quantiles", lambda df, specs, **o: plans.append(df.storageLevel.useMemory) or real(df, specs, **o))
    df = spark.range(900).selectExpr("id", "CAST(id % 3 = 0 AS INT) AS y")
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    got = folds.stratified_folds(df, "id", "y", 3, 5, map_limit=0, pick_limit=20).groupBy("y", "fold").count().collect()
    assert plans == [True] and sorted(r["count"] for r in got) == [100] * 3 + [200] * 3
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_summary_of_degenerate_columns(spark):
    df = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS DOUBLE), 3D), (1, NULL, double('NaN')) t(c, n, x)")
    got = {r.feature: r for r in profile.summary_statistics(df, ["c", "n", "x"]).collect()}
    assert (got["c"].std, got["c"].skewness, got["c"].present) == (0.0, None, 2)
    assert (got["n"].mean, got["n"].median, got["n"].null_count) == (None, None, 2)
    assert (got["x"].present, got["x"].std, got["x"].null_pct) == (1, None, 50.0)


def test_moments_match_the_built_in_functions(numbers):
    df, frame = numbers
    row = profile.summary_statistics(df, ["skewed"], 6).first()
    want = df.agg(F.skewness("skewed").alias("s"), F.kurtosis("skewed").alias("k"), F.stddev("skewed").alias("d")).first()
    assert (row.skewness, row.kurtosis, row["std"]) == (
        pytest.approx(want.s, abs=1e-5), pytest.approx(want.k, abs=1e-5), pytest.approx(want.d, abs=1e-5)
    )


def test_histogram_counts_every_present_value(numbers):
    df, frame = numbers
    got = cohort.histogram(df, ["smooth", "few", "same"], 28).toPandas()
    for c in ("smooth", "few", "same"):
        want, edges = np.histogram(frame[c].dropna(), bins=28)
        part = got[got.field == c].sort_values("bin_no")
        assert list(part.records) == list(want)
        assert np.allclose(part.start, edges[:-1]) and np.allclose(part.end, edges[1:])


def test_folded_tail_keeps_the_total(spark):
    df = spark.sql("SELECT explode(split('aaabbcd', '')) AS c")
    got = cohort.folded_categories(df, "c").orderBy("place").collect()
    assert [(r.c, r.records) for r in got] == [("a", 3), ("b", 2), ("Other", 2)]
    small = cohort.folded_categories(df.where("c < 'c'"), "c").orderBy("place").collect()
    assert [(r.c, r.records) for r in small] == [("a", 3), ("b", 2)]


def test_a_forced_second_round_of_many_quantiles(spark):
    df = spark.range(50_000).selectExpr("cast(xxhash64(id) % 30000 as double) AS x", "if(id < 20000, 3.0D, double(id)) AS z")
    probs = [i / 199 for i in range(200)]
    whole = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in "xz"]).first()
    found = quantiles.column_quantiles(df, ["x", "z"], probs, map_limit=0, pick_limit=3)
    for c in "xz":
        assert found[c].values == pytest.approx(whole[c])


def test_ordinal_levels_fold_and_null_stays_out(spark):
    df = spark.range(80).selectExpr("id % 8 AS v").unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = cohort.ordinal_counts(df, "v").collect()
    assert [(r.level, r.records) for r in got] == [("0", 10), ("1", 10), ("2", 10), ("3", 10), ("3 or more", 40)]
    rates = cohort.rate_by_level(df.selectExpr("cast(v as string) v", "1 y"), "v", "y", ["7", "9"]).collect()
    assert [(r.level, r.positive_rate) for r in rates] == [("7", 1.0), ("9", None)]


def test_sample_is_exact_and_repeatable(numbers):
    df, _ = numbers
    take = lambda seed: sorted(column(cohort.scatter_sample(df, "k", ["hot"], "y", 100, seed), "k"))
    assert len(take(7)) == 100 and take(7) == take(7) and take(7) != take(8)
    assert cohort.scatter_sample(df, "k", ["hot"], "y", 10_000).count() == 3000


def test_spikes_at_the_limits_of_share_and_gap(spark):
    # of 1000 rows a quarter is positive; -1 holds exactly 5 % and lies exactly 0.25 above, -2 holds 4.9 %
    df = spark.sql("""SELECT CASE WHEN id < 50 THEN -1.0D WHEN id < 99 THEN -2.0D ELSE double(id) END AS x,
        CASE WHEN id < 50 THEN id % 2 WHEN id < 99 THEN 0 ELSE int(id < 324) END AS y FROM range(1000)""")
    assert df.agg(F.avg("y")).first()[0] == 0.25
    (found,) = cohort.label_spikes(df, ["x", "absent"], "y").collect()
    assert (found.field, found.value, found.records, found.positive_rate) == ("x", -1.0, 50, 0.5)
    assert not cohort.label_spikes(df, ["x"], "y", min_gap=0.26).count()
    assert {r.value for r in cohort.label_spikes(df, ["x"], "y", min_share=0.049).collect()} == {-1.0, -2.0}
    rare = cohort.label_spikes(df, ["x"], "y", min_share=0.0005, min_gap=0.7)
    assert rare.count() == 225 and rare.agg(F.min("value")).first()[0] == 99.0
    assert not cohort.label_spikes(df.where("x is null"), ["x"], "y").count()


def test_bands_share_ties_and_cover_all_rows(numbers):
    df, frame = numbers
    got = cohort.rate_by_band(df, "hot", "y").orderBy("band_no").toPandas()
    assert got.records.sum() == len(frame)
    cut = pd.qcut(frame.hot, 5, duplicates="drop")
    want = frame.groupby(cut, observed=True).y.agg(["mean", "size"])
    assert list(got.records) == list(want["size"]) and np.allclose(got.positive_rate, want["mean"])
    assert list(got.band) == [f"{e.left:.0f} to {e.right:.0f}" for e in want.index]


def test_curve_ends_at_one_with_unique_values(numbers):
    df, _ = numbers
    got = cohort.cumulative_distribution(df, "few").toPandas()
    assert got.share.max() == 1.0 and got.value.is_unique


@pytest.mark.parametrize("bucket_rows", [None, 80])
def test_percentile_of_values_outside_the_cohort(spark, numbers, bucket_rows):
    df, frame = numbers
    records = spark.createDataFrame([(1, -1e9), (2, 7.5), (3, 1e9), (4, None), (5, 7.123)], "k int, hot double")
    got = dict(column(cohort.percentile_lookup(records, df, "hot", bucket_rows=bucket_rows), "k", "percentile"))
    assert got[1] == 0.0 and got[3] == 1.0 and got[4] is None
    assert got[2] == pytest.approx((frame.hot <= 7.5).mean()) and got[5] == pytest.approx((frame.hot <= 7.123).mean())


def test_duplicates_count_all_but_the_first(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL),(1, NULL),(1, NULL),(2, 0),(2, 1) t(a, Age)")
    row = cohort.duplicate_report(df, CLINICAL).first()
    assert (row.duplicate_rows, row.missing_cells, row.impossible_zeros) == (2, 3, 1)


def test_duplicates_of_whole_rows_with_odd_values(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 0D), ('a', -0D), ('b', double('NaN')), ('b', double('NaN')), (NULL, 1D), (NULL, 1D), ('', 1D) t(s, x)")
    assert cohort.duplicate_report(df, CLINICAL).first().duplicate_rows == 3
    assert cohort.duplicate_report(df.where("s = 'none'"), CLINICAL).first().duplicate_rows is None


def test_correlation_of_many_columns_is_one_scan(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(moments, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(size=(500, 30)) * rng.uniform(0.1, 1e3, 30) + 1e6, columns=[f"c{i}" for i in range(30)])
    frame["c1"] = frame["c0"] * -2 + rng.normal(size=500)
    frame = frame.mask(rng.random(frame.shape) < 0.3)
    frame["same"], frame["none"], frame["n"] = 0.1, np.nan, np.arange(500)
    frame.loc[100:, "c2"] = 7.25  # constant wherever c3 is present
    frame.loc[:99, "c3"] = np.nan
    spark.createDataFrame(frame).repartition(5).write.parquet(f"{tmp_path}/wide")
    got = profile.correlation(spark.read.parquet(f"{tmp_path}/wide"), list(frame.columns), 9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    want = frame.corr()
    found = {(r.row_field, r.column_field): r.correlation for r in got.collect()}
    assert len(found) == len(frame.columns) ** 2
    for (a, b), r in found.items():
        if a == b or "same" in (a, b) or "none" in (a, b) or {a, b} == {"c2", "c3"}:
            varies = a == b and a not in ("same", "none")
            assert r == (1.0 if varies else None)
        else:
            assert r == pytest.approx(want.loc[a, b], abs=2e-8)


# --- evaluation and folds --------------------------------------------------------------------


def test_average_precision_is_a_step_sum(spark):
    df = spark.sql("SELECT * FROM VALUES (.9D,1),(.8D,0),(.7D,1),(.7D,0),(.3D,1),(.2D,0) t(p, y)")
    for buckets in (None, 2):
        row = evaluate.ranking_scores(df, "y", ["p"], buckets).first()
        assert row.pr_auc == pytest.approx(0.7) and row.roc_auc == pytest.approx(0.6111, abs=1e-4)


def test_threshold_with_ties_across_the_floor_and_without_scores(spark):
    # three of four positives share the score 0.5 with two negatives: a threshold takes all five or none
    rows = [(0.9, 1), (0.5, 1), (0.5, 1), (0.5, 1), (0.5, 0), (0.5, 0), (0.1, 0), (0.1, 0)]
    df = spark.createDataFrame(rows, "p double, y int")
    best = evaluate.best_threshold(df, "y", "p", 0.5).first()
    assert best.recall == 1.0 and 0.1 < best.threshold <= 0.5
    above = evaluate.confusion(df, "y", "p", 0.91).first()
    assert (above.tn, above.fp, above.fn, above.tp) == (4, 0, 4, 0)
    assert evaluate.scores_at(df, "y", "p", 0.91).first().precision == 0.0


def test_split_and_folds_have_exact_class_sizes(spark):
    df = spark.range(768).selectExpr("id", "cast(id < 268 as int) AS y")
    for limits in ({}, {"map_limit": 0}):
        split = folds.stratified_split(df, "id", "y", **limits)
        sizes = {(r.y, r.part): r["count"] for r in split.groupBy("y", "part").count().collect()}
        assert sizes == {(0, "test"): 100, (0, "train"): 400, (1, "test"): 54, (1, "train"): 214}
    drawn = folds.stratified_folds(df, "id", "y")
    counts = drawn.groupBy("y", "fold").count().toPandas()
    assert set(counts[counts.y == 0]["count"]) == {50} and set(counts[counts.y == 1]["count"]) == {26, 27}
    again = folds.stratified_folds(df.repartition(5), "id", "y")
    assert drawn.exceptAll(again).isEmpty()


# --- sources ---------------------------------------------------------------------------------


def test_contract_round_trip_and_roles():
    schema = CLINICAL.struct()
    assert Contract.from_struct(schema, "Outcome").features == CLINICAL.features
    assert CLINICAL.disguised == ["Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI"]
    assert "Pregnancies" not in CLINICAL.positive_minimum


def test_csv_is_typed_by_name_and_gated(spark, tmp_path):
    contract = Contract((Field("a", "int", 0, 9), Field("b", "float", 0.5, 2.0, zero_valid=False)), Field("t", "binary"))
    path = tmp_path / "in.csv"
    path.write_text("t,b,extra,a\n1,0,x,3\n0,,y,4\n")
    df = readers.read_table(spark, [str(tmp_path / "none.csv"), str(path)], contract)
    assert dict(df.dtypes) == {"t": "int", "b": "double", "extra": "string", "a": "bigint"}
    assert gate.require_schema(df, contract)
    assert rows(readers.modelling_frame(df, contract)) == [(3, None, 1), (4, None, 0)]
    assert rows(gate.conformance(df, contract)) == [("a", 0, 0, 0, 0), ("b", 1, 0, 0, 1), ("t", 0, 0, 0, 0)]
    for bad in (df.drop("a"), df.where("false"), df.withColumn("t", F.lit(2)), df.withColumn("t", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            gate.require_schema(bad, contract)
    with pytest.raises(ValueError):
        gate.require_complete(df)
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, str(tmp_path / "none.csv"), contract)


def test_file_digest(spark, tmp_path):
    import hashlib

    (tmp_path / "f.bin").write_bytes(b"some bytes" * 1000)
    want = hashlib.sha256(b"some bytes" * 1000).hexdigest()
    assert column(readers.file_digests(spark, str(tmp_path)), "sha256") == [want]
    readers.require_digest(spark, str(tmp_path), want)
    with pytest.raises(ValueError):
        readers.require_digest(spark, str(tmp_path), "0" * 64)


def test_generated_records_obey_the_contract(spark):
    df = synthetic.synthetic_table(spark, CLINICAL, 400)
    assert df.count() == 400
    for r in gate.conformance(df, CLINICAL).collect():
        assert (r.below_min, r.above_max, r.outside_domain, r.missing) == (0, 0, 0, 0)
    assert df.exceptAll(synthetic.synthetic_table(spark, CLINICAL, 400)).isEmpty()
    made, source = readers.load_first(spark, [("x", "/nowhere", "parquet")], lambda: df)
    assert source == "generated" and made is df


def test_csv_sink_reads_back(spark):
    df = spark.range(5).selectExpr("id", "id / 2 AS half")
    path = sinks.write_table(df, new_path(spark, "csv"), "csv")
    assert rows(readers.read_table(spark, path).orderBy("id")) == rows(df.orderBy("id"))


# --- plans -----------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fitted_transforms_add_no_shuffle_and_no_python(numbers):
    df, _ = numbers
    out = clean.fit_limits(clean.fit_group_median(df, ["smooth"], "y").apply(df), ["smooth"]).apply(df)
    text = plan(scale.scale(out, ["smooth"])[0])
    assert "Exchange" not in text and "Python" not in text


def test_profile_shuffles_aggregates_only(numbers):
    df, _ = numbers
    text = plan(profile.summary_statistics(df, ["smooth", "hot"]))
    assert text.count("Exchange") == 1 and "partial_" in text and "Window" not in text


def test_ranking_never_orders_raw_rows_in_one_task(numbers):
    df, _ = numbers
    table = ranks.value_weights(df, {"hot": F.col("hot")}, {"n": F.lit(1)})
    text = plan(ranks.running_totals(table, ["n"], {"hot": 10}))
    assert "SinglePartition" not in text and "hashpartitioning(feature" in text


def test_nan_is_missing_everywhere(spark):
    """A NaN reads as NULL does: nothing is limited, banded, scored or counted as present."""
    df = spark.createDataFrame(
        [(1, float("nan"), 0, 1), (2, None, 0, 0), (3, 0.0, 1, 0), (4, 4.0, 1, 1), (5, 8.0, 1, 1)],
        "k long, x double, g int, n int",
    )
    x = F.col("x")
    exprs = {
        "clip": clip(x, 1.0, 6.0), "zero": zero_to_null(x), "band": band(x, [3.0], ["low", "high"]),
        "ratio": ratio(x, F.lit(2)), "interval": interval_number(x, [0.0, 4.0, 9.0]), "points": points({"x": 6}),
    }
    got = [r.asDict() for r in df.orderBy("k").select(*[e.alias(n) for n, e in exprs.items()]).collect()]
    assert got[0] == got[1] == {"clip": None, "zero": None, "band": None, "ratio": None, "interval": None, "points": 0}
    assert got[4] == {"clip": 6.0, "zero": 8.0, "band": "high", "ratio": 4.0, "interval": 2, "points": 1}
    for strategy, fill in (("median", 4.0), ("mean", 4.0), ("median_by_group", 4.0)):
        assert column(clean.impute(df, strategy, ["x"], by="g").orderBy("k"), "x")[:2] == [fill, fill]
    assert clean.columns_with_missing(df, ["x", "n"]) == ["x"]
    missing = {r["feature"]: r["missing_count"] for r in profile.missingness(df, []).collect()}
    assert missing == {"k": 0, "x": 2, "g": 0, "n": 0}
    assert column(profile.missing_share(df, ["x"]), "missing_pct") == [40.0]
    assert dict(rows(cohort.completeness(df).where("field = 'x'"))) == {"x": 0.6}
    with pytest.raises(ValueError, match="missing cells"):
        gate.require_complete(df, ["x"])


def test_rows_without_a_label_take_no_part_in_ranking(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.5, None), (0.7, None), (0.2, 0)], "s double, y int")
    assert column(evaluate.average_precision(df, "y", "s"), "pr_auc") == [1.0]
    assert column(evaluate.roc_auc(df, "y", "s"), "roc_auc") == [1.0]


def test_density_keeps_its_error_bound_on_far_and_repeated_readings(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1, 700), np.full(200, 2.5), rng.normal(60, 0.1, 99), [900.0]])
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)] + [(None, 0), (float("nan"), 1)], "v double, y int")
    width = values.std(ddof=1) * len(values) ** -0.2
    for tolerance in (1e-4, 1e-16):
        rows = density.density(df, ["v"], tolerance=tolerance).orderBy("point_no").collect()
        x = np.array([r["x"] for r in rows])
        plain = np.exp(-(((x[:, None] - values) / width) ** 2) / 2).mean(axis=1) / (width * math.sqrt(2 * math.pi))
        error = np.abs(np.array([r["density"] for r in rows]) - plain).max() * width * math.sqrt(2 * math.pi)
        assert len(rows) == density.GRID_POINTS and error < max(tolerance, 1e-15)


def test_density_sums_boxes_before_points_are_touched(spark):
    df = spark.range(4000).select((F.col("id") / 7).alias("v"), (F.col("id") % 2).cast("int").alias("y"))
    steps = density.density(df, ["v"], "y", (0, 1))._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = lambda word: next(i for i, line in enumerate(steps) if word in line)
    assert at("Generate explode(CASE") < at(", box#") < at("Generate inline")  # from the top of the plan down
    assert density.density(df.limit(1), ["v"]).isEmpty() and density.density(df.where("v < 0"), ["v"]).isEmpty()


def test_wide_profiles_take_one_scan_beside_the_quantiles(spark):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({f"c{i}": rng.gamma(1 + i % 4, 10.0**(i % 5), 300) + 1e6 * (i % 3) for i in range(40)})
    data = data.mask(rng.random(data.shape) < 0.1).assign(none=np.nan, same=4.0, y=np.arange(300) % 3)
    df = spark.createDataFrame(data)
    columns = [c for c in data.columns if c != "y"]
    summary = profile.summary_statistics(df, columns, 6)
    boxes = profile.box_statistics(df, columns, "y", (0, 1, 5))
    for table in (summary, boxes):
        text = table._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("MapInArrow") == 1
    rows = summary.collect()
    assert sorted(r.feature for r in rows) == sorted(columns)
    for r in rows:
        x = data[r.feature].dropna()
        assert r.present == len(x) and r.null_count == 300 - len(x)
        if r.feature == "none":
            assert r.mean is None and r.min is None and r.skewness is None
            continue
        assert r.mean == pytest.approx(x.mean(), abs=1e-5) and r.std == pytest.approx(x.std(), abs=1e-5)
        if r.feature == "same":
            assert r.std == 0 and r.skewness is None and r.kurtosis is None
            continue
        z = (x - x.mean()) / x.std(ddof=0)
        assert r.skewness == pytest.approx((z**3).mean(), rel=1e-5, abs=1e-5)
        assert r.kurtosis == pytest.approx((z**4).mean() - 3, rel=1e-5, abs=1e-5)
    for r in boxes.collect():
        x = data[data.y == r.y][r.field].dropna()
        if not len(x):
            assert r.q1 is None and r.mean is None and r.outliers == 0
            continue
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        kept = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r.lower, r.upper, r.min, r.max) == (kept.min(), kept.max(), x.min(), x.max())
        assert r.outliers == len(x) - len(kept) and r.mean == pytest.approx(x.mean())
    empty = profile.summary_statistics(df.where("false"), ["c0"]).collect()
    assert [(r.present, r.null_count, r["mean"], r.zero_pct) for r in empty] == [(0, 0, None, None)]
