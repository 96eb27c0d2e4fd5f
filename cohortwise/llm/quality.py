"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Statistics come from every whole text. The estimate is the minimum covariance determinant: the mean and
covariance of the ``COVERAGE`` share of a group's rows whose covariance has the smallest determinant. It is
sought first inside cells of bounded size (many random starts each, on separate workers); the best cell's
answer is then improved by concentration steps over all rows of the group. A step is one aggregation:
distances are binned finely on a logarithmic scale, each bin keeps its count and moments, and the bins up to
the wanted share give the next mean and covariance. No group, however large, is gathered anywhere.

Defined cases: a null or empty text has zero words and fails the base rules; null ``lang`` or ``source`` are
values of their own; groups below ``MIN_GROUP`` rows are pooled by language, pools below it are pooled together,
and if even these are fewer they are judged by the estimate of the whole table. Only where the whole table has
fewer than ``LEAST_ROWS`` rows, too few for a covariance, are rows left unjudged: kept, with a null distance.
Repeated rows get one answer each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import BATCH_ROWS, arrow_rows, if_small, texts_of

MIN_WORDS = 20
#: Percent of words that may lie in repeated windows.
MAX_REPEATED = 30
WINDOW = 8
MIN_GROUP = 100
LEAST_ROWS = 18
#: Rows of a cell in which random starts are tried.
CELL_ROWS = 2000
STARTS = 16
COVERAGE = 0.75
#: A group is settled when its log determinant falls by less than this.
TOLERANCE = 1e-3
#: A row is rejected if its squared distance is beyond this quantile of chi-squared.
CONFIDENCE = 1 - 1e-5

#: Logarithms of sizes, and arcsines of the roots of shares, whose spread does not depend on their mean.
FEATURES = ("log_words", "log_word_length", "symbols", "repeated_lines", "repeated_words", "upper_case", "echoes", "digits")
#: Differences below these are no differences: their squares are added to the variances.
FLOORS = (0.25, 0.06, 0.04, 0.2, 0.2, 0.06, 0.06, 0.1)
P = len(FEATURES)

#: The group of all rows.
WHOLE = "all"

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_BINS_PER_OCTAVE, _LOWEST = 16, -12.0
_SYMBOLS = b"#*$%&|<>"
#: Words by which markup sets columns, headings, list items and quotations: no noise, so no part of the features of symbols and word length.
_LAYOUT = (b"|", b"#", b"*", b">")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"


def _repeated_words(words: list[bytes]) -> int:
    """Words in windows found twice or more; hashes point to them, the words themselves decide."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    hashes = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + (codes[k : k + n] + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    flagged = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))].tolist()
    windows = [tuple(codes[i : i + WINDOW].tolist()) for i in flagged]
    counts = Counter(windows)
    covered = np.zeros(len(words), bool)
    for i, w in zip(flagged, windows, strict=True):
        if counts[w] > 1:
            covered[i : i + WINDOW] = True
    return int(covered.sum())


def statistics_of(data: bytes | None) -> tuple[int, ...]:
    """The five reported numbers, then lines with a word, capitals, words equal to the one before, digits, layout marks."""
    if not data:
        return (0,) * 10
    words = data.split()
    joined = b"".join(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(data) - len(data.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        len(data) - len(data.translate(None, _UPPER)),
        sum(map(operator.eq, words, words[1:])),
        len(data) - len(data.translate(None, _DIGITS)),
        sum(map(words.count, _LAYOUT)),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the reported statistics, ``base_failed`` and the feature columns."""

    def run(batches):
        for batch in batches:
            table = np.array([statistics_of(t) for t in texts_of(batch)], np.int64).reshape(-1, 10)
            n, chars, symbols, dup, rep, lines, upper, echoes, digits, marks = table.T
            features = (
                np.log1p(n),
                np.log(np.maximum(chars - marks, 1) / np.maximum(n - marks, 1)),
                *(
                    np.arcsin(np.sqrt(np.minimum(1.0, part / np.maximum(whole, 1))))
                    for part, whole in ((symbols - marks, chars), (dup, lines), (rep, n), (upper, chars), (echoes, n), (digits, chars))
                ),
            )
            failed = (n < MIN_WORDS) | (100 * rep > MAX_REPEATED * n)
            columns = [batch.column(c) for c in ("doc_id", "lang", "source")]
            columns += [pa.array(x) for x in (n, chars, symbols, dup, rep, failed, *features)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = f"doc_id {types['doc_id']}, lang string, source string, {STATS}, base_failed boolean, "
    schema += ", ".join(f"{c} double" for c in FEATURES)
    names = [part.split()[0] for part in schema.split(", ")]
    picked = docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    return picked.mapInArrow(run, schema)


def chi2_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi2_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, degrees) < share else (low, mid)
    return high


def _invert(center: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], float]:
    cov = cov + np.diag(np.square(FLOORS))
    return center.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def fast_mcd(x: np.ndarray, seed: int) -> tuple[list[float], list[float], float]:
    """Centre, precision matrix and log determinant of the best subset found in a bounded cell."""
    n = len(x)
    h = min(n, max(P + 2, math.ceil(COVERAGE * n)))
    ridge = np.diag(np.square(FLOORS))
    rng = np.random.default_rng(seed)

    def step(rows):
        center, cov = x[rows].mean(0), np.cov(x[rows].T, bias=True) + ridge
        gap = x - center
        distance = np.einsum("ij,ij->i", gap @ np.linalg.inv(cov), gap)
        return np.argsort(distance, kind="stable")[:h], np.linalg.slogdet(cov)[1]

    tried = []
    for _ in range(STARTS):
        rows = rng.choice(n, min(n, P + 2), replace=False)
        for _ in range(3):
            rows, _ = step(rows)
        tried.append((step(rows)[1], rows))
    best = None
    for _, rows in sorted(tried, key=lambda t: t[0])[:4]:
        value = math.inf
        for _ in range(50):
            following, found = step(rows)
            if found >= value - 1e-9:
                break
            rows, value = following, found
        if best is None or value < best[0]:
            best = (value, rows)
    rows = best[1]
    return _invert(x[rows].mean(0), np.cov(x[rows].T, bias=True))


_ESTIMATE = "grp string, center array<double>, precision array<double>, logdet double"


def _first_estimates(rows: DataFrame) -> DataFrame:
    """Per group the answer of the cell with the smallest determinant."""

    def cell(key, frame):
        frame = frame.sort_values("doc_id", kind="stable")
        x = frame[list(FEATURES)].to_numpy(float)
        center, precision, logdet = fast_mcd(x, seed=int(key[1]) + 1)
        return pd.DataFrame([(key[0], center, precision, logdet)], columns=["grp", "center", "precision", "logdet"])

    cells = rows.groupBy("grp", "cell").applyInPandas(cell, _ESTIMATE)
    return cells.groupBy("grp").agg(F.min_by(F.struct("center", "precision", "logdet"), "logdet").alias("e")).select("grp", "e.*")


def squared_distance():
    """Mahalanobis distance from the columns ``center`` and ``precision``, unrolled into plain arithmetic."""
    gap = [F.col(c) - F.col("center")[i] for i, c in enumerate(FEATURES)]
    total = None
    for i in range(P):
        for j in range(i, P):
            term = gap[i] * gap[j] * F.col("precision")[i * P + j] * (1.0 if i == j else 2.0)
            total = term if total is None else total + term
    return F.when(total.isNotNull(), F.greatest(total, F.lit(0.0)))


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step over all rows: the moments of each group's nearest share become its next estimate."""
    near = rows.join(if_small(estimates), "grp").withColumn("d2", squared_distance())
    position = F.floor((F.log2(F.col("d2") + 2.0**_LOWEST) - _LOWEST) * _BINS_PER_OCTAVE)
    sums = [F.count(F.lit(1)).alias("n"), F.first("logdet").alias("was")]
    sums += [F.sum(c).alias(f"s{i}") for i, c in enumerate(FEATURES)]
    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}_{j}") for i, j in pairs]
    bins = near.groupBy("grp", position.cast("int").alias("bin")).agg(*sums)

    def refit(key, frame):
        frame = frame.sort_values("bin")
        total = frame["n"].sum()
        inside = frame[frame["n"].cumsum() - frame["n"] < COVERAGE * total]
        n = inside["n"].sum()
        center = np.array([inside[f"s{i}"].sum() / n for i in range(P)])
        cov = np.empty((P, P))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = inside[f"q{i}_{j}"].sum() / n - center[i] * center[j]
        values, vectors = np.linalg.eigh(cov)  # rounding may leave a tiny negative variance
        cov = (vectors * np.maximum(values, 0)) @ vectors.T
        columns = ["grp", "center", "precision", "logdet", "was"]
        return pd.DataFrame([(key[0], *_invert(center, cov), frame["was"].iloc[0])], columns=columns)

    return bins.groupBy("grp").applyInPandas(refit, f"{_ESTIMATE}, was double")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Estimates per group, after concentration steps until no determinant falls any more.

    A group whose determinant does not fall keeps the estimate it had and takes no part in later steps. Every
    other group's falls by ``TOLERANCE`` at least and is bounded below by ``FLOORS``, so the steps come to an end.
    """
    current = stage(_first_estimates(rows), "mcd")
    settled = []
    while True:
        following = stage(_concentrate(rows, current), "mcd")
        falling = F.coalesce(F.col("logdet") < F.col("was") - TOLERANCE, F.lit(False))
        settled.append(current.join(if_small(following.where(~falling).select("grp")), "grp", "left_semi"))
        current = following.where(falling).drop("was")
        if not current.limit(1).count():
            return stage(reduce(DataFrame.unionByName, settled), "mcd")


def _groups(stats: DataFrame) -> DataFrame:
    """For every lang and source: ``grp``, the group it is judged by, and ``grp_n``, the rows that group is fitted on."""
    fine = F.count(F.when(~F.col("base_failed"), 1))
    sizes = stage(stats.groupBy("lang", "source").agg(fine.alias("n")), "sizes")
    small = sizes.where(F.col("n") < MIN_GROUP)
    pools = small.groupBy("lang").agg(F.sum("n").alias("pool_n")).withColumnRenamed("lang", "pool")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    others = pools.where(F.col("pool_n") < MIN_GROUP).agg(F.sum("pool_n")).first()[0] or 0
    if others >= MIN_GROUP:
        last, last_n = "rest", others
    else:
        last, last_n = (WHOLE, total) if total >= LEAST_ROWS else (None, 0)
    by_both = F.concat(F.lit("s"), F.to_json(F.struct("lang", "source")))
    by_language = F.concat(F.lit("l"), F.to_json(F.struct("lang")))
    own, pool = F.col("n") >= MIN_GROUP, F.col("pool_n") >= MIN_GROUP
    joined = sizes.join(if_small(pools), F.col("lang").eqNullSafe(F.col("pool")), "left")
    grp = F.when(own, by_both).when(pool, by_language).otherwise(F.lit(last))
    grp_n = F.when(own, F.col("n")).when(pool, F.col("pool_n")).otherwise(F.lit(last_n))
    return joined.select(F.col("lang").alias("own_lang"), F.col("source").alias("own_source"), grp.alias("grp"), grp_n.alias("grp_n"))


def judge(docs: DataFrame) -> DataFrame:
    """Statistics, ``base_failed``, ``kept`` and the scaled squared ``distance`` of every document."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        stats = stage(text_statistics(docs), "quality")
    groups = stage(_groups(stats), "groups")
    same = F.col("lang").eqNullSafe(F.col("own_lang")) & F.col("source").eqNullSafe(F.col("own_source"))
    keyed = stats.join(if_small(groups), same, "left")
    fine = keyed.where(~F.col("base_failed"))
    fitted = fine.where((F.col("grp") != WHOLE))
    if whole := groups.where(F.col("grp") == WHOLE).first():  # rows of all groups
        fitted = fitted.unionByName(fine.withColumns({"grp": F.lit(WHOLE), "grp_n": F.lit(whole["grp_n"])}))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(1000003)) % F.ceil(F.col("grp_n") / CELL_ROWS)
    estimates = robust_estimates(fitted.select("grp", cell.alias("cell"), "doc_id", *FEATURES))
    scale = COVERAGE / chi2_cdf(chi2_quantile(COVERAGE, P), P + 2)  # makes the subset's covariance unbiased
    limit = chi2_quantile(CONFIDENCE, P)
    judged = keyed.join(if_small(estimates), "grp", "left").withColumn("distance", squared_distance() / scale)
    kept = ~F.col("base_failed") & (F.col("distance").isNull() | (F.col("distance") <= limit))
    names = [part.split()[0] for part in STATS.split(", ")]
    return judged.select("doc_id", *names, "base_failed", kept.alias("kept"), F.round("distance", 6).alias("distance"))
