"""The registered queries once more, as SQL over the same tables, for comparison in another engine."""

from __future__ import annotations

COLUMNS = ["n_lines", "max_price", "min_disc", "min_tax", "qty", "total"]
HIDDEN = ["max_price", "min_disc", "min_tax", "qty"]
CAPPED = ["max_price", "min_disc", "min_tax", "qty", "total"]
RANGES = {
    "n_lines": (0, 10),
    "max_price": (900.0, 100000.0),
    "min_disc": (0.01, 0.1),
    "min_tax": (0.01, 0.08),
    "qty": (1.0, 300.0),
    "total": (1000.0, 450000.0),
}

RAW = """raw AS (
  SELECT o.o_orderkey AS pid, count(l.l_orderkey) AS n_lines,
         coalesce(max(l.l_extendedprice), 0) AS max_price, coalesce(min(l.l_discount), 0) AS min_disc,
         coalesce(min(l.l_tax), 0) AS min_tax, coalesce(sum(l.l_quantity), 0) AS qty,
         max(o.o_totalprice) AS total,
         CAST(max(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS INT) AS outcome
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey)"""

READ = RAW + """, c AS (
  SELECT pid, n_lines, nullif(max_price, 0) AS max_price, nullif(min_disc, 0) AS min_disc,
         nullif(min_tax, 0) AS min_tax, nullif(qty, 0) AS qty, total, outcome FROM raw)"""


def _list(template: str, columns=COLUMNS, sep=", ") -> str:
    return sep.join(template.format(c=c) for c in columns)


def _union(template: str, columns=COLUMNS) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


FILLED = (
    READ
    + f""", med AS (SELECT outcome AS y, {_list("quantile_cont({c}, 0.5) AS m_{c}", HIDDEN)} FROM c GROUP BY outcome),
f AS (SELECT pid, n_lines, {_list("coalesce({c}, m_{c}) AS {c}", HIDDEN)}, total, outcome
      FROM c JOIN med ON c.outcome = med.y)"""
)

CLEAN = (
    FILLED
    + f""", lim AS (SELECT {_list("quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}", CAPPED)} FROM f),
w AS (SELECT pid, n_lines, {_list("CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END AS {c}", CAPPED)},
      outcome FROM f, lim)"""
)

FEATURES = CLEAN + """, e AS (SELECT *,
  CASE WHEN max_price <= 30000 THEN 'Low' WHEN max_price <= 50000 THEN 'Normal'
       WHEN max_price <= 60000 THEN 'High' WHEN max_price IS NOT NULL THEN 'Extreme' END AS price_band,
  CASE WHEN qty <= 60.5 THEN 'Few' WHEN qty <= 120 THEN 'Some' WHEN qty <= 600 THEN 'Many'
       WHEN qty IS NOT NULL THEN 'Flood' END AS qty_band,
  CASE WHEN n_lines = 0 THEN NULL ELSE qty / n_lines END AS qty_per_line,
  max_price * min_tax / 405.0 AS price_tax,
  (CASE WHEN max_price >= 50000 THEN 1 ELSE 0 END + CASE WHEN qty >= 120 THEN 1 ELSE 0 END
   + CASE WHEN total >= 250000 THEN 1 ELSE 0 END + CASE WHEN n_lines >= 5 THEN 1 ELSE 0 END) AS risk_score
  FROM w)"""

SCORED = RAW + ", s AS (SELECT pid, outcome, round(total / 500000, 3) AS score FROM raw)"

_HASH = "CAST(('0x' || substr(md5(concat(pid, '|{seed}|{tag}')), 1, 13)) AS BIGINT)"


def _hash(seed: int, tag: str) -> str:
    return _HASH.format(seed=seed, tag=tag)


def _rounded(columns=COLUMNS) -> str:
    return _list("round({c}, 6) AS {c}", columns)


def _frame(source: str) -> str:
    return f"SELECT pid, n_lines, {_rounded(CAPPED)}, outcome FROM {source}"


def _tall(source: str, columns=COLUMNS, extra: str = "pid, outcome") -> str:
    return _union(f"SELECT {extra}, '{{c}}' AS field, CAST({{c}} AS DOUBLE) AS x FROM {source}", columns)


def _moments(source: str, columns: list[str]) -> str:
    """One row per column: raw moments give the biased skewness and excess kurtosis."""
    return _union(
        f"""SELECT '{{c}}' AS feature, count({{c}}) AS present, round(avg({{c}}), 3) AS mean,
        round(stddev_samp({{c}}), 3) AS std, round(CAST(min({{c}}) AS DOUBLE), 3) AS min,
        round(quantile_cont(CAST({{c}} AS DOUBLE), 0.25), 3) AS q25,
        round(quantile_cont(CAST({{c}} AS DOUBLE), 0.5), 3) AS median,
        round(quantile_cont(CAST({{c}} AS DOUBLE), 0.75), 3) AS q75,
        round(CAST(max({{c}}) AS DOUBLE), 3) AS max,
        round(avg(power({{c}} - mu_{{c}}, 3)) / power(avg(power({{c}} - mu_{{c}}, 2)), 1.5), 3) AS skewness,
        round(kurtosis_pop(CAST({{c}} AS DOUBLE)), 3) AS kurtosis,
        CAST(count(*) FILTER ({{c}} = 0) AS BIGINT) AS zero_count,
        round(100.0 * count(*) FILTER ({{c}} = 0) / count(*), 2) AS zero_pct,
        count(*) - count({{c}}) AS null_count,
        round(100.0 * (count(*) - count({{c}})) / count(*), 2) AS null_pct
        FROM {source}, mu""",
        columns,
    )


def _summary(prefix: str, source: str, columns: list[str]) -> str:
    means = ", ".join(f"avg({c}) AS mu_{c}" for c in columns)
    start = f"WITH {prefix}, " if prefix else "WITH "
    return f"{start}mu AS (SELECT {means} FROM {source}) {_moments(source, columns)}"


def _corr(columns: list[str], digits: int) -> str:
    parts = []
    for a in columns:
        for b in columns:
            value = "max(1.0)" if a == b else f"corr({a}, {b})"
            parts.append(
                f"SELECT '{a}' AS row_field, '{b}' AS column_field, round({value}, {digits}) AS correlation FROM c"
            )
    return f"WITH {READ} " + " UNION ALL ".join(parts)


def _ranked(source: str, value: str, name: str) -> str:
    return (
        f"CASE WHEN {value} IS NOT NULL THEN rank() OVER (PARTITION BY {value} IS NULL ORDER BY {value}) "
        f"+ (count(*) OVER (PARTITION BY {value}) - 1) / 2.0 END AS {name}"
    )


def _spearman() -> str:
    columns = [*COLUMNS, "outcome"]
    ranks = ", ".join(_ranked("f", c, f"r_{c}") for c in columns)
    parts = [
        f"SELECT '{a}' AS row_field, '{b}' AS column_field, "
        f"round({'max(1.0)' if a == b else f'corr(r_{a}, r_{b})'}, 6) AS correlation FROM r"
        for a in columns
        for b in columns
    ]
    return f"WITH {FILLED}, r AS (SELECT {ranks} FROM f) " + " UNION ALL ".join(parts)


def _spearman_pairwise() -> str:
    columns = ["max_price", "min_disc", "min_tax", "total"]
    parts = []
    for a in columns:
        for b in columns:
            if a == b:
                parts.append(f"SELECT '{a}' AS row_field, '{b}' AS column_field, 1.0 AS correlation")
                continue
            parts.append(
                f"SELECT '{a}' AS row_field, '{b}' AS column_field, round(corr(ra, rb), 6) AS correlation FROM ("
                f"SELECT {_ranked('c', a, 'ra')}, {_ranked('c', b, 'rb')} FROM c "
                f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            )
    return f"WITH {READ} " + " UNION ALL ".join(parts)


def _density(prefix: str, source: str, columns: list[str], by_class: bool) -> str:
    series = "CAST(outcome AS VARCHAR)" if by_class else "'all'"
    return f"""WITH {prefix}, t AS (SELECT * FROM ({_tall(source, columns, series + " AS series")}) WHERE x IS NOT NULL),
    d AS (SELECT series, field, x, count(*) AS k FROM t GROUP BY series, field, x),
    p AS (SELECT series, field, count(*) AS n, stddev_samp(x) * power(count(*), -0.2) AS bw, min(x) AS lo, max(x) AS hi
          FROM t GROUP BY series, field),
    g AS (SELECT series, field, n, bw, CAST(i AS INT) AS point_no,
                 (lo - 3 * bw) + i * ((hi + 3 * bw) - (lo - 3 * bw)) / 199 AS gx FROM p, range(200) r(i))
    SELECT g.series, g.field, g.point_no, round(g.gx, 6) AS x,
           round(sum(d.k * exp(-0.5 * power((g.gx - d.x) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi())), 12) AS density
    FROM g JOIN d ON g.series = d.series AND g.field = d.field
    GROUP BY g.series, g.field, g.point_no, g.gx, g.n, g.bw"""


def _histogram(prefix: str, source: str, columns: list[str], bins: int = 28) -> str:
    start = f"WITH {prefix}, " if prefix else "WITH "
    return f"""{start}t AS ({_tall(source, columns, "1 AS one")}),
    p AS (SELECT field, min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS step FROM t GROUP BY field),
    g AS (SELECT field, CAST(i AS INT) AS bin_no, lo + (i - 1) * step AS a,
          CASE WHEN i = {bins} THEN hi ELSE lo + i * step END AS b FROM p, range(1, {bins + 1}) r(i))
    SELECT g.field, g.bin_no, round(g.a, 6) AS start, round(g.b, 6) AS "end", count(t.x) AS records
    FROM g LEFT JOIN t ON t.field = g.field AND t.x >= g.a AND (t.x < g.b OR (g.bin_no = {bins} AND t.x <= g.b))
    GROUP BY g.field, g.bin_no, g.a, g.b"""


def _boxes(by_class: bool) -> str:
    group = "outcome, field" if by_class else "field"
    lead = "q.outcome, q.field" if by_class else "q.field"
    match = "t.outcome = q.outcome AND t.field = q.field" if by_class else "t.field = q.field"
    inside = "t.x >= q.q1 - 1.5 * (q.q3 - q.q1) AND t.x <= q.q3 + 1.5 * (q.q3 - q.q1)"
    return f"""WITH {READ}, t AS (SELECT * FROM ({_tall("c")}) WHERE x IS NOT NULL),
    q AS (SELECT {group}, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
          quantile_cont(x, 0.75) AS q3 FROM t GROUP BY {group})
    SELECT {lead}, round(any_value(q.q1), 6) AS q1, round(any_value(q.median), 6) AS median,
           round(any_value(q.q3), 6) AS q3,
           round(coalesce(min(t.x) FILTER ({inside}), any_value(q.q1)), 6) AS lower,
           round(coalesce(max(t.x) FILTER ({inside}), any_value(q.q3)), 6) AS upper,
           count(*) FILTER (NOT ({inside})) AS outliers, round(min(t.x), 6) AS min, round(max(t.x), 6) AS max,
           round(avg(t.x), 6) AS mean
    FROM t JOIN q ON {match} GROUP BY {lead}"""


def _bands(column: str, bands: int) -> str:
    """Distinct quantile edges; a row's band is the number of edges below its value, at least one."""
    probs = ", ".join(repr(i / bands) for i in range(bands + 1))
    return f"""{READ}, ed AS (SELECT DISTINCT unnest(quantile_cont({column}, [{probs}])) AS e FROM c),
    b AS (SELECT c.{column} AS x, outcome, CAST(greatest(1, (SELECT count(*) FROM ed WHERE e < c.{column})) AS INT) AS band_no
          FROM c WHERE {column} IS NOT NULL),
    lb AS (SELECT CAST(row_number() OVER (ORDER BY e) AS INT) AS band_no, e AS a, lead(e) OVER (ORDER BY e) AS z FROM ed)"""


def _groups(columns: list[str], source: str, target: str, groups: list[str]) -> str:
    def cell(c, g):
        test = f"FILTER ({target} = {g})"
        tag = g.strip("'")
        x = f"CAST({c} AS DOUBLE)"
        return (
            f"round(avg({x}) {test}, 6) AS mean_{tag}, round(quantile_cont({x}, 0.5) {test}, 6) AS median_{tag}, "
            f"round(quantile_cont({x}, 0.75) {test} - quantile_cont({x}, 0.25) {test}, 6) AS iqr_{tag}"
        )

    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {', '.join(cell(c, g) for g in groups)} FROM {source}" for c in columns
    )


def _rank_sums() -> str:
    return f"""{READ}, t AS (SELECT * FROM ({_tall("c")}) WHERE x IS NOT NULL),
    k AS (SELECT field, outcome, rank() OVER (PARTITION BY field ORDER BY x)
          + (count(*) OVER (PARTITION BY field, x) - 1) / 2.0 AS r FROM t),
    ties AS (SELECT field, sum(m * m * m - m) AS tie FROM
             (SELECT field, CAST(count(*) AS DOUBLE) AS m FROM t GROUP BY field, x) GROUP BY field),
    u AS (SELECT field, count(*) FILTER (outcome = 0) AS n0, count(*) FILTER (outcome = 1) AS n1,
          sum(r) FILTER (outcome = 0) AS r0 FROM k GROUP BY field),
    v AS (SELECT u.field, n0, n1, r0 - n0 * (n0 + 1) / 2.0 AS u0, tie,
          CAST(n0 AS DOUBLE) * n1 AS pairs, CAST(n0 + n1 AS DOUBLE) AS n FROM u JOIN ties ON u.field = ties.field),
    z AS (SELECT field, n0, n1, u0,
          (greatest(u0, pairs - u0) - pairs / 2 - 0.5) / sqrt(pairs / 12 * ((n + 1) - tie / (n * (n - 1)))) AS z FROM v),
    p AS (SELECT field, 2 * sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
          * exp(-0.5 * power(z + i * 0.003, 2))) * 0.003 / 3 / sqrt(2 * pi()) AS p
          FROM z, range(4001) s(i) GROUP BY field)"""


def _scores() -> str:
    return f"""{SCORED}, g AS (SELECT score, sum(outcome) AS tp, count(*) AS n FROM s GROUP BY score),
    q AS (SELECT score, tp, n, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(n) OVER (ORDER BY score DESC) AS cn,
          sum(tp) OVER () AS pos, sum(n - tp) OVER () AS neg FROM g)"""


_CELLS = """SELECT count(*) FILTER (outcome = 0 AND score < 0.366) AS tn,
    count(*) FILTER (outcome = 0 AND score >= 0.366) AS fp, count(*) FILTER (outcome = 1 AND score < 0.366) AS fn,
    count(*) FILTER (outcome = 1 AND score >= 0.366) AS tp FROM s"""

_PROBS = ", ".join(f"{0.02 + i * 0.01:.2f}" for i in range(97))

_THRESHOLDS = f"""{RAW}, s AS (SELECT outcome, total / 500000 AS score FROM raw), g AS (SELECT DISTINCT round(unnest(quantile_cont(score, [{_PROBS}])), 4) AS threshold FROM s),
    h AS (SELECT threshold, CAST(count(*) FILTER (outcome = 1) AS BIGINT) AS tp,
          CAST(count(*) FILTER (outcome = 0) AS BIGINT) AS fp
          FROM g JOIN s ON s.score >= g.threshold GROUP BY threshold),
    th AS (SELECT threshold, tp, fp, tp / CAST(pos AS DOUBLE) AS recall, tp / CAST(tp + fp AS DOUBLE) AS precision,
          2.0 * tp / (tp + fp + pos) AS f1 FROM h, (SELECT sum(outcome) AS pos FROM s))"""

_LEVELS = f"""{RAW}, lv AS (SELECT pid, outcome, CASE WHEN n_lines <= 3 THEN CAST(n_lines AS VARCHAR) ELSE '3 or more' END AS level FROM raw),
    od AS (SELECT * FROM (VALUES (1, '0'), (2, '1'), (3, '2'), (4, '3'), (5, '3 or more')) o(level_no, level))"""


def _synthetic() -> str:
    def field(name, lo, hi, decimals):
        u = f"({_hash(42, name)} / 4503599627370496.0)"
        value = f"({lo} + {u} * ({hi} - {lo}))"
        if decimals is None:
            return f"CAST(floor({value}) AS BIGINT) AS {name}"
        return f"round({value}, {decimals}) AS {name}"

    parts = [
        field("n_lines", 0.0, 10.0, None),
        field("max_price", 900.0, 100000.0, 2),
        field("min_disc", 0.01, 0.1, 2),
        field("min_tax", 0.01, 0.08, 2),
        field("qty", 1.0, 300.0, 1),
        field("total", 1000.0, 450000.0, 2),
    ]
    return (
        f"SELECT pid, {', '.join(parts)}, CAST({_hash(42, 'outcome')} / 4503599627370496.0 < 0.329 AS INT) AS outcome "
        "FROM (SELECT o_orderkey AS pid FROM orders)"
    )


def _screening_columns() -> str:
    inside = ", ".join(
        f"round(CAST(CASE WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE {c} END AS DOUBLE), 6) AS {c}_inside"
        for c, (lo, hi) in RANGES.items()
    )
    place = ", ".join(
        f"round((CAST({c} AS DOUBLE) - {lo}) / ({hi} - {lo}), 6) AS {c}_position" for c, (lo, hi) in RANGES.items()
    )
    return f"""WITH {READ} SELECT pid, printf('#P-%03d', pid) AS record_id,
    CASE WHEN outcome = 1 THEN 'finished' ELSE 'open' END AS class, CAST(total / 500000 >= 0.366 AS INT) AS decision,
    {inside}, {place} FROM c"""


def _record_score() -> str:
    """The placeholder score of the readings, in which a missing one is written as null."""
    text = " || ';' || ".join(
        f"'{c}=' || coalesce(CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,10)) AS VARCHAR), 'null')"
        for c in sorted(COLUMNS)
    )
    return f"CAST(('0x' || substr(sha256({text}), 1, 8)) AS BIGINT) / 4294967296.0"


def _placeholder() -> str:
    text = " || ';' || ".join(
        f"'{c}=' || CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,10)) AS VARCHAR)" for c in sorted(COLUMNS)
    )
    return f"""WITH {RAW}, h AS (SELECT pid, CAST(('0x' || substr(sha256({text}), 1, 8)) AS BIGINT) / 4294967296.0 AS p FROM raw)
    SELECT pid, round(p, 9) AS probability, CAST(p >= 0.5 AS INT) AS label FROM h"""


def _record_comparison() -> str:
    parts = []
    for c, (lo, hi) in RANGES.items():
        for who, value in (("cohort median", f"m_{c}"), ("this record", f"CAST({c} AS DOUBLE)")):
            parts.append(
                f"SELECT pid, '{c}' AS field, '{who}' AS who, round(({value} - {lo}) / ({hi} - {lo}), 6) AS position, "
                f"round({value}, 6) AS value FROM c, md"
            )
    medians = _list("quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}")
    return f"WITH {READ}, md AS (SELECT {medians} FROM c) " + " UNION ALL ".join(parts)


def _conformance() -> str:
    parts = []
    for c, (lo, hi) in RANGES.items():
        parts.append(
            f"SELECT '{c}' AS field, count(*) FILTER ({c} < {lo}) AS below_min, count(*) FILTER ({c} > {hi}) AS above_max, "
            f"CAST(0 AS BIGINT) AS outside_domain, count(*) FILTER ({c} IS NULL) AS missing FROM raw"
        )
    parts.append(
        "SELECT 'outcome', CAST(0 AS BIGINT), CAST(0 AS BIGINT), count(*) FILTER (outcome NOT IN (0, 1)), "
        "count(*) FILTER (outcome IS NULL) FROM raw"
    )
    return f"WITH {RAW} " + " UNION ALL ".join(parts)


def _missingness() -> str:
    def row(c):
        hidden = c in HIDDEN
        missing = f"count(*) FILTER ({c} = 0)" if hidden else f"count(*) - count({c})"
        return (
            f"SELECT '{c}' AS feature, count(*) AS total_rows, count(*) FILTER ({c} = 0) AS zero_count, "
            f"{'true' if hidden else 'false'} AS disguised, {missing} AS missing_count, "
            f"round(100.0 * ({missing}) / count(*), 2) AS missing_pct FROM raw"
        )

    return " UNION ALL ".join(row(c) for c in COLUMNS)


_SCALES = {
    "standard": ("avg({c})", "stddev_pop({c})"),
    "robust": ("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
    "minmax": ("min({c})", "max({c}) - min({c})"),
}


def _scaled(kind: str) -> str:
    centre, width = _SCALES[kind]
    cast = _list("CAST({c} AS DOUBLE) AS {c}")
    fits = ", ".join(
        f"{centre.format(c=c)} AS a_{c}, CASE WHEN {width.format(c=c)} = 0 THEN 1 ELSE {width.format(c=c)} END AS b_{c}"
        for c in COLUMNS
    )
    out = _list("round(({c} - a_{c}) / b_{c}, 6) AS {c}")
    return f"WITH {READ}, d AS (SELECT pid, {cast}, outcome FROM c), k AS (SELECT {fits} FROM d) SELECT pid, {out}, outcome FROM d, k"


def _imputed(aggregate: str) -> str:
    fills = ", ".join(f"{aggregate.format(c=c)} AS m_{c}" for c in HIDDEN)
    return f"""WITH {READ}, m AS (SELECT {fills} FROM c)
    SELECT pid, n_lines, {_list("round(coalesce({c}, m_{c}), 6) AS {c}", HIDDEN)}, round(total, 6) AS total, outcome FROM c, m"""


def _capped(low: str, high: str) -> str:
    return f"""WITH {READ}, m AS (SELECT {_list(low + " AS lo_{c}, " + high + " AS hi_{c}", CAPPED)} FROM c)
    SELECT pid, n_lines, {_list("round(CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END, 6) AS {c}", CAPPED)},
    outcome FROM c, m"""


def _fences() -> str:
    x = "CAST({c} AS DOUBLE)"
    q = [f"quantile_cont({x}, 0.25) AS q25", f"quantile_cont({x}, 0.75) AS q75"]
    return _union(
        f"""SELECT '{{c}}' AS feature, round(any_value(q25), 6) AS q25, round(any_value(q75), 6) AS q75,
        round(any_value(q75 - q25), 6) AS iqr, round(any_value(q25 - 1.5 * (q75 - q25)), 6) AS lower_fence,
        round(any_value(q75 + 1.5 * (q75 - q25)), 6) AS upper_fence,
        count(*) FILTER ({{c}} < q25 - 1.5 * (q75 - q25) OR {{c}} > q75 + 1.5 * (q75 - q25)) AS outlier_count,
        round(100.0 * count(*) FILTER ({{c}} < q25 - 1.5 * (q75 - q25) OR {{c}} > q75 + 1.5 * (q75 - q25)) / count({{c}}), 2) AS outlier_pct,
        round(CAST(min({{c}}) AS DOUBLE), 6) AS min_value, round(CAST(max({{c}}) AS DOUBLE), 6) AS max_value
        FROM c, (SELECT {", ".join(q)} FROM c)"""
    )


_COLUMN_TYPES = {
    "pid": "bigint", "n_lines": "bigint", "max_price": "double", "min_disc": "double", "min_tax": "double",
    "qty": "double", "total": "double", "outcome": "int",
}

def _nearest(k: int = 5) -> str:
    """Every missing cell against every row that has it: the mean of the nearest, ties to the smaller value."""
    squares = " + ".join(f"coalesce((q.{c} - d.{c}) * (q.{c} - d.{c}), 0)" for c in COLUMNS)
    shared = " + ".join(f"CAST(q.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INT)" for c in COLUMNS)
    distance = f"sqrt(({squares}) * ({len(COLUMNS)}.0::DOUBLE / ({shared})))"
    fills = " UNION ALL ".join(
        f"SELECT q.pid, '{c}' AS item, list_avg(list_transform(min({{'d': {distance}, 'v': d.{c}}}, {k}), lambda x: x.v)) AS fill "
        f"FROM c q JOIN c d ON q.{c} IS NULL AND d.{c} IS NOT NULL WHERE ({shared}) > 0 GROUP BY q.pid"
        for c in HIDDEN
    )
    filled = ", ".join(f"round(coalesce({c}, (SELECT fill FROM fills f WHERE f.pid = c.pid AND item = '{c}'), avg({c}) OVER ()), 6) AS {c}" for c in HIDDEN)
    return f"WITH {READ}, fills AS MATERIALIZED ({fills}) SELECT pid, CAST(n_lines AS DOUBLE) AS n_lines, {filled}, round(total, 6) AS total, outcome FROM c"


ORACLES: dict[str, str] = {
    "cohort": f"WITH {RAW} {_frame('raw')}",
    "csv_scan": f"WITH {RAW} {_frame('raw')}",
    "source_fallback": "SELECT o_orderkey, o_totalprice, 'processed' AS source FROM orders",
    "schema_gate": f"WITH {RAW} SELECT count(*) AS row_count, count(*) FILTER (outcome IS NULL OR outcome NOT IN (0, 1)) AS bad_targets FROM raw",
    "range_violations": _conformance(),
    "modelling_frame": f"WITH {READ} {_frame('c')}",
    "preview": f"WITH {RAW} {_frame('raw')} ORDER BY pid LIMIT 20",
    "synthetic": _synthetic(),
    "screening_columns": _screening_columns(),
    "placeholder_scores": _placeholder(),
    "impute_median": _imputed("quantile_cont({c}, 0.5)"),
    "impute_mean": _imputed("avg({c})"),
    "impute_group_median": f"WITH {FILLED} {_frame('f')}",
    "winsorize": _capped("quantile_cont({c}, 0.01)", "quantile_cont({c}, 0.99)"),
    "iqr_cap": _capped(
        "greatest(0, quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)))",
        "quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))",
    ),
    "scale_standard": _scaled("standard"),
    "scale_robust": _scaled("robust"),
    "scale_minmax": _scaled("minmax"),
    "features": f"""WITH {FEATURES} SELECT pid, n_lines, {_rounded(CAPPED)}, outcome, price_band, qty_band,
        round(qty_per_line, 6) AS qty_per_line, round(price_tax, 6) AS price_tax, risk_score FROM e""",
    "summary_stats": _summary(READ, "c", COLUMNS),
    "lineitem_profile": _summary("", "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "lineitem_group_medians": _groups(["l_quantity", "l_extendedprice"], "lineitem", "l_returnflag", ["'A'", "'N'", "'R'"]),
    "documents_profile": _summary("", "documents", ["n_chars"]),
    "describe": f"SELECT feature, present, mean, std, min, q25, median, q75, max FROM ({_summary(READ, 'c', COLUMNS)})",
    "column_info": f"WITH {READ} "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS column_no, '{c}' AS field, '{t}' AS type, count({c}) AS present FROM c"
        for i, (c, t) in enumerate(_COLUMN_TYPES.items(), start=1)
    ),
    "corrected_skewness": f"WITH {READ} "
    + _union("SELECT '{c}' AS feature, round(skewness(CAST({c} AS DOUBLE)), 6) AS skewness FROM c"),
    "missingness": f"WITH {RAW} {_missingness()}",
    "missing_share": f"WITH {READ}, m AS ("
    + _union("SELECT '{c}' AS feature, 100.0 * (count(*) - count({c})) / count(*) AS p FROM c", HIDDEN)
    + """) SELECT feature, round(p, 2) AS missing_pct,
        CASE WHEN p > 20 THEN 'high' WHEN p > 5 THEN 'medium' ELSE 'low' END AS severity FROM m""",
    "before_after": f"WITH {RAW}, m AS ({_missingness()}) SELECT *, CAST(0 AS BIGINT) AS null_after FROM m",
    "group_stats": f"WITH {READ} {_groups(COLUMNS, 'c', 'outcome', ['0', '1'])}",
    "bivariate": f"""WITH {_rank_sums()}, gs AS ({_groups(COLUMNS, 'c', 'outcome', ['0', '1'])})
        SELECT gs.*, round(z.u0, 1) AS u0, p.p < 0.05 AS significant
        FROM gs JOIN z ON gs.feature = z.field JOIN p ON p.field = z.field""",
    "mann_whitney": f"""WITH {_rank_sums()} SELECT z.field AS feature, n0, n1, round(u0, 1) AS u0, round(z, 6) AS z,
        round(p.p, 6) AS p_value, p.p < 0.05 AS significant FROM z JOIN p ON z.field = p.field""",
    "iqr_outliers": f"WITH {READ} {_fences()}",
    "class_balance": f"""WITH {RAW} SELECT CASE WHEN outcome = 1 THEN 'finished' ELSE 'open' END AS class, count(*) AS records,
        round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM raw GROUP BY 1""",
    "target_shares": f"""WITH {RAW} SELECT outcome, count(*) AS records,
        round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM raw GROUP BY 1""",
    "crosstab": f"""WITH {FEATURES} SELECT price_band, round(100.0 * count(*) FILTER (outcome = 0) / count(*), 6) AS pct_0,
        round(100.0 * count(*) FILTER (outcome = 1) / count(*), 6) AS pct_1 FROM e WHERE price_band IS NOT NULL GROUP BY 1""",
    "corr_long": _corr([*COLUMNS, "outcome"], 6),
    "corr_heatmap": _corr([*COLUMNS, "outcome"], 2),
    "spearman": _spearman(),
    "spearman_in_buckets": _spearman(),
    "spearman_pairwise": _spearman_pairwise(),
    "box_stats": _boxes(False),
    "box_by_class": _boxes(True),
    "density": _density(RAW, "raw", ["max_price", "qty"], False),
    "density_by_class": _density(READ, "c", ["total", "qty"], True),
    "headline": f"""WITH {FEATURES} SELECT count(*) AS records, CAST(sum(outcome) AS BIGINT) AS positives,
        round(avg(outcome), 6) AS prevalence, count(*) FILTER (risk_score >= 2) AS elevated,
        round(count(*) FILTER (risk_score >= 2) / CAST(count(*) AS DOUBLE), 6) AS elevated_share FROM e""",
    "headline_complete": f"""WITH {READ} SELECT count(*) AS records, CAST(sum(outcome) AS BIGINT) AS positives,
        round(avg(outcome), 6) AS prevalence,
        round((count(pid) + count(n_lines) + count(max_price) + count(min_disc) + count(min_tax) + count(qty)
        + count(total) + count(outcome)) / (8.0 * count(*)), 6) AS complete_share FROM c""",
    "top_risk": f"""WITH {FEATURES} SELECT pid, n_lines, {_rounded(CAPPED)}, outcome, price_band, qty_band,
        round(qty_per_line, 6) AS qty_per_line, round(price_tax, 6) AS price_tax, risk_score,
        printf('#P-%03d', pid) AS record_id FROM e
        ORDER BY risk_score DESC NULLS LAST, max_price DESC NULLS LAST, qty DESC NULLS LAST, pid LIMIT 6""",
    "folded_categories": """WITH k AS (SELECT p_brand, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1),
        r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_brand) AS rn, count(*) OVER () AS levels, sum(n) OVER () AS total FROM k),
        x AS (SELECT CASE WHEN levels <= 3 OR rn < 3 THEN p_brand ELSE 'Other' END AS p_brand,
              CASE WHEN levels <= 3 THEN rn ELSE least(rn, 3) END AS place, n, total FROM r)
        SELECT p_brand, CAST(sum(n) AS BIGINT) AS records, round(sum(n) / CAST(any_value(total) AS DOUBLE), 6) AS share,
        CAST(place AS INT) AS place FROM x GROUP BY p_brand, place""",
    "category_counts": """SELECT c_mktsegment, count(*) AS records, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share
        FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1""",
    "histogram": _histogram(READ, "c", COLUMNS),
    "lineitem_histogram": _histogram("", "lineitem", ["l_extendedprice"]),
    "scatter_sample": f"""WITH {READ} SELECT pid, round(total, 6) AS total, round(qty, 6) AS qty,
        CASE WHEN outcome = 1 THEN 'diabetic' ELSE 'not diabetic' END AS class FROM c
        ORDER BY {_hash(7, 'sample')}, pid LIMIT 4000""",
    "completeness": f"WITH {READ} "
    + _union(
        "SELECT '{c}' AS field, round(count({c}) / CAST(count(*) AS DOUBLE), 6) AS complete FROM c",
        ["pid", *COLUMNS, "outcome"],
    ),
    "rate_by_category": f"""WITH {READ}, b AS (SELECT CASE WHEN max_price <= 30000 THEN 'Low' WHEN max_price <= 50000 THEN 'Normal'
        WHEN max_price <= 60000 THEN 'High' WHEN max_price IS NOT NULL THEN 'Extreme' END AS price_band, outcome FROM c)
        SELECT price_band, round(avg(outcome), 6) AS positive_rate, count(*) AS records,
        round((SELECT avg(outcome) FROM c), 6) AS overall_rate FROM b GROUP BY 1""",
    "rate_by_band": f"""WITH {_bands('qty', 5)} SELECT b.band_no,
        any_value(printf('%.0f', CASE WHEN lb.band_no = 1 THEN round(a, 3) - 0.001 ELSE round(a, 3) END)
        || ' to ' || printf('%.0f', round(z, 3))) AS band,
        round(avg(outcome), 6) AS positive_rate, count(*) AS records FROM b JOIN lb ON b.band_no = lb.band_no GROUP BY 1""",
    "prevalence_line": f"""WITH {_bands('max_price', 6)} SELECT band_no, round(avg(x), 6) AS centre,
        round(avg(outcome), 6) AS positive_rate, count(*) AS records,
        round((SELECT avg(outcome) FROM c), 6) AS overall_rate FROM b GROUP BY 1""",
    "cdf": f"""WITH {READ}, q AS (SELECT unnest(quantile_cont(total, [{', '.join(repr(i / 199) for i in range(200))}])) AS v,
        unnest(range(200)) AS i FROM c)
        SELECT round(v, 6) AS value, round(max(i) / 199.0, 6) AS share FROM q GROUP BY v""",
    "cdf_marker": f"""WITH {READ} SELECT 123456.78::DOUBLE AS value,
        round(count(*) FILTER (total <= 123456.78) / CAST(count(total) AS DOUBLE), 6) AS share FROM c""",
    "record_vs_cohort": _record_comparison(),
    "percentile_lookup": f"""WITH {READ}, n AS (SELECT count(*) AS n FROM c),
        r AS (SELECT l_orderkey AS pid, min(l_extendedprice) AS max_price FROM lineitem GROUP BY 1),
        m AS (SELECT max_price AS v, 1 AS held FROM c WHERE max_price IS NOT NULL
              UNION ALL SELECT max_price, 0 FROM r),
        k AS (SELECT v, max(upto) AS upto FROM (SELECT v, sum(held) OVER (ORDER BY v RANGE UNBOUNDED PRECEDING) AS upto FROM m) GROUP BY v)
        SELECT r.pid, round(r.max_price, 6) AS max_price, round(k.upto / CAST(n.n AS DOUBLE), 6) AS percentile
        FROM r JOIN k ON r.max_price = k.v, n""",
    "majority_floor": f"""WITH {RAW}, p AS (SELECT avg(outcome) AS p FROM raw)
        SELECT 'accuracy' AS metric, round(1 - p, 6) AS score FROM p UNION ALL SELECT 'recall', 0.0 FROM p
        UNION ALL SELECT 'PR-AUC', round(p, 6) FROM p UNION ALL SELECT 'ROC-AUC', 0.5 FROM p""",
    "ordinal_counts": f"""WITH {_LEVELS} SELECT od.level_no, od.level, count(lv.pid) AS records,
        round(count(lv.pid) / CAST(sum(count(lv.pid)) OVER () AS DOUBLE), 6) AS share
        FROM od LEFT JOIN lv ON od.level = lv.level GROUP BY 1, 2""",
    "rate_by_level": f"""WITH {_LEVELS} SELECT od.level_no, od.level, round(avg(lv.outcome), 6) AS positive_rate,
        count(lv.pid) AS records FROM od LEFT JOIN lv ON od.level = lv.level GROUP BY 1, 2""",
    "rate_by_risk_score": f"""WITH {FEATURES} SELECT CAST(row_number() OVER (ORDER BY risk_score) AS INT) AS level_no,
        CAST(risk_score AS VARCHAR) AS level, round(avg(outcome), 6) AS positive_rate, count(*) AS records
        FROM e GROUP BY risk_score""",
    "rate_by_band_level": f"""WITH {FEATURES}, od AS (SELECT * FROM (VALUES (1, 'Low'), (2, 'Normal'), (3, 'High'),
        (4, 'Extreme'), (5, 'Unknown')) o(level_no, level)),
        g AS (SELECT price_band, avg(outcome) AS r, count(*) AS n FROM e GROUP BY 1)
        SELECT od.level_no, od.level, round(g.r, 6) AS positive_rate, g.n AS records FROM od LEFT JOIN g ON od.level = g.price_band""",
    "implausible_zeros": f"WITH {RAW} "
    + _union("SELECT '{c}' AS field, count(*) FILTER ({c} = 0) AS zeros FROM raw", [*HIDDEN, "total"]),
    "label_leak": f"""WITH {FILLED}, t AS ({_tall("f")}), n AS (SELECT count(*) AS n, avg(outcome) AS r FROM f),
        g AS (SELECT field, x AS value, count(*) AS records, avg(outcome) AS positive_rate FROM t GROUP BY field, x)
        SELECT field, round(value, 6) AS value, records, round(records / CAST(n AS DOUBLE), 6) AS share,
        round(positive_rate, 6) AS positive_rate FROM g, n
        WHERE records / CAST(n AS DOUBLE) >= 0.01 AND abs(positive_rate - r) >= 0.25""",
    "duplicates": f"""WITH {RAW} SELECT CAST(sum(k - 1) AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS missing_cells,
        CAST(sum(k * (CAST(max_price = 0 AS INT) + CAST(min_disc = 0 AS INT) + CAST(min_tax = 0 AS INT) + CAST(qty = 0 AS INT)
        + CAST(total = 0 AS INT))) AS BIGINT) AS impossible_zeros FROM (SELECT * EXCLUDE (pid), count(*) AS k FROM raw GROUP BY ALL)""",
    "document_duplicates": """SELECT CAST(sum(k - 1) AS BIGINT) AS duplicate_rows,
        CAST(sum(k * (CAST(text IS NULL AS INT) + CAST(lang IS NULL AS INT) + CAST(source IS NULL AS INT) + CAST(n_chars IS NULL AS INT)))
        AS BIGINT) AS missing_cells, CAST(0 AS BIGINT) AS impossible_zeros
        FROM (SELECT text, lang, source, n_chars, count(*) AS k FROM documents GROUP BY ALL)""",
    "impute_knn": _nearest(),
    "average_precision": f"WITH {_scores()} SELECT round(sum(CAST(tp AS DOUBLE) / pos * ctp / cn), 6) AS pr_auc FROM q",
    "roc_auc": f"""WITH {_scores()} SELECT round(sum(CAST(n - tp AS DOUBLE) * (ctp - tp / 2.0)) / any_value(CAST(pos AS DOUBLE) * neg), 6)
        AS roc_auc FROM q""",
    "confusion": f"WITH {SCORED} {_CELLS}",
    "confusion_table": f"""WITH {SCORED}, k AS ({_CELLS}) SELECT CAST(0 AS INT) AS actual, tn AS predicted_negative, fp AS predicted_positive FROM k
        UNION ALL SELECT 1, fn, tp FROM k""",
    "scores_at_threshold": f"""WITH {SCORED}, k AS ({_CELLS}) SELECT *, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
        round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1,
        round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 6) AS accuracy, 0.366::DOUBLE AS threshold FROM k""",
    "threshold_table": f"""WITH {_THRESHOLDS} SELECT threshold, tp, fp, round(recall, 6) AS recall, round(precision, 6) AS precision,
        round(f1, 6) AS f1 FROM th""",
    "threshold_search": f"""WITH {_THRESHOLDS} SELECT threshold, tp, fp, round(recall, 6) AS recall, round(precision, 6) AS precision,
        round(f1, 6) AS f1 FROM th ORDER BY (recall >= 0.70) DESC, f1 DESC, threshold LIMIT 1""",
    "split": f"""WITH {RAW}, n AS (SELECT outcome AS y, count(*) AS n FROM raw GROUP BY 1),
        a AS (SELECT y, 0.2 * n AS share, floor(0.2 * n) AS low FROM n),
        w AS (SELECT CAST(ceil(0.2 * (SELECT sum(n) FROM n)) AS DOUBLE) AS wanted, (SELECT sum(n) FROM n) AS total),
        b AS (SELECT y, wanted * n / total AS share, floor(wanted * n / total) AS low FROM n, w),
        k AS (SELECT y, low + CASE WHEN row_number() OVER (ORDER BY low - share, y)
              <= (SELECT wanted FROM w) - sum(low) OVER () THEN 1 ELSE 0 END AS k FROM b),
        h AS (SELECT pid, outcome, row_number() OVER (PARTITION BY outcome ORDER BY {_hash(42, '')}) AS rn FROM raw)
        SELECT pid, outcome, CASE WHEN rn <= k THEN 'test' ELSE 'train' END AS part FROM h JOIN k ON h.outcome = k.y""",
    "folds": f"""WITH {RAW}, h AS (SELECT pid, outcome, row_number() OVER (PARTITION BY outcome ORDER BY {_hash(42, '')}) AS rn,
        count(*) OVER (PARTITION BY outcome) AS n FROM raw)
        SELECT pid, outcome, CAST((SELECT count(*) FROM range(1, 10) r(i) WHERE i * n // 10 < rn) AS INT) AS fold FROM h""",
    "hash_folds": f"""WITH {RAW} SELECT pid, outcome, CAST({_hash(7, '')} % 5 AS INT) AS fold,
        round({_hash(7, 'draw')} / 4503599627370496.0, 9) AS u FROM raw""",
    "class_weights": f"""WITH {RAW}, n AS (SELECT outcome AS y, count(*) AS n, sum(count(*)) OVER () AS rows_all FROM raw GROUP BY 1)
        SELECT pid, outcome, round(rows_all / (2.0 * n), 6) AS weight FROM raw JOIN n ON raw.outcome = n.y""",
    "score_table": f"""WITH {READ}, h AS (SELECT pid, total, {_record_score()} AS p FROM c)
        SELECT pid, round(p, 9) AS probability, CAST(p >= 0.5 AS INT) AS label, 'placeholder' AS source,
        round(count(*) OVER (ORDER BY total RANGE UNBOUNDED PRECEDING) / CAST(count(*) OVER () AS DOUBLE), 9)
        AS primary_percentile FROM h""",
    "score_stream": f"""WITH {READ}, h AS (SELECT pid, {_record_score()} AS p FROM c)
        SELECT pid, round(p, 9) AS probability, CAST(p >= 0.5 AS INT) AS label, 'placeholder' AS source FROM h""",
}
ORACLES["clean_job"] = ORACLES["features"]
ORACLES["cohort_report"] = ORACLES["rate_by_risk_score"]
