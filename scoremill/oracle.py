"""DuckDB statements that give the registered queries' results on the same tables.

They are written plainly (global ranks, cross joins with grids) and apart from the operators.
"""

from __future__ import annotations

from scoremill.operators.expressions import boosted_margin, probability
from scoremill.oracle_boosting import boosting
from scoremill.sources.artefacts import stored_model

# Derived stores

FS = """fs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS customer_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
         c_acctbal AS outstanding_debt, o_totalprice AS total_price,
         n_items, sum_quantity, sum_price, avg_discount, avg_tax, o_custkey
  FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (
    SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_items, sum(l_quantity) AS sum_quantity,
           round(sum(l_extendedprice), 2) AS sum_price, round(avg(l_discount), 6) AS avg_discount,
           round(avg(l_tax), 6) AS avg_tax
    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""

LS = """ls AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS customer_id,
         'L' || CAST(o_orderkey AS VARCHAR) AS loan_id,
         CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS INTEGER)
           AS label,
         'high priority' AS label_def,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, o_custkey
  FROM orders)"""

FEATURES = [
    "outstanding_debt",
    "total_price",
    "n_items",
    "sum_quantity",
    "sum_price",
    "avg_discount",
    "avg_tax",
]
ROUNDED = ", ".join(f"round({name}, 6) AS {name}" for name in FEATURES)

WINDOW = "snapshot_date BETWEEN DATE '2001-02-01' AND DATE '2001-05-31'"

# Training rows with split and fold (the feature side is one row per customer)

SPLIT = f"""joined AS (
  SELECT ls.customer_id, ls.loan_id, ls.label, ls.snapshot_date,
         CASE WHEN ls.snapshot_date >= DATE '2001-05-01' THEN 'oot' ELSE 'train_test' END AS period,
         {", ".join("fs." + name for name in FEATURES)}
  FROM ls LEFT JOIN fs ON fs.customer_id = ls.customer_id
  WHERE ls.{WINDOW}),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY period, label
                         ORDER BY md5(customer_id || '|' || loan_id || '|88')) AS rk,
         count(*) OVER (PARTITION BY period, label) AS n
  FROM joined),
sized AS (SELECT *, (n * 20 + 99) // 100 AS n_test FROM ranked),
rows_split AS (
  SELECT *, CASE WHEN period = 'oot' THEN 'oot' WHEN rk <= n_test THEN 'test' ELSE 'train' END
           AS split,
         CASE WHEN period = 'oot' OR rk <= n_test THEN NULL
              ELSE CAST(rk > n_test + (n - n_test) // 3 AS INTEGER)
                 + CAST(rk > n_test + (n - n_test) * 2 // 3 AS INTEGER) END AS fold
  FROM sized)"""

# Drift

SIDES = """sides AS (
  SELECT 'expected' AS side, outstanding_debt AS value FROM fs
  WHERE snapshot_date = DATE '2001-05-01' AND outstanding_debt >= 0
  UNION ALL
  SELECT 'actual', outstanding_debt FROM fs WHERE outstanding_debt >= 0),
ranges AS (SELECT side, count(*) AS n, min(value) AS lo, max(value) AS hi FROM sides GROUP BY side),
scaled AS (
  SELECT side, value, (value - lo) / (hi - lo) AS x FROM sides JOIN ranges USING (side))"""

HIST = """hist AS (
  SELECT r.side, r.n, CAST(b AS INTEGER) AS bucket,
         (SELECT count(*) FROM scaled s
          WHERE s.side = r.side AND s.x >= CAST(b - 1 AS DOUBLE) / 10
            AND (s.x < CAST(b AS DOUBLE) / 10 OR b = 10)) AS n_bucket
  FROM ranges r, range(1, 11) AS g(b)),
shares AS (
  SELECT side, bucket,
         CASE WHEN n_bucket = 0 THEN 0.0001 ELSE CAST(n_bucket AS DOUBLE) / n END AS pct
  FROM hist),
terms AS (
  SELECT e.bucket, e.pct AS expected_pct, a.pct AS actual_pct,
         (a.pct - e.pct) * ln(a.pct / e.pct) AS psi_value
  FROM shares e JOIN shares a ON e.bucket = a.bucket
  WHERE e.side = 'expected' AND a.side = 'actual')"""

BAND = """CASE WHEN {0} < 0.1 THEN 'Low risk - No significant change'
     WHEN {0} < 0.2 THEN 'Medium risk - Some change detected'
     ELSE 'High risk - Significant change detected' END"""


def grouped_psi(expected: str, actual: str) -> str:
    """CTEs up to ``totals(grp, psi)`` for two queries that yield ``(grp, value)``."""
    return f"""pop AS (
  SELECT 'e' AS side, grp, value FROM ({expected})
  UNION ALL SELECT 'a', grp, value FROM ({actual})),
pop_range AS (
  SELECT side, grp, count(*) AS n, min(value) AS lo, max(value) AS hi FROM pop GROUP BY side, grp),
pop_bucket AS (
  SELECT side, grp, b, count(*) AS n_b
  FROM (SELECT side, grp, (value - lo) / (hi - lo) AS x FROM pop JOIN pop_range USING (side, grp)
        WHERE hi > lo), range(1, 11) AS g(b)
  WHERE x >= CAST(b - 1 AS DOUBLE) / 10 AND (x < CAST(b AS DOUBLE) / 10 OR b = 10)
  GROUP BY side, grp, b),
pop_share AS (
  SELECT r.side, r.grp, g.b, coalesce(CAST(n_b AS DOUBLE) / r.n, 0.0001) AS pct
  FROM pop_range r CROSS JOIN range(1, 11) AS g(b)
  LEFT JOIN pop_bucket p ON p.side = r.side AND p.grp = r.grp AND p.b = g.b),
totals AS (
  SELECT e.grp, sum((a.pct - e.pct) * ln(a.pct / e.pct)) AS psi
  FROM pop_share e JOIN pop_share a ON e.grp = a.grp AND e.b = a.b
  WHERE e.side = 'e' AND a.side = 'a' GROUP BY e.grp)"""


RUN_DATES = "(SELECT DISTINCT snapshot_date AS grp FROM fs)"
BY_DATE_EXPECTED = f"""
  SELECT d.grp, outstanding_debt AS value FROM {RUN_DATES} d
  JOIN fs ON fs.snapshot_date = CAST(d.grp - INTERVAL 1 MONTH AS DATE)
  WHERE outstanding_debt >= 0"""
BY_DATE_ALL = f"""
  SELECT d.grp, outstanding_debt AS value FROM {RUN_DATES} d CROSS JOIN fs
  WHERE outstanding_debt >= 0"""
HISTORY = "WITH " + FS + ",\n" + grouped_psi(BY_DATE_EXPECTED, BY_DATE_ALL)
HISTORY_ROWS = f"""
  SELECT grp AS snapshot_date, 'outstanding_debt' AS feature, psi AS raw_psi,
         CAST(grp - INTERVAL 1 MONTH AS DATE) AS baseline_date FROM totals"""


def values_of_all_features(condition: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS grp, {name} AS value FROM fs WHERE {name} >= 0 AND {condition}"
        for name in FEATURES
    )


# Fixed score

SCORE = "(outstanding_debt + 1000) / 11000"
PREDICTIONS = f"""pred AS (
  SELECT customer_id, snapshot_date, 'model_2001_06_01' AS model_name, {SCORE} AS model_predictions
  FROM fs)"""


def auc_of(rows: str, group: str) -> str:
    """AUC from average ranks over ``rows(group, label, score)``."""
    return f"""
  SELECT {group},
         (sum(CASE WHEN label = 1 THEN avg_rank ELSE 0 END) - n_pos * (n_pos + 1) / 2)
           / (n_pos * n_neg) AS auc,
         CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg
  FROM (SELECT {group}, label,
               rank() OVER (PARTITION BY {group} ORDER BY score)
                 + (count(*) OVER (PARTITION BY {group}, score) - 1) / 2 AS avg_rank,
               CAST(sum(label) OVER (PARTITION BY {group}) AS DOUBLE) AS n_pos,
               CAST(sum(1 - label) OVER (PARTITION BY {group}) AS DOUBLE) AS n_neg
        FROM ({rows}))
  GROUP BY {group}, n_pos, n_neg"""


SCORED = f"""scored AS (
  SELECT *, {SCORE} AS score, CAST({SCORE} >= 0.5 AS INTEGER) AS prediction FROM rows_split)"""

# Search space


def value_table(name: str, values: list[str]) -> str:
    listed = ", ".join(f"('{value}')" for value in values)
    return f"(VALUES {listed}) AS t_{name}({name})"


def sampled_grid(space: dict[str, list[str]], n_iter: int) -> str:
    names = ", ".join(space)
    joined = " || '|' || ".join([*space, "'42'"])
    tables = " CROSS JOIN ".join(value_table(name, values) for name, values in space.items())
    return f"""grid AS (
  SELECT * FROM (
    SELECT {names}, CAST(row_number() OVER (ORDER BY md5({joined})) - 1 AS INTEGER) AS candidate
    FROM {tables})
  WHERE candidate < {n_iter}),
fold_sizes AS (
  SELECT fold, count(*) AS n_scored, CAST(sum(label) AS BIGINT) AS n_scored_pos
  FROM rows_split WHERE split = 'train' GROUP BY fold),
plan AS (
  SELECT fold, n_scored, n_scored_pos,
         CAST((SELECT sum(n_scored) FROM fold_sizes) - n_scored AS BIGINT) AS n_fitted, grid.*
  FROM fold_sizes CROSS JOIN grid)"""


GBT_SPACE = {
    "n_estimators": ["25", "50"],
    "max_depth": ["2", "3"],
    "learning_rate": ["0.01", "0.1"],
    "subsample": ["0.6", "0.8"],
    "colsample_bytree": ["0.6", "0.8"],
    "gamma": ["0", "0.1"],
    "min_child_weight": ["1", "3", "5"],
}
BOOSTED_SPACE = {**GBT_SPACE, "reg_alpha": ["0", "0.1", "1"], "reg_lambda": ["1", "1.5", "2"]}
LOGREG_SPACE = {
    "C": ["0.01", "0.1", "1", "10"],
    "penalty": ["l1", "l2"],
    "max_iter": ["100", "200", "300"],
}

KDE = f"""vals AS (
  SELECT 'outstanding_debt' AS feature, outstanding_debt AS value FROM fs
  WHERE outstanding_debt >= 0
  UNION ALL
  SELECT 'model_predictions', {SCORE} FROM fs WHERE snapshot_date = DATE '2001-06-01'),
spread AS (
  SELECT feature, count(*) AS n, min(value) AS lo, max(value) AS hi,
         stddev_samp(value) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw
  FROM vals GROUP BY feature),
points AS (
  SELECT feature, n, bw, CAST(p AS INTEGER) AS point,
         lo - 3 * bw + p * ((hi + 3 * bw) - (lo - 3 * bw)) / 199 AS x
  FROM spread CROSS JOIN range(0, 200) AS g(p))"""


# Boosted trees

TEXT_FEATURES = ["n_chars", "n_words", "n_lines", "non_letter_share", "upper_share"]
QUALITY = """quality AS (
  SELECT *, rank() OVER (PARTITION BY label ORDER BY md5(customer_id || '|' || loan_id || '|88')) AS rk,
         count(*) OVER (PARTITION BY label) AS n
  FROM (
    SELECT CAST(doc_id AS VARCHAR) AS customer_id, 'D' || CAST(doc_id AS VARCHAR) AS loan_id, quality AS label,
           CAST(n_chars AS DOUBLE) AS n_chars,
           CAST(len(string_split_regex(text, '\\s+')) AS DOUBLE) AS n_words,
           CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines,
           1 - length(regexp_replace(text, '\\P{L}+', '', 'g')) / CAST(greatest(length(text), 1) AS DOUBLE)
             AS non_letter_share,
           length(regexp_replace(text, '\\P{Lu}+', '', 'g')) / CAST(greatest(length(text), 1) AS DOUBLE)
             AS upper_share
    FROM documents JOIN labels USING (doc_id))),
quality_rows AS (
  SELECT *, row_number() OVER (ORDER BY customer_id) AS rid,
         CASE WHEN rk <= (n * 20 + 99) // 100 THEN 'test' ELSE 'train' END AS split FROM quality)"""
QUALITY_ROWS = f"""SELECT rid, label AS y, NULL AS fold, split = 'train' AS in_fit,
  customer_id || '|' || loan_id AS key_text, {", ".join(TEXT_FEATURES)} FROM quality_rows"""
ORDER_ROWS = f"""SELECT row_number() OVER (ORDER BY customer_id) AS rid, label AS y, fold, true AS in_fit,
  customer_id || '|' || loan_id AS key_text, {", ".join(FEATURES)} FROM rows_split WHERE split = 'train'"""
# The parameter sets of the queries, stated again.
ROUND = {"n_estimators": 1, "max_depth": 2, "learning_rate": 0.3, "reg_lambda": 1, "min_child_weight": 5}
SMALL_BOOSTED = {
    "n_estimators": 8, "max_depth": 2, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.8,
    "gamma": 0.1, "min_child_weight": 3, "reg_alpha": 0.1, "reg_lambda": 1.5,
}
FEW_CANDIDATES = [
    {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.6},
    {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.6},
    {"n_estimators": 2, "max_depth": 1, "learning_rate": 0.1, "reg_alpha": 1, "reg_lambda": 2},
]
QUALITY_MODEL = boosting(QUALITY_ROWS, TEXT_FEATURES, [(SMALL_BOOSTED, None)])
QUALITY_SCORED = """scored AS (
  SELECT split, label, round(1 / (1 + exp(-margin)), 9) AS score,
         CAST(1 / (1 + exp(-margin)) > 0.5 AS INTEGER) AS prediction
  FROM margins JOIN quality_rows USING (rid))"""

# Newton steps of a logistic regression on two features, by Cramer's rule

NEWTON_C = 0.1


def newton(steps: int) -> str:
    def minor(a: str, b: str, c: str, d: str) -> str:
        return f"({a} * {d} - {b} * {c})"

    def determinant(m: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a} * {minor(e, f, h, i)} - {b} * {minor(d, f, g, i)} + {c} * {minor(d, e, g, h)})"

    parts = [
        """points AS MATERIALIZED (SELECT label AS y, 1.0::DOUBLE AS x0,
    (total_price - avg(total_price) OVER ()) / stddev_pop(total_price) OVER () AS x1,
    (sum_quantity - avg(sum_quantity) OVER ()) / stddev_pop(sum_quantity) OVER () AS x2
  FROM rows_split WHERE split = 'train' AND total_price IS NOT NULL AND sum_quantity IS NOT NULL)""",
        "w0 AS (SELECT own, 0.0::DOUBLE AS a0, 0.0::DOUBLE AS a1, 0.0::DOUBLE AS a2 FROM (VALUES (1), (0)) AS v(own))",
    ]
    matrix = [[f"h{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    for step in range(steps):
        sums = [f"sum({NEWTON_C} * (p - y) * x{i}) + {'own * ' if i == 0 else ''}any_value(a{i}) AS g{i}" for i in range(3)]
        for i in range(3):
            for j in range(i, 3):
                ridge = "" if i != j else " + own" if i == 0 else " + 1"
                sums.append(f"sum({NEWTON_C} * p * (1 - p) * x{i} * x{j}){ridge} AS h{i}{j}")
        solved = []
        for k in range(3):
            replaced = [[f"g{i}" if j == k else matrix[i][j] for j in range(3)] for i in range(3)]
            solved.append(f"a{k} - {determinant(replaced)} / {determinant(matrix)} AS a{k}")
        parts.append(
            f"s{step} AS MATERIALIZED (SELECT own, any_value(a0) AS a0, any_value(a1) AS a1, any_value(a2) AS a2, "
            f"{', '.join(sums)} FROM (SELECT *, 1 / (1 + exp(-(a0 * x0 + a1 * x1 + a2 * x2))) AS p "
            f"FROM points CROSS JOIN w{step}) GROUP BY own)"
        )
        parts.append(f"w{step + 1} AS (SELECT own, {', '.join(solved)} FROM s{step})")
    union = " UNION ALL ".join(f"SELECT {step} AS step, * FROM w{step}" for step in range(steps + 1))
    return ",\n".join([*parts, f"steps AS ({union})"])


# Training dates

BACKFILL = """months AS (SELECT DISTINCT snapshot_date AS d FROM ls),
dates AS (
  SELECT d AS train_date FROM months UNION SELECT CAST(d + INTERVAL 14 DAY AS DATE) FROM months
  UNION SELECT last_day(d) FROM months WHERE month(d) % 2 = 0),
calendars AS (SELECT * FROM (VALUES ('', 1, 3), ('notebook ', 2, 4)) AS v(prefix, oot, tt)),
bounds AS (
  SELECT train_date, prefix, CAST(train_date - to_months(oot) AS DATE) AS oot_start, tt FROM dates CROSS JOIN calendars),
periods AS (
  SELECT train_date, prefix || 'oot' AS period, oot_start AS start_date,
         CAST(train_date - INTERVAL 1 DAY AS DATE) AS end_date FROM bounds
  UNION ALL
  SELECT train_date, prefix || 'train_test', CAST(oot_start - to_months(tt) AS DATE),
         CAST(oot_start - INTERVAL 1 DAY AS DATE) FROM bounds)"""


def statement(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


ORACLE = {
    "scan_feature_store": statement(
        FS, select=f"SELECT customer_id, snapshot_date, {ROUNDED} FROM fs"
    ),
    "label_window": statement(
        LS,
        select=f"SELECT customer_id, loan_id, label, label_def, snapshot_date FROM ls WHERE {WINDOW}",
    ),
    "snapshot_equals": statement(
        FS,
        select=f"""SELECT customer_id, snapshot_date, {ROUNDED} FROM fs
WHERE snapshot_date = DATE '2001-06-01'""",
    ),
    "period_split": statement(
        LS,
        select="""SELECT customer_id, loan_id, snapshot_date,
  CASE WHEN snapshot_date BETWEEN DATE '2001-05-01' AND DATE '2001-05-31' THEN 'oot'
       WHEN snapshot_date BETWEEN DATE '2001-02-01' AND DATE '2001-04-30' THEN 'train_test'
  END AS period
FROM ls""",
    ),
    "training_windows": statement(
        LS,
        "days AS (SELECT DISTINCT snapshot_date AS d FROM ls)",
        "variants AS (SELECT * FROM (VALUES ('1+3', 1, 3), ('2+4', 2, 4)) AS v(variant, o, t))",
        select="""SELECT d AS train_date, variant,
  CAST(d - to_months(o) - to_months(t) AS DATE) AS train_test_start,
  CAST(d - to_months(o) - INTERVAL 1 DAY AS DATE) AS train_test_end,
  CAST(d - to_months(o) AS DATE) AS oot_start,
  CAST(d - INTERVAL 1 DAY AS DATE) AS oot_end
FROM days CROSS JOIN variants""",
    ),
    "feature_select": statement(FS, select=f"SELECT {ROUNDED} FROM fs"),
    "train_join": statement(
        FS,
        LS,
        select=f"""SELECT ls.customer_id, loan_id, label, label_def, ls.snapshot_date, {ROUNDED}
FROM ls LEFT JOIN fs ON fs.customer_id = ls.customer_id WHERE ls.{WINDOW}""",
    ),
    "train_join_fanout": statement(
        FS,
        LS,
        select=f"""SELECT CAST(ls.o_custkey AS VARCHAR) AS customer_id, loan_id, label, label_def,
  ls.snapshot_date, {ROUNDED}
FROM ls LEFT JOIN fs ON fs.o_custkey = ls.o_custkey WHERE ls.{WINDOW}""",
    ),
    "train_join_asof": statement(
        FS,
        LS,
        f"""dated AS (
  SELECT o_custkey, CAST(snapshot_date + INTERVAL 14 DAY AS DATE) AS feature_date, {", ".join(FEATURES)},
         row_number() OVER (PARTITION BY o_custkey, snapshot_date
           ORDER BY {", ".join(f"{name} DESC NULLS LAST" for name in FEATURES)}) AS place
  FROM fs)""",
        select=f"""SELECT CAST(ls.o_custkey AS VARCHAR) AS customer_id, loan_id, label, label_def,
  ls.snapshot_date, feature_date, {ROUNDED}
FROM ls LEFT JOIN dated ON dated.o_custkey = ls.o_custkey AND place = 1 AND feature_date = (
  SELECT max(feature_date) FROM dated d WHERE d.o_custkey = ls.o_custkey AND d.feature_date <= ls.snapshot_date)
WHERE ls.{WINDOW}""",
    ),
    "stratified_split": statement(
        LS,
        """ranked AS (
  SELECT *, rank() OVER (PARTITION BY label
                         ORDER BY md5(customer_id || '|' || loan_id || '|88')) AS rk,
         count(*) OVER (PARTITION BY label) AS n
  FROM ls)""",
        select="""SELECT customer_id, loan_id, label,
  CASE WHEN rk * 100 <= n * 20 + 99 THEN 'test' ELSE 'train' END AS split
FROM ranked""",
    ),
    "cv_folds": statement(
        FS, LS, SPLIT, select="""SELECT customer_id, loan_id, label, split, coalesce(fold, -1) AS fold
FROM rows_split"""
    ),
    "split_folds_fanout": statement(
        FS,
        LS,
        f"""joined AS (
  SELECT label, CASE WHEN ls.snapshot_date >= DATE '2001-05-01' THEN 'oot' ELSE 'train_test' END AS period
  FROM ls LEFT JOIN fs ON fs.o_custkey = ls.o_custkey WHERE ls.{WINDOW}),
sizes AS (SELECT period, label, count(*) AS n, (count(*) * 20 + 99) // 100 AS n_test FROM joined GROUP BY period, label),
parts AS (
  SELECT period, label, 'oot' AS split, -1 AS fold, n AS n_rows FROM sizes WHERE period = 'oot'
  UNION ALL SELECT period, label, 'test', -1, n_test FROM sizes WHERE period <> 'oot'
  UNION ALL SELECT period, label, 'train', f, (n - n_test) * (f + 1) // 3 - (n - n_test) * f // 3
    FROM sizes CROSS JOIN (VALUES (0), (1), (2)) AS folds(f) WHERE period <> 'oot')""",
        select="SELECT period, label, split, CAST(fold AS INTEGER) AS fold, CAST(n_rows AS BIGINT) AS n_rows "
        "FROM parts WHERE n_rows > 0",
    ),
    "split_stats": statement(
        FS,
        LS,
        SPLIT,
        select="""SELECT period, split, count(*) AS n_rows, round(avg(label), 2) AS label_rate
FROM rows_split GROUP BY period, split""",
    ),
    "hp_grid_sample": statement(
        FS, LS, SPLIT, sampled_grid(GBT_SPACE, 100), select="SELECT * FROM plan"
    ),
    "hp_grid_logreg": statement(
        FS,
        LS,
        SPLIT,
        sampled_grid(LOGREG_SPACE, 100),
        select="SELECT *, round(1 / (CAST(C AS DOUBLE) * n_fitted), 9) AS reg_param FROM plan",
    ),
    "scaler_stats": statement(
        FS,
        LS,
        SPLIT,
        select=" UNION ALL ".join(
            f"""SELECT '{name}' AS feature, count({name}) AS n, round(avg({name}), 6) AS mean,
  round(stddev_pop({name}), 6) AS std
FROM rows_split WHERE split = 'train'"""
            for name in FEATURES
        ),
    ),
    "scaled_features": statement(
        FS,
        LS,
        SPLIT,
        "fit AS (SELECT "
        + ", ".join(
            f"avg({name}) AS m_{name}, stddev_pop({name}) AS s_{name}" for name in FEATURES
        )
        + " FROM rows_split WHERE split = 'train')",
        select="SELECT customer_id, split, "
        + ", ".join(f"round(({name} - m_{name}) / s_{name}, 6) AS {name}" for name in FEATURES)
        + " FROM rows_split CROSS JOIN fit",
    ),
    "nonneg_clean": statement(
        FS,
        select="""SELECT customer_id, snapshot_date, 'outstanding_debt' AS feature,
  round(outstanding_debt, 6) AS value
FROM fs WHERE outstanding_debt IS NOT NULL AND outstanding_debt >= 0""",
    ),
    "minmax_scale": statement(
        FS,
        SIDES,
        select="""SELECT 'outstanding_debt' AS feature, round(value, 6) AS value,
  round(x, 6) AS scaled, side FROM scaled""",
    ),
    "equal_width_hist": statement(
        FS,
        SIDES,
        HIST,
        select="SELECT 'outstanding_debt' AS feature, n, bucket, n_bucket, side FROM hist",
    ),
    "psi_buckets": statement(
        FS,
        SIDES,
        HIST,
        select="""SELECT 'outstanding_debt' AS feature, bucket, round(expected_pct, 6) AS expected_pct,
  round(actual_pct, 6) AS actual_pct, round(psi_value, 6) AS psi_value,
  CASE WHEN psi_value > 0.1 THEN 'red' WHEN psi_value > 0.05 THEN 'orange' ELSE 'green' END AS band
FROM terms""",
    ),
    "psi_total": statement(
        FS,
        SIDES,
        HIST,
        select=f"""SELECT 'model_2001_06_01' AS model_name, DATE '2001-06-01' AS snapshot_date,
  DATE '2001-05-01' AS baseline_date, 'outstanding_debt' AS feature_name,
  round(sum(psi_value), 6) AS psi_value, {BAND.format("sum(psi_value)")} AS psi_status
FROM terms""",
    ),
    "psi_features": statement(
        FS,
        grouped_psi(
            values_of_all_features("snapshot_date = DATE '2001-05-01'"),
            values_of_all_features("true"),
        ),
        select=f"""SELECT grp AS feature, round(psi, 6) AS psi_value, {BAND.format("psi")} AS psi_status
FROM totals""",
    ),
    "psi_history": f"""{HISTORY}
SELECT snapshot_date, feature, baseline_date, round(raw_psi, 6) AS psi_value,
  {BAND.format("raw_psi")} AS psi_status
FROM ({HISTORY_ROWS})""",
    "psi_history_upsert": f"""{HISTORY},
{SIDES.replace("FROM fs WHERE outstanding_debt >= 0)", "FROM fs WHERE snapshot_date = DATE '2001-06-01' AND outstanding_debt >= 0)")},
{HIST},
merged AS (
  SELECT snapshot_date, feature, baseline_date, raw_psi FROM ({HISTORY_ROWS})
  WHERE snapshot_date <> DATE '2001-06-01'
  UNION ALL
  SELECT DATE '2001-06-01', 'outstanding_debt', DATE '2001-05-01', sum(psi_value) FROM terms)
SELECT snapshot_date, feature, baseline_date, round(raw_psi, 6) AS psi_value,
  {BAND.format("raw_psi")} AS psi_status
FROM merged""",
    "kde_curve": statement(
        FS,
        KDE,
        select="""SELECT p.feature, p.point, round(p.x, 6) AS x,
  round(sum(exp(-0.5 * ((p.x - v.value) / p.bw) * ((p.x - v.value) / p.bw)))
        / (any_value(p.n) * any_value(p.bw) * sqrt(2 * pi())), 9) AS density
FROM points p JOIN vals v ON v.feature = p.feature GROUP BY p.feature, p.point, p.x""",
    ),
    "auc_exact": statement(
        FS,
        LS,
        SPLIT,
        SCORED,
        select="SELECT split, round(auc, 6) AS auc, n_pos, n_neg FROM ("
        + auc_of("SELECT split, label, score FROM scored", "split")
        + ")",
    ),
    "gini": statement(
        FS,
        LS,
        select="SELECT snapshot_date, round(2 * auc - 1, 3) AS gini FROM ("
        + auc_of(
            f"""SELECT fs.snapshot_date, label, {SCORE} AS score
        FROM fs JOIN ls ON ls.customer_id = fs.customer_id AND ls.snapshot_date = fs.snapshot_date""",
            "snapshot_date",
        )
        + ")",
    ),
    "hard_label_auc": statement(
        FS,
        LS,
        SPLIT,
        SCORED,
        select="SELECT fold, round(auc, 6) AS auc FROM ("
        + auc_of("SELECT fold, label, prediction AS score FROM scored WHERE split = 'train'", "fold")
        + ")",
    ),
    "confusion_matrix": statement(
        FS,
        LS,
        SPLIT,
        SCORED,
        select="""SELECT split, l AS label, p AS prediction,
  count(*) FILTER (s.label = l AND s.prediction = p) AS n_rows
FROM scored s CROSS JOIN (VALUES (0), (1)) AS a(l) CROSS JOIN (VALUES (0), (1)) AS b(p)
GROUP BY split, l, p""",
    ),
    "prediction_label_join": statement(
        FS,
        LS,
        PREDICTIONS,
        select="""SELECT pred.customer_id, pred.snapshot_date, model_name,
  round(model_predictions, 6) AS model_predictions, label
FROM pred JOIN ls ON ls.customer_id = pred.customer_id
WHERE pred.snapshot_date = DATE '2001-06-01' AND ls.snapshot_date = DATE '2001-06-01'""",
    ),
    "monitor_summary": statement(
        FS,
        LS,
        SIDES,
        HIST,
        PREDICTIONS,
        "psi AS (SELECT sum(psi_value) AS psi FROM terms)",
        f"""metrics AS (
  SELECT 'outstanding_debt' AS feature, 'feature' AS metric, 'outstanding_debt' AS value
  UNION ALL SELECT 'outstanding_debt', 'psi_value', printf('%.4f', psi) FROM psi
  UNION ALL SELECT 'outstanding_debt', 'psi_status', {BAND.format("psi")} FROM psi
  UNION ALL SELECT NULL, 'predictions', CAST(count(*) AS VARCHAR) FROM pred
    WHERE snapshot_date = DATE '2001-06-01'
  UNION ALL SELECT NULL, 'features', CAST(count(*) AS VARCHAR) FROM fs
  UNION ALL SELECT NULL, 'labels', CAST(count(*) AS VARCHAR)
    FROM pred JOIN ls ON ls.customer_id = pred.customer_id
    WHERE pred.snapshot_date = DATE '2001-06-01' AND ls.snapshot_date = DATE '2001-06-01')""",
        select="""SELECT 'model_2001_06_01' AS model_name, DATE '2001-06-01' AS snapshot_date,
  feature, metric, value FROM metrics""",
    ),
    "prediction_sink_roundtrip": statement(
        FS,
        PREDICTIONS,
        select="""SELECT customer_id, snapshot_date, model_name,
  round(CASE WHEN snapshot_date = DATE '2001-06-01' THEN 1 - model_predictions
             ELSE model_predictions END, 6) AS model_predictions
FROM pred""",
    ),
    "hp_grid_boosted": statement(
        FS, LS, SPLIT, sampled_grid(BOOSTED_SPACE, 100), select="SELECT * FROM plan"
    ),
    "training_backfill": statement(
        LS,
        BACKFILL,
        """by_class AS (
  SELECT train_date, period, label, count(*) AS n, min(snapshot_date) AS lo, max(snapshot_date) AS hi
  FROM periods JOIN ls ON snapshot_date BETWEEN start_date AND end_date GROUP BY train_date, period, label),
stats AS (
  SELECT train_date, period, sum(n) AS n, sum(n) FILTER (label = 1) AS pos, min(lo) AS lo, max(hi) AS hi,
         sum(CASE WHEN ends_with(period, 'train_test') THEN (n * 20 + 99) // 100 ELSE 0 END) AS tested
  FROM by_class GROUP BY train_date, period)""",
        select="""SELECT train_date, period, start_date, end_date, CAST(coalesce(n, 0) AS BIGINT) AS n_rows,
  CAST(coalesce(pos, 0) AS BIGINT) AS n_pos, CAST(coalesce(tested, 0) AS BIGINT) AS n_test,
  round(coalesce(pos, 0) / n, 2) AS label_rate, lo AS first_date, hi AS last_date
FROM periods LEFT JOIN stats USING (train_date, period)""",
    ),
    "training_backfill_rows": statement(
        LS,
        BACKFILL,
        select="""SELECT train_date, period, customer_id, loan_id, label, snapshot_date
FROM periods JOIN ls ON snapshot_date BETWEEN start_date AND end_date WHERE period IN ('oot', 'train_test')""",
    ),
    "boosted_tree": statement(
        FS,
        LS,
        SPLIT,
        boosting(ORDER_ROWS, FEATURES, [(ROUND, None)]),
        select="""SELECT CAST(0 AS INTEGER) AS tree, CAST(v.node AS INTEGER) AS node, s.name AS feature,
  round(s.cut, 6) AS cut, s.ml = 1 AS missing_left, round(s.gain, 6) AS gain,
  CASE WHEN s.node IS NULL THEN round(v.weight, 6) END AS weight, round(v.cover, 6) AS cover
FROM v0 v LEFT JOIN (
  SELECT splits.*, name, edges[bin + 1] AS cut FROM splits JOIN named USING (f) JOIN cuts USING (f)) s
  ON s.node = v.node""",
    ),
    "boosted_fit_score": statement(
        QUALITY,
        QUALITY_MODEL,
        QUALITY_SCORED,
        select="SELECT split, round(auc, 6) AS auc, n_pos, n_neg, round(2 * auc - 1, 3) AS gini FROM ("
        + auc_of("SELECT split, label, score FROM scored", "split")
        + ")",
    ),
    "boosted_confusion": statement(
        QUALITY,
        QUALITY_MODEL,
        QUALITY_SCORED,
        select="""SELECT split, l AS label, p AS prediction,
  count(*) FILTER (s.label = l AND s.prediction = p) AS n_rows
FROM scored s CROSS JOIN (VALUES (0), (1)) AS a(l) CROSS JOIN (VALUES (0), (1)) AS b(p)
GROUP BY split, l, p""",
    ),
    "boosted_importance_rank": statement(
        QUALITY,
        QUALITY_MODEL,
        """gains AS (SELECT name, coalesce(avg(gain), 0) AS gain FROM named LEFT JOIN splits USING (f) GROUP BY name),
shares AS (SELECT name, round(gain / sum(gain) OVER (), 6) AS importance FROM gains)""",
        select="""SELECT CAST(row_number() OVER (ORDER BY importance DESC, name) AS INTEGER) AS rank, name AS feature,
  importance FROM shares""",
    ),
    "boosted_search_cv": statement(
        FS,
        LS,
        SPLIT,
        boosting(ORDER_ROWS, FEATURES, [(params, fold) for params in FEW_CANDIDATES for fold in range(3)]),
        """hits AS (
  SELECT fit, held_out AS fold, y, avg(CASE WHEN (margin > 0) = (y = 1) THEN 1.0 ELSE 0 END) AS rate
  FROM margins JOIN base USING (rid) JOIN fits USING (fit) WHERE base.fold = held_out GROUP BY fit, held_out, y)""",
        select="""SELECT CAST(fit // 3 AS INTEGER) AS candidate, CAST(fold AS INTEGER) AS fold, round(avg(rate), 6) AS auc
FROM hits GROUP BY fit, fold""",
    ),
    "batch_score": statement(
        FS,
        select=f"""SELECT customer_id, snapshot_date, 'model_2001_06_01' AS model_name,
  round({probability(boosted_margin(stored_model("model_2001_06_01")))}, 6) AS model_predictions
FROM fs WHERE snapshot_date = DATE '2001-06-01'""",
    ),
    "logistic_newton": statement(
        FS,
        LS,
        SPLIT,
        newton(3),
        select="""SELECT own = 1 AS penalised, CAST(step AS INTEGER) AS step, round(a0, 6) AS intercept,
  round(a1, 6) AS total_price, round(a2, 6) AS sum_quantity FROM steps""",
    ),
}
ORACLE["psi_history_sink"] = f"""SELECT 'model_2001_06_01' AS model_name, snapshot_date, baseline_date,
  feature AS feature_name, psi_value, psi_status FROM ({ORACLE["psi_history_upsert"]})"""
ORACLE["psi_incremental"] = ORACLE["psi_features"]
