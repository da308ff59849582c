"""Registered queries: every operator over the provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill import testdata
from scoremill.functions.dates import (
    TrainingWindows,
    months_before,
    parse_date,
    with_training_windows,
)
from scoremill.operators import (
    backfill,
    boosting,
    density,
    drift,
    drift_state,
    expressions,
    learners,
    logistic,
    metrics,
    scaling,
    search,
    splits,
    training_set,
)
from scoremill.operators.scoring import as_predictions
from scoremill.operators.training_set import feature_columns, label_feature_join, with_period
from scoremill.plans.inference import infer
from scoremill.plans import monitoring, training
from scoremill.schemas import (
    CUSTOMER,
    DEBT,
    LABEL,
    LOAN,
    MODEL,
    SCORE,
    SNAPSHOT,
    feature_store_schema,
)
from scoremill.session import materialise, run_folder
from scoremill.sources import reports, stores
from scoremill.sources.artefacts import boosted_artefact, save_artefact, stored_model

RUN_DATE = parse_date("2001-06-01")
BASELINE_DATE = months_before(RUN_DATE, 1)
MODEL_NAME = "model_2001_06_01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, digits) for name in doubles})


def _windowed_labels(spark: SparkSession, sf_dir: str, customer: str = "o_orderkey") -> DataFrame:
    windows = TrainingWindows.at(RUN_DATE)
    labels = testdata.label_store(spark, sf_dir, customer)
    return stores.in_window(labels, windows.train_test_start, windows.oot_end)


def _training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_table(
        testdata.label_store(spark, sf_dir),
        testdata.feature_store(spark, sf_dir),
        TrainingWindows.at(RUN_DATE),
    )


def _fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of every snapshot by the fixed score."""
    features = testdata.feature_store(spark, sf_dir)
    return as_predictions(features.withColumn("score", testdata.fixed_score()), MODEL_NAME)


def _debt_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    store = testdata.feature_store(spark, sf_dir)
    baseline = stores.at_snapshot(store, BASELINE_DATE)
    return tuple(drift.non_negative_values(side, [DEBT]) for side in (baseline, store))


def _both_sides(run: Callable[[DataFrame], DataFrame], sides: tuple[DataFrame, ...]) -> DataFrame:
    expected, actual = (run(side) for side in sides)
    return expected.withColumn("side", F.lit("expected")).unionByName(
        actual.withColumn("side", F.lit("actual"))
    )


# Stores, windows and the training set


@query
def scan_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_folder(spark, "feature-store")
    stores.write_store(testdata.feature_store(spark, sf_dir), root)
    schema = feature_store_schema(testdata.FEATURES)
    return rounded(stores.scan_store(spark, root, schema))


@query
def label_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windowed_labels(spark, sf_dir)


@query
def snapshot_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stores.at_snapshot(testdata.feature_store(spark, sf_dir), RUN_DATE))


@query
def period_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = testdata.label_store(spark, sf_dir)
    return with_period(labels, TrainingWindows.at(RUN_DATE)).select(
        CUSTOMER, LOAN, SNAPSHOT, "period"
    )


@query
def training_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = testdata.label_store(spark, sf_dir).select(F.col(SNAPSHOT).alias("train_date"))
    dates = dates.distinct()
    script = with_training_windows(dates, oot_months=1, train_test_months=3)
    notebook = with_training_windows(dates, oot_months=2, train_test_months=4)
    return script.withColumn("variant", F.lit("1+3")).unionByName(
        notebook.withColumn("variant", F.lit("2+4"))
    )


@query
def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = testdata.feature_store(spark, sf_dir)
    return rounded(store.select(feature_columns(store)))


@query
def train_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _windowed_labels(spark, sf_dir)
    return rounded(label_feature_join(labels, testdata.feature_store(spark, sf_dir)))


@query
def train_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _windowed_labels(spark, sf_dir, "o_custkey")
    features = testdata.feature_store(spark, sf_dir, "o_custkey")
    return rounded(label_feature_join(labels, features))


@query
def train_join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with the last features known at their date, customers with several snapshots."""
    labels = _windowed_labels(spark, sf_dir, "o_custkey")
    features = testdata.feature_store(spark, sf_dir, "o_custkey")
    # Features are dated a fortnight into their month, so those of a label's own month come too late for it.
    later = features.withColumn(SNAPSHOT, F.date_add(SNAPSHOT, 14))
    return rounded(training_set.label_feature_asof_join(labels, later))


@query
def split_folds_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of splits and folds where a label has several joined rows."""
    joined = training.training_table(
        testdata.label_store(spark, sf_dir, "o_custkey"),
        testdata.feature_store(spark, sf_dir, "o_custkey"),
        TrainingWindows.at(RUN_DATE),
    )
    keys = ["period", LABEL, "split", F.coalesce("fold", F.lit(-1)).alias("fold")]
    return joined.groupBy(*keys).agg(F.count("*").alias("n_rows"))


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = testdata.label_store(spark, sf_dir)
    return splits.stratified_split(labels).select(CUSTOMER, LOAN, LABEL, "split")


@query
def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.coalesce("fold", F.lit(-1)).alias("fold")
    return _training_table(spark, sf_dir).select(CUSTOMER, LOAN, LABEL, "split", fold)


@query
def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set.split_stats(_training_table(spark, sf_dir), ("period", "split"))


@query
def hp_grid_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _training_table(spark, sf_dir).filter(F.col("split") == "train")
    return search.search_plan(train, search.sample_candidates(learners.GBT_SPACE, 100, 42))


@query
def hp_grid_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _training_table(spark, sf_dir).filter(F.col("split") == "train")
    plan = search.search_plan(train, search.sample_candidates(learners.LOGREG_SPACE, 100, 42))
    penalty = 1 / (F.col("C").cast("double") * F.col("n_fitted"))
    return plan.withColumn("reg_param", F.round(penalty, 9))


@query
def training_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and label rates of the training sets of every month and both calendars, in one plan."""
    labels = testdata.label_store(spark, sf_dir)
    return backfill.backfill_stats(labels, _all_periods(labels))


@query
def training_backfill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of every month's training set."""
    labels = testdata.label_store(spark, sf_dir)
    periods = backfill.training_periods(_train_dates(labels))
    rows = backfill.in_periods(labels, periods)
    return rows.select("train_date", "period", CUSTOMER, LOAN, LABEL, SNAPSHOT)


def _train_dates(labels: DataFrame) -> DataFrame:
    """The middle of each month that has labels, and the end of each second one: windows that cut months."""
    month = labels.select(SNAPSHOT).distinct()
    middle = month.select(F.date_add(SNAPSHOT, 14).alias("train_date"))
    ends = month.filter(F.month(SNAPSHOT) % 2 == 0).select(F.last_day(SNAPSHOT).alias("train_date"))
    return month.select(F.col(SNAPSHOT).alias("train_date")).union(middle).union(ends)


def _all_periods(labels: DataFrame) -> DataFrame:
    script = backfill.training_periods(_train_dates(labels), 1, 3)
    notebook = backfill.training_periods(_train_dates(labels), 2, 4)
    named = F.concat(F.lit("notebook "), F.col("period"))
    return script.unionByName(notebook.withColumn("period", named))


# Scaling


@query
def scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _training_table(spark, sf_dir).filter(F.col("split") == "train")
    return rounded(scaling.scaler_stats(train, testdata.FEATURES))


@query
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training_table(spark, sf_dir)
    scaler = scaling.fit_scaler(rows.filter(F.col("split") == "train"), testdata.FEATURES)
    return rounded(scaler.transform(rows).select(CUSTOMER, "split", *testdata.FEATURES))


# Drift and density


@query
def nonneg_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = testdata.feature_store(spark, sf_dir)
    return rounded(drift.non_negative_values(store, [DEBT], [CUSTOMER, SNAPSHOT]))


@query
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    def scaled(values: DataFrame) -> DataFrame:
        return drift.min_max_scaled(values, drift.value_ranges(values))

    return rounded(_both_sides(scaled, _debt_sides(spark, sf_dir)))


@query
def equal_width_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_sides(drift.equal_width_histogram, _debt_sides(spark, sf_dir))


@query
def psi_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.psi_buckets(*_debt_sides(spark, sf_dir)))


@query
def psi_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = drift.psi_total(drift.psi_buckets(*_debt_sides(spark, sf_dir)))
    return rounded(monitoring.psi_rows(totals, MODEL_NAME, RUN_DATE))


@query
def psi_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = testdata.feature_store(spark, sf_dir)
    baseline = stores.at_snapshot(store, BASELINE_DATE)
    sides = (drift.non_negative_values(side, testdata.FEATURES) for side in (baseline, store))
    return rounded(drift.psi_total(drift.psi_buckets(*sides)))


@query
def psi_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of all features from a state that was built of most months at once and then month by month."""
    root = run_folder(spark, "drift-state")
    store = materialise(testdata.feature_store(spark, sf_dir), "store")
    days = sorted(row[0] for row in store.select(SNAPSHOT).distinct().collect())
    late = [day for day in days if day in (BASELINE_DATE, RUN_DATE)]
    for some in ([day for day in days if day not in late], *([day] for day in reversed(late))):
        drift_state.update_state(store, root, some, testdata.FEATURES)
    terms = drift_state.psi_from_state(drift_state.read_state(spark, root), RUN_DATE)
    return rounded(drift.psi_total(terms))


@query
def psi_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(drift.psi_history(testdata.feature_store(spark, sf_dir)))


@query
def psi_history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = testdata.feature_store(spark, sf_dir)
    existing = drift.psi_history(store, current_scope="all")
    rerun = stores.in_window(store, BASELINE_DATE, RUN_DATE)
    new = drift.psi_history(rerun, current_scope="snapshot")
    return rounded(reports.upsert(existing, new, [SNAPSHOT, "feature"]))


@query
def kde_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = testdata.feature_store(spark, sf_dir)
    predictions = stores.at_snapshot(_fixed_predictions(spark, sf_dir), RUN_DATE)
    curves = density.curves_of(
        [drift.non_negative_values(store, [DEBT]), density.series(predictions, SCORE)]
    )
    return rounded(curves, 9).withColumn("x", F.round("x", 6))


# Evaluation with the fixed score, predictions and the summary


def _fixed_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _training_table(spark, sf_dir).withColumn("score", testdata.fixed_score())
    return scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def _labelled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = testdata.label_store(spark, sf_dir)
    scored = monitoring.prediction_label_join(_fixed_predictions(spark, sf_dir), labels)
    return scored.withColumnRenamed(SCORE, "score")


@query
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.complete(metrics.auc(_fixed_scored(spark, sf_dir))))


@query
def gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_month = metrics.auc_and_gini(_labelled_predictions(spark, sf_dir), [SNAPSHOT])
    return metrics.complete(by_month).select(SNAPSHOT, "gini")


@query
def hard_label_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_train = _fixed_scored(spark, sf_dir).filter(F.col("split") == "train")
    return rounded(metrics.hard_label_auc(in_train, ["fold"]))


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(_fixed_scored(spark, sf_dir))


@query
def prediction_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = stores.at_snapshot(_fixed_predictions(spark, sf_dir), RUN_DATE)
    labels = stores.at_snapshot(testdata.label_store(spark, sf_dir), RUN_DATE)
    return rounded(monitoring.prediction_label_join(predictions, labels))


@query
def monitor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.monitor(
        _fixed_predictions(spark, sf_dir),
        testdata.feature_store(spark, sf_dir),
        testdata.label_store(spark, sf_dir),
        MODEL_NAME,
        RUN_DATE,
    ).summary


@query
def prediction_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every snapshot, write one again with other scores, read the store back."""
    root = run_folder(spark, "model-predictions")
    predictions = _fixed_predictions(spark, sf_dir)
    reports.write_predictions(predictions, root)
    rerun = stores.at_snapshot(predictions, RUN_DATE).withColumn(SCORE, 1 - F.col(SCORE))
    reports.write_predictions(rerun, root)
    return rounded(reports.read_predictions(spark, root))


# Learners


SMALL_GBT = {"n_estimators": 25, "max_depth": 2, "learning_rate": 0.1, "subsample": 0.8}


def _train_on_orders(spark: SparkSession, sf_dir: str, learner: str, **options) -> object:
    return training.train(
        testdata.label_store(spark, sf_dir),
        testdata.feature_store(spark, sf_dir),
        RUN_DATE,
        learner,
        **options,
    )


def _fit_on_quality(spark: SparkSession, sf_dir: str, learner: str, params: dict) -> tuple:
    """Fit one candidate on the labelled documents; returns model, scaler and scored rows."""
    rows = materialise(testdata.quality_table(spark, sf_dir), "quality")
    rows = splits.stratified_split(rows)
    in_train = rows.filter(F.col("split") == "train")
    preparation = learners.Preparation(scaling.fit_scaler(in_train, testdata.TEXT_FEATURES))
    prepared = preparation.apply(rows)
    train_rows = prepared.filter(F.col("split") == "train")
    model = learners.LEARNERS[learner](params, in_train.count()).fit(train_rows)
    return model, preparation.scaler, learners.with_score(model.transform(prepared))


#: One boosting round whose tree is checked node by node, and a small model with every parameter in use.
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


def _boosted_on_quality(spark: SparkSession, sf_dir: str) -> tuple[boosting.BoostedModel, DataFrame]:
    rows = materialise(splits.stratified_split(testdata.quality_table(spark, sf_dir)), "quality")
    in_train = rows.filter(F.col("split") == "train")
    matrix = boosting.binned(in_train, testdata.TEXT_FEATURES, (CUSTOMER, LOAN))
    model = boosting.boost(matrix, [boosting.Fit(boosting.Params.of(SMALL_BOOSTED))])[0]
    scored = expressions.scored(rows, expressions.boosted_margin(model))
    return model, scored.withColumn("score", F.round("score", 9))


@query
def boosted_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of one boosting round on the training rows: splits with their gain, leaves with their weight."""
    rows = _training_table(spark, sf_dir).filter(F.col("split") == "train")
    matrix = boosting.binned(rows, testdata.FEATURES, (CUSTOMER, LOAN))
    model = boosting.boost(matrix, [boosting.Fit(boosting.Params.of(ROUND))])[0]
    return rounded(boosting.tree_nodes(spark, model))


@query
def boosted_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC and Gini of boosted trees on the labelled documents, scored by the model's own expression."""
    return rounded(metrics.complete(metrics.auc_and_gini(_boosted_on_quality(spark, sf_dir)[1])))


@query
def boosted_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard labels of the boosted trees against the true ones."""
    return metrics.confusion_matrix(_boosted_on_quality(spark, sf_dir)[1])


@query
def boosted_importance_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean gain by feature, as shares, in descending order."""
    model, _ = _boosted_on_quality(spark, sf_dir)
    shares = {name: round(share, 6) for name, share in model.importances().items()}
    return metrics.feature_importance(spark, shares)


@query
def boosted_search_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few candidates in three folds, all grown in the same passes."""
    scores = _train_on_orders(spark, sf_dir, "boosted", candidates=FEW_CANDIDATES).search.scores
    return rounded(scores.drop("params"))


@query
def tree_search_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search of the original: 100 candidates of nine parameters in three folds, refit and evaluation."""
    return _train_on_orders(spark, sf_dir, "boosted", n_iter=100).search.scores


@query
def logistic_newton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three Newton steps from zero on two scaled features, with both penalties of the intercept."""
    rows = _training_table(spark, sf_dir).filter(F.col("split") == "train")
    names = ["total_price", "sum_quantity"]
    rows = rows.filter(" AND ".join(f"{name} IS NOT NULL" for name in names))
    scaled = scaling.fit_scaler(rows, names).transform(rows)
    fits = [logistic.LogisticFit(C=0.1, max_iter=3, penalise_intercept=own) for own in (True, False)]
    logistic.fit_all(logistic.design(scaled, names), fits, 3, tolerance=0.0)
    steps = [
        (fit.penalise_intercept, step, *map(float, weights))
        for fit in fits for step, weights in enumerate(fit.path)
    ]
    columns = "penalised boolean, step int, intercept double, total_price double, sum_quantity double"
    return rounded(spark.createDataFrame(steps, columns))


@query
def logistic_search_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 72 fits of the logistic search in shared passes."""
    return _train_on_orders(spark, sf_dir, "logistic", n_iter=24).search.scores


@query
def hp_grid_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 300 fits of that search."""
    train = _training_table(spark, sf_dir).filter(F.col("split") == "train")
    return search.search_plan(train, search.sample_candidates(learners.BOOSTED_SPACE, 100, 42))


@query
def gbt_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, scored = _fit_on_quality(spark, sf_dir, "gbt", SMALL_GBT)
    return metrics.complete(metrics.auc_and_gini(scored))


@query
def logreg_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {"C": 1, "penalty": "l2", "max_iter": 100}
    _, _, scored = _fit_on_quality(spark, sf_dir, "logreg", params)
    return metrics.complete(metrics.auc_and_gini(scored))


@query
def feature_importance_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, scaler, _ = _fit_on_quality(spark, sf_dir, "gbt", SMALL_GBT)
    return metrics.feature_importance(spark, learners.importances(model, scaler))


@query
def random_search_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of the logistic search, in three folds."""
    return _train_on_orders(spark, sf_dir, "logreg", n_iter=24).search.scores


@query
def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of the whole logistic search."""
    return _train_on_orders(spark, sf_dir, "logreg", n_iter=24).artefact.record


@query
def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save, load and score one snapshot."""
    one = [{"C": 1, "penalty": "l2", "max_iter": 100}]
    artefact = _train_on_orders(spark, sf_dir, "logreg", candidates=one).artefact
    bank = run_folder(spark, "model-bank")
    save_artefact(artefact, bank)
    features = testdata.feature_store(spark, sf_dir)
    return infer(features, bank, artefact.version, RUN_DATE, run_folder(spark, "model-predictions"))


@query
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score one snapshot with the stored model; nothing is trained."""
    bank = run_folder(spark, "model-bank")
    save_artefact(boosted_artefact(spark, stored_model(MODEL_NAME), MODEL_NAME), bank)
    features = testdata.feature_store(spark, sf_dir)
    predictions = run_folder(spark, "model-predictions")
    return rounded(infer(features, bank, f"{MODEL_NAME}.pkl", RUN_DATE, predictions))


@query
def psi_history_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift history of every date through its sink, one date written again with another scope."""
    root, store = run_folder(spark, "psi-history"), testdata.feature_store(spark, sf_dir)
    rerun = drift.psi_history(stores.in_window(store, BASELINE_DATE, RUN_DATE), current_scope="snapshot")
    for history in (drift.psi_history(store, current_scope="all"), rerun):
        rows = history.withColumnRenamed("feature", "feature_name").withColumn(MODEL, F.lit(MODEL_NAME))
        reports.write_psi_history(rows, root)
    return rounded(reports.read_psi_history(spark, root))
