"""name -> (spark, sf_dir) -> DataFrame, each over the whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import views as V
from fraudlake.functions import expressions as X
from fraudlake.operators import attribution, audit, boosting, encoding, entity, evaluate
from fraudlake.operators import impute as imputing
from fraudlake.operators import oversample, segment, split, velocity
from fraudlake.operators.trees import Tree, TreeModel
from fraudlake.plans import checks, eda, engineer, reports
from fraudlake.plans.pipeline import Pipeline
from fraudlake.session import materialize, scratch_folder, small_table
from fraudlake.sources import readers
from fraudlake.sources.tables import TableStore, snapshot, snapshot_once, write_metrics_json, write_report

DIGITS = 6
FLOAT_SUMS = ["amt_vs_card1_mean", "amt_vs_card1_zscore"]
MEDIAN_FILLED = ["card2", "addr1", "dist1", "D1", "V2", "V3", "id_01"]
SMALL_MODEL = {
    "n_estimators": 10,
    "max_depth": 4,
    "learning_rate": 0.2,
    "subsample": 0.9,
    "colsample_bytree": 0.9,
    "min_child_weight": 2,
    "gamma": 0.0,
}
# The space of the search with fewer trees.
SEARCH_SPACE = {**boosting.SEARCH_SPACE, "n_estimators": (2, 4, "int")}
SEARCH_TRIALS = 3
# Names of the job's tables and files. Nothing writes the last report without training.
JOB_TABLES = ["raw_transactions", "raw_identity", "merged_data", "engineered_features", "model_predictions", "risk_segments"]
JOB_SNAPSHOTS = ["merged_data.parquet", "engineered_features.parquet"]
JOB_REPORTS = [
    "threshold_analysis", "fraud_summary_by_card_type", "fraud_summary_by_device", "fraud_rate_over_time",
    "risk_segments_summary", "transaction_amount_distribution", "model_performance_metrics", "feature_importance_shap",
]
FIXTURE_FEATURES = [
    "TransactionAmt", "tx_hour", "tx_count_card1_1h", "tx_count_card1_24h",
    "amt_vs_card1_mean", "card1_addr1_count", "ProductCD", "card4", "card6",
    "C1", "D1", "V2", "V3", "id_01",
]


def comparable(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles that are sums at six digits, because such a sum depends on the order of its terms.

    Ratios of counts and plain values need no rounding.
    """
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, DIGITS) for c in columns or doubles})


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.with_identity(V.txn(spark, sf_dir), V.idn(spark, sf_dir))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = V.txn(spark, sf_dir)
    timed = transactions.transform(engineer.with_time_features).select("TransactionID", "tx_hour")
    return segment.risk_segments(
        V.scored(spark, sf_dir), transactions, V.idn(spark, sf_dir), timed
    )


# Sources, joins, checks


def csv_roundtrip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "csv")
    V.txn(spark, sf_dir).write.csv(folder, header=True)
    return readers.read_transactions_csv(spark, folder)


def identity_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "csv")
    V.idn(spark, sf_dir).write.csv(folder, header=True)
    return readers.read_identity_csv(spark, folder)


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as its file has it."""
    report = reports.amount_counts(V.txn(spark, sf_dir))
    path = f"{scratch_folder(spark, 'report')}/report.csv"
    write_report(report, path)
    return spark.read.schema(report.schema).csv(path, header=True)


def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_key_columns(
        spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_extendedprice"]
    )


def limit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_limited(V.scored(spark, sf_dir), 500)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both inputs written as bucketed tables, read and joined on the id, without their rows moving."""
    store = TableStore(spark, scratch_folder(spark, "store"), 8)
    store.replace("raw_transactions", V.txn(spark, sf_dir))
    store.replace("raw_identity", V.idn(spark, sf_dir))
    return readers.with_identity(store.read("raw_transactions"), store.read("raw_identity"))


def audit_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The null rates as their file has them."""
    path = f"{scratch_folder(spark, 'report')}/null_rates.csv"
    write_report(audit.null_rate_audit(merged(spark, sf_dir)), path)
    return readers.read_audit_csv(spark, path)


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that is written once keeps its first rows, the other kind has the latest."""
    folder = scratch_folder(spark, "snapshots")
    ids = [V.txn(spark, sf_dir).select("TransactionID"), V.idn(spark, sf_dir).select("TransactionID")]
    for rows in ids:
        snapshot_once(rows, f"{folder}/once")
        snapshot(rows, f"{folder}/latest")
    kept = [spark.read.parquet(f"{folder}/{n}").withColumn("snapshot", F.lit(n)) for n in ("once", "latest")]
    return kept[0].unionByName(kept[1])


def metrics_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics and parameters as the JSON file has them, and the metrics again as the long CSV has them."""
    folder = scratch_folder(spark, "report")
    metrics = materialize(evaluate.metrics_row(V.scored(spark, sf_dir)))
    write_metrics_json(metrics, SMALL_MODEL, f"{folder}/metrics.json")
    write_report(evaluate.metrics_long(metrics), f"{folder}/metrics.csv")
    schema = T.StructType([*metrics.schema.fields, T.StructField("best_params", T.MapType(T.StringType(), T.DoubleType()))])
    written = spark.read.schema(schema).json(f"{folder}/metrics.json")
    params = written.select(F.explode("best_params").alias("metric_name", "value"))
    long = spark.read.schema("metric_name string, value double").csv(f"{folder}/metrics.csv", header=True)
    parts = [("json", evaluate.metrics_long(written)), ("params", params), ("csv", long)]
    frames = [df.select(F.lit(name).alias("file"), "metric_name", "value") for name, df in parts]
    return comparable(frames[0].unionByName(frames[1]).unionByName(frames[2]))


def threshold_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four thresholds as their file has them."""
    analysis = evaluate.threshold_analysis(V.scored(spark, sf_dir))
    path = f"{scratch_folder(spark, 'report')}/thresholds.csv"
    write_report(analysis, path)
    return spark.read.schema(analysis.schema).csv(path, header=True)


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of all rows by a given tree that was saved and read again."""
    path = f"{scratch_folder(spark, 'model')}/model"
    boosting.save_model(spark, known_tree(), path)
    scored = boosting.score(boosting.load_model(spark, path), V.txn(spark, sf_dir))
    return comparable(scored.select("TransactionID", "isFraud", "fraud_prob", "predicted_label"))


def job_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table, snapshot and report of the batch job, run from the two CSV files.

    Training is left out (``model_checks`` and ``search_checks`` run it): the given scores take the place of its predictions.
    """
    work = scratch_folder(spark, "job")
    V.txn(spark, sf_dir).write.csv(f"{work}/csv/{readers.TRANSACTIONS_FILE}", header=True)
    V.idn(spark, sf_dir).write.csv(f"{work}/csv/{readers.IDENTITY_FILE}", header=True)
    job = Pipeline(spark, f"{work}/out", f"{work}/csv")
    job.run(only=["ingest", "etl", "features"])
    loaded = job.store.replace("model_predictions", V.scored(spark, sf_dir))
    write_report(evaluate.metrics_long(job.evaluate(job.store.read("model_predictions"))), f"{job.exports}/model_performance_metrics.csv")
    job.run(only=["segment", "export"])
    counts = [readers.count_rows(job.store.read(n), n) for n in JOB_TABLES]
    counts += [readers.count_rows(spark.read.parquet(f"{job.processed}/{n}"), n) for n in JOB_SNAPSHOTS]
    counts += [
        checks.verify_report(spark, f"{folder}/{n}.csv", n).select(F.col("report").alias("tbl"), "rows")
        for folder, names in ((job.processed, ["v_null_rates"]), (job.exports, JOB_REPORTS))
        for n in names
    ]
    counts.append(small_table(spark, [("observed", loaded)], "tbl string, rows long"))
    return reduce(DataFrame.unionByName, counts)


def schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.list_columns(merged(spark, sf_dir))


def merge_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)


def identity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.identity_coverage(V.txn(spark, sf_dir), V.idn(spark, sf_dir))


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.table_counts(
        {
            "raw_transactions": V.txn(spark, sf_dir),
            "raw_identity": V.idn(spark, sf_dir),
            "merged_data": merged(spark, sf_dir),
            "engineered_features": V.txn(spark, sf_dir).transform(engineer.with_time_features),
            "model_predictions": V.scored(spark, sf_dir),
            "risk_segments": segments(spark, sf_dir),
        }
    )


def class_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.class_share(V.txn(spark, sf_dir))


def null_spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.null_share(V.txn(spark, sf_dir), "V1")


# Audit


def null_rate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.null_rate_audit(merged(spark, sf_dir))


def null_rate_audit_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.null_rate_audit(V.lineitem(spark, sf_dir))


def sparse_column_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.sparse_column_ranking(audit.null_rate_audit(merged(spark, sf_dir)))


def drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = audit.drop_sparse_columns(V.txn(spark, sf_dir))
    return kept.select("TransactionID", *[c for c in kept.columns if c.startswith("V")])


# Features


def fe_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.txn(spark, sf_dir).transform(engineer.with_time_features).select(
        "TransactionID", "tx_hour", "tx_dow", "tx_dom"
    )


def fe_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select("TransactionID", "card1", "TransactionDT")
    return velocity.with_velocity(rows).select("TransactionID", *velocity.DEFAULT_WINDOWS)


def fe_velocity_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = {"orders_30d": 30 * X.DAY, "orders_365d": 365 * X.DAY}
    rows = V.orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_seconds")
    return velocity.with_velocity(rows, "o_custkey", "o_seconds", "o_orderkey", windows).select(
        "o_orderkey", *windows
    )


def fe_amount_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select("TransactionID", "card1", "TransactionAmt")
    return comparable(entity.with_amount_deviation(rows)).select(
        "TransactionID", "amt_vs_card1_mean", "amt_vs_card1_zscore"
    )


def fe_entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merged(spark, sf_dir).select("TransactionID", "DeviceInfo", "P_emaildomain")
    return entity.with_entity_counts(rows).select(
        "TransactionID", "tx_count_device", "tx_count_pdomain"
    )


def fe_amount_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.txn(spark, sf_dir).transform(engineer.with_amount_bucket).select(
        "TransactionID", "card4_amt_bucket"
    )


def fe_pair_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select("TransactionID", "card1", "addr1")
    return entity.with_pair_count(rows).select("TransactionID", "card1_addr1_count")


def fe_log_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        V.txn(spark, sf_dir).transform(engineer.with_log_amount).select(
            "TransactionID", "log_transaction_amt"
        )
    )


def fe_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.txn(spark, sf_dir).transform(encoding.with_flag_codes).select(
        "TransactionID", "M1_enc", "M4_enc"
    )


def fe_label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merged(spark, sf_dir).select(
        "TransactionID", "card4", "card6", "ProductCD", "DeviceType"
    )
    return encoding.with_label_codes(rows)


def fe_frequency_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merged(spark, sf_dir).select(
        "TransactionID", "P_emaildomain", "R_emaildomain", "DeviceInfo"
    )
    return entity.with_frequencies(rows).select(
        "TransactionID", "P_emaildomain_freq", "R_emaildomain_freq", "DeviceInfo_freq"
    )


def fe_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merged(spark, sf_dir).select(
        "TransactionID", "C1", "D1", "V1", "V2", "V3", "id_01", "card2", "addr1", "dist1"
    )
    return comparable(imputing.impute(materialize(rows)))


def column_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    medians = imputing.exact_medians(V.lineitem(spark, sf_dir), columns)
    return comparable(small_table(spark, list(medians.items()), "col string, median double"))


def fe_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = engineer.engineer_features(materialize(merged(spark, sf_dir)))
    return comparable(featured, *FLOAT_SUMS, *MEDIAN_FILLED, "log_transaction_amt")


# Split, model


def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select("TransactionID", "isFraud")
    return split.with_test_flag(rows)


def kfold_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select("TransactionID", "isFraud")
    return split.with_fold(rows)


def class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select("TransactionID", "isFraud")
    return split.with_class_weight(rows)


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select("TransactionID", "isFraud")
    return split.sample_rows(rows, attribution.SAMPLE_ROWS)


def _model_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    featured = engineer.engineer_features(materialize(merged(spark, sf_dir)))
    return boosting.feature_matrix(
        materialize(featured.select("TransactionID", "isFraud", *FIXTURE_FEATURES))
    )


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_model_rows(spark, sf_dir)[0], "amt_vs_card1_mean", "D1", "V2", "V3", "id_01")


def smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir).select(
        "TransactionID", "isFraud", "TransactionAmt", F.coalesce("D1", F.lit(0.0)).alias("D1"),
        F.coalesce("C1", F.lit(0.0)).alias("C1"),
    )
    return oversample.synthetic_minority(rows, ["TransactionAmt", "D1", "C1"])


def smote_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic rows and how they spread over bases; pairs of each base and its neighbours."""
    rows = materialize(
        V.txn(spark, sf_dir).select(
            "TransactionID", "isFraud", "TransactionAmt", F.coalesce("D1", F.lit(0.0)).alias("D1"),
            F.coalesce("C1", F.lit(0.0)).alias("C1"),
        )
    )
    features = ["TransactionAmt", "D1", "C1"]
    copies = oversample.synthetic_minority(rows, features).groupBy("base_id").count()
    points = materialize(
        rows.where("isFraud = 1").select("TransactionID", F.array(*features).alias("features"))
    )
    near = oversample.nearest_neighbors(points, points.count(), dimensions=len(features))
    pairs = near.select("TransactionID", "neighbor").distinct().agg(F.count("*").alias("neighbor_pairs"))
    return copies.agg(
        F.sum("count").alias("synthetic"), F.count("*").alias("bases"),
        F.min("count").alias("fewest"), F.max("count").alias("most"),
    ).withColumn("neighbor_pairs", pairs.scalar())


def smote_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared distances of each minority row's five nearest; they do not depend on how ties are broken."""
    features = ["TransactionAmt", "D1", "C1"]
    points = materialize(
        V.txn(spark, sf_dir)
        .where("isFraud = 1")
        .select("TransactionID", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]).alias("features"))
    )
    near = oversample.neighbor_distances(points, points.count(), dimensions=len(features))
    return comparable(near.select("TransactionID", F.col("rank").cast("long").alias("rank"), "distance"))


def _training_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """All numeric features, as in the batch job: a table before anything is fitted."""
    featured = materialize(engineer.engineer_features(materialize(merged(spark, sf_dir))))
    return boosting.feature_matrix(featured, mark_missing=False)


def _fitted(spark: SparkSession, sf_dir: str):
    rows, features = _training_rows(spark, sf_dir)
    train, test = split.stratified_split(rows)
    return boosting.fit_boosted_trees(train, features, SMALL_MODEL), test, features


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test, _ = _fitted(spark, sf_dir)
    return boosting.score(model, test)


def model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class of the hold-out: rows, scores outside 0 to 1, labels that contradict the score, and
    rows whose base and attributions do not add up to the score."""
    model, test, features = _fitted(spark, sf_dir)
    explained = attribution.shapley_rows(model, test, features)
    margin = sum((F.col(c) for c in features), F.col("base"))
    p = F.col("fraud_prob")
    return (
        boosting.score(model, test)
        .join(explained.select("TransactionID", margin.alias("margin")), "TransactionID", "left")
        .groupBy("isFraud")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~p.between(0, 1)).alias("outside"),
            F.count_if(F.col("predicted_label") != (p >= 0.5).cast("long")).alias("contradicted"),
            F.count_if(~(F.abs(1 / (1 + F.exp(-F.col("margin"))) - p) < 1e-9)).alias("not_adding_up"),
        )
    )


def _searched(spark: SparkSession, sf_dir: str) -> tuple[list[dict], DataFrame]:
    rows, features = _training_rows(spark, sf_dir)
    train, _ = split.stratified_split(rows)
    candidates = boosting.draw_params(SEARCH_TRIALS, space=SEARCH_SPACE)
    return boosting.search(train, features, candidates), train


def search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = boosting.trials_table(spark, _searched(spark, sf_dir)[0])
    return trials.drop("datetime_start", "datetime_complete", "duration_sec")


def search_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows trained on by class, trials, their parameters inside their ranges, trials that went to the end, and
    whether the best parameters are those of the best of these."""
    trials, train = _searched(spark, sf_dir)
    best = boosting.best_params(trials)
    ended = [t for t in trials if t["state"] == "COMPLETE"]
    inside = sum(low <= t[f"params_{k}"] <= high for t in trials for k, (low, high, _) in SEARCH_SPACE.items())
    right = all(t["value"] < 1.0000001 for t in trials) and any(
        all(t[f"params_{k}"] == v for k, v in best.items()) and t["value"] == max(e["value"] for e in ended) for t in ended
    )
    return train.groupBy("isFraud").agg(F.count("*").alias("rows")).withColumns(
        {
            "trials": F.lit(len(trials)).cast("long"),
            "inside": F.lit(int(inside)).cast("long"),
            "ended": F.lit(len(ended)).cast("long"),
            "best_is_best": F.lit(right),
        }
    )


def attribution_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test, features = _fitted(spark, sf_dir)
    return attribution.top_features(attribution.mean_attribution(model, test, features))


def known_tree() -> TreeModel:
    """Amounts up to 100 have -0.4; larger ones 0.2 if D1 is missing or at most 10, else 0.9."""
    tree = Tree()
    _, right = tree.grow(0, 0, 0, 100.0, False, 1.0)
    low, high = tree.grow(right, 1, 0, 10.0, True, 1.0)
    tree.value[1], tree.value[low], tree.value[high] = -0.4, 0.2, 0.9
    for node, cover in ((0, 8.0), (1, 6.0), (right, 2.0), (low, 0.5), (high, 1.5)):
        tree.cover[node] = cover
    return TreeModel(["TransactionAmt", "D1"], [tree], {})


def attribution_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean attributions of a given tree over all rows."""
    model = known_tree()
    return comparable(attribution.mean_attribution(model, V.txn(spark, sf_dir), model.features))


# Evaluation


def eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.auc_roc(V.scored(spark, sf_dir))


def eval_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(evaluate.average_precision(V.scored(spark, sf_dir)))


def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.classification_report(V.scored(spark, sf_dir))


def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(V.scored(spark, sf_dir))


def eval_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.calibration_table(V.scored(spark, sf_dir))


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.quality_gate(evaluate.auc_roc(V.scored(spark, sf_dir)))


def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.pr_curve(V.scored(spark, sf_dir))


def f1_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.f1_optimal_threshold(V.scored(spark, sf_dir))


def cost_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.cost_optimal_threshold(V.scored(spark, sf_dir))


def threshold_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.threshold_analysis(V.scored(spark, sf_dir))


def risk_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.with_tier(V.scored(spark, sf_dir)).select(
        "TransactionID", "risk_label", "risk_score"
    )


def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.tier_counts(segment.with_tier(V.scored(spark, sf_dir)))


def risk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir)


# Reports


def rep_card_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.by_card_type(
        V.scored(spark, sf_dir), segments(spark, sf_dir), V.txn(spark, sf_dir)
    )
    return comparable(report, "total_amount", "avg_fraud_prob")


def rep_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.by_device(segments(spark, sf_dir), V.scored(spark, sf_dir))
    return comparable(report, "total_amount", "avg_fraud_prob")


def rep_fraud_rate_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = V.txn(spark, sf_dir)
    timed = transactions.transform(engineer.with_time_features)
    report = reports.fraud_rate_over_time(timed, transactions)
    return comparable(report, "avg_amount")


def rep_tier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.tier_summary(segments(spark, sf_dir))
    return comparable(report, "avg_amount", "avg_fraud_prob")


def rep_amount_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.amount_distribution(V.txn(spark, sf_dir))
    return comparable(report, "avg_amount")


def rep_amount_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.amount_counts(V.txn(spark, sf_dir))


def rep_amount_distribution_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.lineitem(spark, sf_dir).select("l_quantity", "l_returnflag")
    return reports.amount_distribution(rows, "l_quantity", "l_returnflag")


def rep_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(evaluate.metrics_long(evaluate.metrics_row(V.scored(spark, sf_dir))))


# Profiling


def eda_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.shape(merged(spark, sf_dir))


def eda_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.preview(merged(spark, sf_dir))


def eda_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.class_balance(V.txn(spark, sf_dir))


def eda_amount_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(eda.amount_histogram(V.txn(spark, sf_dir)))


def eda_rate_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.rate_by_amount(V.txn(spark, sf_dir))


def eda_hour_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.hour_matrix(V.txn(spark, sf_dir))


def eda_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.hourly(V.txn(spark, sf_dir))


def eda_rate_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.rate_by_category(V.txn(spark, sf_dir), "P_emaildomain", top=15)


def eda_rate_by_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir)
    both = [
        eda.rate_by_category(rows, c).withColumn("column_name", F.lit(c))
        for c in ("card4", "card6")
    ]
    return both[0].unionByName(both[1])


def eda_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.txn(spark, sf_dir)
    columns = audit.numeric_columns(rows, ["TransactionID", "isFraud", "TransactionDT"])
    return comparable(eda.strongest_correlations(eda.label_correlation(rows, columns)))


def eda_identity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.identity_split(merged(spark, sf_dir))


def eda_device_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.rate_by_category(merged(spark, sf_dir), "DeviceType")


def eda_device_info_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.rate_by_category(merged(spark, sf_dir), "DeviceInfo", top=15, at_least=50)


QUERIES = {
    f.__name__: f
    for f in (
        csv_roundtrip_scan, identity_csv_roundtrip, report_roundtrip, audit_csv_roundtrip, snapshot_roundtrip,
        metrics_files, threshold_file, model_roundtrip, job_outputs, pruned_scan, limit_scan, schema_listing, table_roundtrip,
        merge_identity, identity_coverage, table_counts, class_share, null_spot_check,
        null_rate_audit, null_rate_audit_lineitem, sparse_column_ranking, drop_sparse_columns,
        fe_time, fe_velocity, fe_velocity_orders, fe_amount_deviation, fe_entity_counts,
        fe_amount_bucket, fe_pair_count, fe_log_amount, fe_flags, fe_label_encode,
        fe_frequency_encode, fe_impute, column_medians, fe_all,
        split_stratified, kfold_stratified, class_weight, seeded_sample, feature_matrix,
        smote, smote_totals, smote_neighbors, model_checks, gbt_scores, search_trials, search_checks, attribution_top20, attribution_known,
        eval_auc, eval_average_precision, eval_report, eval_confusion, eval_calibration,
        quality_gate, pr_curve, f1_threshold, cost_threshold, threshold_analysis,
        risk_tiers, tier_counts, risk_segments,
        rep_card_type, rep_device, rep_fraud_rate_over_time, rep_tier_summary,
        rep_amount_counts, rep_amount_distribution, rep_amount_distribution_lineitem, rep_metrics_long,
        eda_shape, eda_preview, eda_class_balance, eda_amount_histogram, eda_rate_by_bucket,
        eda_hour_matrix, eda_hourly, eda_rate_by_category, eda_rate_by_card, eda_correlation,
        eda_identity_split, eda_device_type, eda_device_info_top15,
    )
}
