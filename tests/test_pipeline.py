import json
import pathlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from catalogue import queries as catalogue
from catalogue import views as V
from fraudlake.plans.pipeline import STEPS, Pipeline, run_pipeline, select_steps
from fraudlake.sources import readers
from fraudlake.sources.tables import TableStore

SMALL = [
    {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0,
     "colsample_bytree": 1.0, "min_child_weight": 1, "gamma": 0.0},
]


@pytest.fixture(scope="module")
def data_dir(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv"))
    V.txn(spark, sf_dir).write.csv(f"{folder}/train_transaction.csv", header=True)
    V.idn(spark, sf_dir).write.csv(f"{folder}/train_identity.csv", header=True)
    return folder


@pytest.fixture(scope="module")
def finished(spark, data_dir, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    pipeline = Pipeline(spark, work, data_dir, buckets=4, candidates=SMALL)
    assert pipeline.run() == 0
    return work, pipeline


def report(spark, work, name):
    return spark.read.csv(f"{work}/exports/{name}.csv", header=True, inferSchema=True)


def test_step_selection():
    assert select_steps() == STEPS
    assert select_steps(only=["export", "train"]) == ["train", "export"]
    assert select_steps(only=["train"], skip=["train"]) == ["train"]
    assert select_steps(skip=["ingest", "etl"]) == STEPS[2:]
    with pytest.raises(ValueError):
        select_steps(only=["nothing"])


def test_empty_selection_fails(spark, tmp_path):
    assert run_pipeline(spark, str(tmp_path), skip=STEPS) == 1


def test_missing_input_fails_early(spark, tmp_path):
    with pytest.raises(AnalysisException):
        run_pipeline(spark, str(tmp_path / "w"), str(tmp_path / "none"), only=["ingest"], buckets=2)


def test_all_tables_and_reports_tie_out(spark, finished, sf_dir):
    work, pipeline = finished
    store = pipeline.store
    rows = V.txn(spark, sf_dir).count()
    frauds = V.txn(spark, sf_dir).agg(F.sum("isFraud")).first()[0]
    merged = store.read("merged_data")
    assert merged.count() == rows
    features = store.read("engineered_features")
    assert features.count() == rows
    assert dict(features.dtypes)["tx_hour"] == "tinyint"
    assert dict(features.dtypes)["P_emaildomain_freq"] == "float"
    assert "V1" not in features.columns and "M1" not in features.columns

    amounts = report(spark, work, "transaction_amount_distribution")
    assert amounts.agg(F.sum("transaction_count")).first()[0] == rows
    hours = report(spark, work, "fraud_rate_over_time")
    assert hours.agg(F.sum("transaction_count"), F.sum("fraud_count")).first()[:] == (rows, frauds)

    predictions = store.read("model_predictions")
    held_out = predictions.count()
    assert held_out == sum(
        int(r["count"] * 0.2 + 0.5)
        for r in V.txn(spark, sf_dir).groupBy("isFraud").count().collect()
    )
    held_frauds = predictions.agg(F.sum("isFraud")).first()[0]
    for name in ("fraud_summary_by_card_type", "fraud_summary_by_device"):
        totals = report(spark, work, name).agg(
            F.sum("transaction_count"), F.sum("actual_fraud_count")
        ).first()
        assert totals[:] == (held_out, held_frauds)
    tiers = report(spark, work, "risk_segments_summary")
    assert tiers.agg(F.sum("transaction_count")).first()[0] == held_out
    assert abs(tiers.agg(F.sum("pct_of_total")).first()[0] - 100) < 0.1


def test_metrics_files(spark, finished):
    work, pipeline = finished
    long = {
        r["metric_name"]: r["value"]
        for r in report(spark, work, "model_performance_metrics").collect()
    }
    assert len(long) == 10 and long["auc_roc"] == pipeline.metrics["auc_roc"]
    row = spark.read.text(f"{work}/exports/model_metrics.json").first()[0]
    parsed = json.loads(row)
    matrix = parsed["confusion_matrix"]
    assert sum(matrix[1]) == parsed["support_fraud"] and sum(matrix[0]) == parsed["support_legit"]
    assert parsed["best_params"]["max_depth"] == 3.0
    importance = report(spark, work, "feature_importance_shap")
    assert 0 < importance.count() <= 20
    assert report(spark, work, "search_trials").count() == 1
    assert report(spark, work, "threshold_analysis").columns == [
        "f1_optimal_threshold", "cost_optimal_threshold", "business_low", "business_high",
    ]


def test_resume_from_tables_in_a_new_store(spark, finished):
    work, old = finished
    for name in ("raw_transactions", "risk_segments"):
        forget(spark, old.store, name)
    again = Pipeline(spark, work, buckets=4)
    assert again.run(only=["segment", "export"]) == 0
    assert report(spark, work, "risk_segments_summary").count() >= 1


def test_tables_keep_the_buckets_they_were_written_with(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id AS TransactionID", "id % 7 AS x")
    first = TableStore(spark, str(tmp_path), 8)
    for name in ("left_rows", "right_rows"):
        assert first.replace(name, rows) == 1000
        forget(spark, first, name)
    again = TableStore(spark, str(tmp_path), 4)
    assert again.layout("left_rows") == ("TransactionID", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = again.read("left_rows").join(again.read("right_rows"), "TransactionID")
        assert joined.count() == 1000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def forget(spark, store, name):
    """As in a new session, whose catalog has no such table."""
    spark.sql(f"DROP TABLE {store._declared(name, store.current(name)['version'])}")


def test_a_killed_write_leaves_the_old_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), 4)
    with pytest.raises(FileNotFoundError):
        store.read("t")
    rows = spark.range(1000).withColumnRenamed("id", "TransactionID")
    store.replace("t", rows)
    broken = rows.withColumn("x", F.when(F.col("TransactionID") < 999, F.lit(1)).otherwise(F.raise_error(F.lit("killed"))))
    with pytest.raises(Exception, match="killed"):
        store.replace("t", broken)
    forget(spark, store, "t")
    assert TableStore(spark, str(tmp_path)).read("t").columns == ["TransactionID"]
    assert store.read("t").count() == 1000
    # Killed between the write and the manifest.
    keep, store._publish = store._publish, lambda name, manifest: None
    store.replace("t", rows.limit(5))
    store._publish = keep
    assert store.read("t").count() == 1000


def test_a_table_replaces_itself_and_old_versions_go(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), 2)
    store.replace("t", spark.range(10).withColumnRenamed("id", "TransactionID"))
    for n in (9, 8, 7):
        before = store.read("t")
        assert store.replace("t", before.where(F.col("TransactionID") < n)) == n
        assert before.count() == n + 1 and store.read("t").count() == n
    assert len(list((tmp_path / "t").iterdir())) == 2


def test_missing_files_of_a_table_are_noticed(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), 4)
    store.replace("t", spark.range(1000).withColumnRenamed("id", "TransactionID"))
    folder = tmp_path / "t" / store.current("t")["version"]
    next(folder.glob("part-*")).unlink()
    with pytest.raises(FileNotFoundError):
        TableStore(spark, str(tmp_path)).read("t")


def test_reports_are_single_files(finished):
    work, _ = finished
    exports = [p for p in (pathlib.Path(work) / "exports").iterdir() if not p.name.startswith(".")]
    assert len(exports) >= 8 and all(p.is_file() for p in exports)


def test_table_joins_need_no_shuffle(spark, finished):
    _, pipeline = finished
    store = pipeline.store
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = readers.with_identity(store.read("raw_transactions"), store.read("raw_identity"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        # Writing the result in the same buckets needs no shuffle either.
        placed = joined.repartition(store.buckets, store.key)
        assert "Exchange" not in placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_is_written_once(spark, finished):
    work, pipeline = finished
    path = f"{work}/processed/merged_data.parquet"
    before = spark.read.parquet(path).inputFiles()
    pipeline.run(only=["etl"])
    assert sorted(spark.read.parquet(path).inputFiles()) == sorted(before)


def test_the_checked_job_sizes_its_tables_from_its_input(spark, sf_dir, monkeypatch):
    made = []
    monkeypatch.setattr(catalogue, "Pipeline", lambda *a, **k: made.append(Pipeline(*a, **k)) or made[0])
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        catalogue.job_outputs(spark, sf_dir)
        store = made[0].store
        # As many buckets as joined rows have partitions: the wide rows stay where they are.
        assert {store.layout(n)[1] for n in catalogue.JOB_TABLES} == {10}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
