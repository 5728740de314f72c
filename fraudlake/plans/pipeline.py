"""The batch job: ingest, etl, features, train, segment, export (PIPE-01)."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.operators import audit as audit_ops
from fraudlake.operators import boosting, evaluate
from fraudlake.operators.attribution import mean_attribution, top_features
from fraudlake.operators.oversample import oversample
from fraudlake.operators.segment import risk_segments
from fraudlake.operators.split import stratified_split
from fraudlake.plans import checks, reports
from fraudlake.plans.engineer import engineer_features, stored
from fraudlake.session import build_session, copies_released, ensure_checkpoint_dir
from fraudlake.sources import readers, tables
from fraudlake.sources.tables import TableStore, write_report

# The steps, the option names and the report file names below.
STEPS = ["ingest", "etl", "features", "train", "segment", "export"]
log = logging.getLogger("fraudlake")


def select_steps(only: Sequence[str] = (), skip: Sequence[str] = ()) -> list[str]:
    """Steps in their fixed order; ``only`` wins over ``skip``."""
    unknown = {*only, *skip}.difference(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    wanted = set(only) or set(STEPS).difference(skip)
    return sorted(wanted, key=STEPS.index)


class Pipeline:
    """Each step reads persisted tables and writes persisted tables, so any step can resume."""

    def __init__(
        self,
        spark: SparkSession,
        work_dir: str,
        data_dir: str | None = None,
        buckets: int | None = None,
        trials: int = 50,
        use_smote: bool = False,
        parallelism: int = 4,
        candidates: Sequence[dict] | None = None,
        snapshots: bool = True,
    ):
        self.spark = spark
        # One number of buckets for all tables: as asked for, as resumed, or from the input's size.
        folder = f"{work_dir.rstrip('/')}/tables"
        recorded = TableStore(spark, folder).layout("raw_transactions") if buckets is None else None
        self.sized = buckets is not None
        self.store = TableStore(spark, folder, recorded[1] if recorded else buckets)
        self.exports = f"{work_dir.rstrip('/')}/exports"
        self.processed = f"{work_dir.rstrip('/')}/processed"
        self.model_path = f"{work_dir.rstrip('/')}/models/fraud_model"
        self.data_dir = data_dir
        self.trials = trials
        self.use_smote = use_smote
        self.parallelism = parallelism
        self.candidates = candidates
        # The tables are parquet already; at scale a second copy of the wide ones can be left out.
        self.snapshots = snapshots
        self.metrics: dict[str, float] = {}

    def run(self, only: Sequence[str] = (), skip: Sequence[str] = ()) -> int:
        steps = select_steps(only, skip)
        if not steps:
            log.error("no steps to run")
            return 1
        for step in steps:
            log.info("step %s", step)
            with copies_released(self.spark):
                getattr(self, step)()
        return 0

    def ingest(self) -> None:
        if self.data_dir is None:
            raise ValueError("ingest needs data_dir")
        transactions, identity = readers.read_inputs(self.spark, self.data_dir)
        if not self.sized:
            files = [f"{self.data_dir.rstrip('/')}/{f}" for f in (readers.TRANSACTIONS_FILE, readers.IDENTITY_FILE)]
            self.store.buckets = tables.buckets_for(self.spark, *files)
        n_tx = self.store.replace("raw_transactions", transactions)
        n_id = self.store.replace("raw_identity", identity)
        for name in ("raw_transactions", "raw_identity"):
            checks.require_row_ids(self.store.read(name), "TransactionID", name)
        coverage = 100.0 * n_id / n_tx if n_tx else 0.0
        log.info("transactions %d, identity %d, coverage %.1f%%", n_tx, n_id, coverage)

    def etl(self) -> None:
        merged = readers.with_identity(
            self.store.read("raw_transactions"), self.store.read("raw_identity")
        )
        rows = self.store.replace("merged_data", merged)
        log.info("merged_data %d rows", rows)
        merged = self.store.read("merged_data")
        write_report(audit_ops.null_rate_audit(merged), f"{self.processed}/v_null_rates.csv")
        if self.snapshots:
            tables.snapshot_once(merged, f"{self.processed}/merged_data.parquet")

    def features(self) -> None:
        audit = readers.read_audit_csv(self.spark, f"{self.processed}/v_null_rates.csv")
        merged = self.store.read("merged_data")
        rows = self.store.replace("engineered_features", stored(engineer_features(merged, audit)))
        features = self.store.read("engineered_features")
        if self.snapshots:
            tables.snapshot(features, f"{self.processed}/engineered_features.parquet")
        log.info("engineered_features %d rows, %d columns", rows, len(features.columns))

    def train(self) -> None:
        ensure_checkpoint_dir(self.spark)
        matrix, names = boosting.feature_matrix(
            self.store.read("engineered_features"), mark_missing=self.use_smote
        )
        train, test = stratified_split(matrix)
        candidates = self.candidates or boosting.draw_params(self.trials)
        trials = boosting.search(
            train, names, candidates, parallelism=self.parallelism, use_smote=self.use_smote
        )
        write_report(boosting.trials_table(self.spark, trials), f"{self.exports}/search_trials.csv")
        params = boosting.best_params(trials)

        fitted = oversample(train, names) if self.use_smote else train
        model = boosting.fit_boosted_trees(fitted, names, params)
        boosting.save_model(self.spark, model, self.model_path)
        scored = boosting.score(model, test).withColumns(
            {
                "fraud_prob": F.col("fraud_prob").cast("float"),
                "predicted_label": F.col("predicted_label").cast("tinyint"),
            }
        )
        self.store.replace("model_predictions", scored)

        metrics = self.evaluate(self.store.read("model_predictions"))
        tables.write_metrics_json(metrics, params, f"{self.exports}/model_metrics.json")
        write_report(
            evaluate.metrics_long(metrics), f"{self.exports}/model_performance_metrics.csv"
        )
        importance = mean_attribution(model, test, names)
        write_report(top_features(importance), f"{self.exports}/feature_importance_shap.csv")

    def evaluate(self, predictions: DataFrame) -> DataFrame:
        """The metrics row, rounded to four digits, as a local table: it is one row."""
        metrics = evaluate.metrics_row(predictions)
        row = metrics.withColumns(
            {c: F.round(c, 4) for c in evaluate.METRIC_NAMES if not c.startswith("support")}
        ).first()
        self.metrics = {c: row[c] for c in evaluate.METRIC_NAMES}
        result = self.spark.createDataFrame([row], metrics.schema)
        gate = evaluate.quality_gate(result).first()
        if gate["band"]:
            log.warning("quality gate: AUC %.4f is %s", gate["auc_roc"], gate["band"])
        return result

    def segment(self) -> None:
        predictions = self.store.read("model_predictions")
        analysis = evaluate.threshold_analysis(predictions)
        write_report(
            analysis.withColumns(
                {c: F.round(c, 4) for c in ("f1_optimal_threshold", "cost_optimal_threshold")}
            ),
            f"{self.exports}/threshold_analysis.csv",
        )
        segments = risk_segments(
            predictions,
            self.store.read("raw_transactions"),
            self.store.read("raw_identity"),
            self.store.read("engineered_features"),
        ).withColumn("risk_score", F.col("risk_score").cast("tinyint"))
        self.store.replace("risk_segments", segments)

    def export(self) -> None:
        read = self.store.read
        predictions, segments = read("model_predictions"), read("risk_segments")
        transactions, features = read("raw_transactions"), read("engineered_features")
        made = {
            "fraud_summary_by_card_type": reports.by_card_type(predictions, segments, transactions),
            "fraud_summary_by_device": reports.by_device(segments, predictions),
            "fraud_rate_over_time": reports.fraud_rate_over_time(features, transactions),
            "risk_segments_summary": reports.tier_summary(segments),
            "transaction_amount_distribution": reports.amount_distribution(transactions),
        }
        for name, report in made.items():
            write_report(reports.rounded(report), f"{self.exports}/{name}.csv")
        for name, column in (
            ("feature_importance_shap", "feature"),
            ("model_performance_metrics", "value"),
        ):
            found = checks.verify_report(self.spark, f"{self.exports}/{name}.csv", name, column).first()
            if found["present"]:
                log.info("%s: %d rows, first %s", name, found["rows"], found["first_value"])
            else:
                log.warning("%s is missing: run the train step first", name)


def run_pipeline(
    spark: SparkSession,
    work_dir: str,
    data_dir: str | None = None,
    only: Sequence[str] = (),
    skip: Sequence[str] = (),
    **options,
) -> int:
    """0 on success, 1 if the selection leaves no step."""
    return Pipeline(spark, work_dir, data_dir, **options).run(only, skip)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fraudlake")
    parser.add_argument("work_dir")
    parser.add_argument("--data-dir")
    parser.add_argument("--only", nargs="+", choices=STEPS, default=[])
    parser.add_argument("--skip", nargs="+", choices=STEPS, default=[])
    parser.add_argument("--trials", type=int, default=50)
    parser.add_argument("--use-smote", action="store_true")
    parser.add_argument("--buckets", type=int)
    parser.add_argument("--no-snapshots", action="store_true")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    return run_pipeline(
        build_session(),
        args.work_dir,
        args.data_dir,
        args.only,
        args.skip,
        trials=args.trials,
        use_smote=args.use_smote,
        buckets=args.buckets,
        snapshots=not args.no_snapshots,
    )


if __name__ == "__main__":
    sys.exit(main())
