"""The daily run: check, load, compute features, train, score and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.models import attribution, forest, quality
from serpscope.operators import features, kpi, monitor, star
from serpscope.operators import quality as checks
from serpscope.plans import marts, training
from serpscope.session import materialize
from serpscope.sources import log as source
from serpscope.sources import sinks


@dataclass(frozen=True)
class Store:
    """Where the tables of the daily run live."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))


def check(log: DataFrame, store: Store) -> DataFrame:
    """Run the suite, keep the report, stop when a check fails."""
    results = materialize(checks.validate_events(log), "checks")
    sinks.write_report(results, store.path("reports/checks"))
    checks.dq_gate(results)
    return results


def load(log: DataFrame, store: Store) -> dict[str, int]:
    """Publish the five warehouse tables together, the fact with session steps."""
    tables = star.build_star(log)
    tables["fct_search_events"] = star.add_sequence(tables["fct_search_events"])
    return sinks.full_refresh(tables, store.path("warehouse"))


def compute_features(log: DataFrame, store: Store) -> None:
    """Daily features of users and queries, and their latest rows for serving."""
    spark = log.sparkSession
    for name, key, table in [
        ("user", "user_id_masked", features.user_daily_features(log)),
        ("query", "query_key", features.query_daily_features(log)),
    ]:
        sinks.write_table(table, store.path(f"features/{name}"))
        daily = store.read(spark, f"features/{name}")
        latest = features.latest_snapshot(daily, key)
        sinks.write_table(latest, store.path(f"features/{name}_latest"))


def train(log: DataFrame, store: Store, version: str, **params) -> DataFrame:
    """Fit both models on the matrix and append the measured record; returns all records with
    the active version marked."""
    spark = log.sparkSession
    matrix = training.training_matrix(
        log, store.read(spark, "features/user"), store.read(spark, "features/query")
    )
    split = materialize(training.train_test_split(matrix), "matrix")
    fit, held = (split.where(F.col("split") == s) for s in ("train", "test"))
    model = quality.train_quality_model(fit, **params)
    model.write().overwrite().save(store.path(f"models/quality/{version}"))
    trees = forest.train_outlier_model(split)
    sinks.write_table(trees, store.path(f"models/outliers/{version}"))
    # The cut is part of the model: later batches are held against the training rows.
    cut = forest.training_cut(store.read(spark, f"models/outliers/{version}"), split)
    cuts = spark.createDataFrame([(cut,)], "outlier_cut double")
    sinks.write_table(cuts, store.path(f"models/outlier_cuts/{version}"))
    ranking = attribution.importance_ranking(
        attribution.feature_attribution(model, held, "event_id")
    )
    metrics = quality.holdout_metrics(model, held)
    record = quality.model_record(spark, "quality", version, metrics, ranking)
    sinks.write_table(record, store.path("models/records"), "append")
    return quality.promote_if_better(store.read(spark, "models/records"))


def score(requests: DataFrame, store: Store, version: str) -> DataFrame:
    """Quality score and outlier flag for a table of requests; bounds are checked first, and
    rejected requests stay in the result without scores."""
    spark = requests.sparkSession
    ok, rejected = checks.valid_requests(requests)
    keyed = ok.withColumn(
        "query_key", K.surrogate_key("search_query", "search_intent", "query_category")
    )
    served = training.serve_features(
        keyed,
        store.read(spark, "features/user_latest"),
        store.read(spark, "features/query_latest"),
    )
    model = GBTRegressionModel.load(store.path(f"models/quality/{version}"))
    trees = store.read(spark, f"models/outliers/{version}")
    scored = quality.predict(model, served)
    cut = store.read(spark, f"models/outlier_cuts/{version}").first()["outlier_cut"]
    status = F.lit("scored")
    flagged = forest.score_outliers(trees, scored, offset=cut).withColumn("status", status)
    refused = rejected.withColumn("status", F.lit("rejected"))
    return flagged.unionByName(refused, allowMissingColumns=True)


def report(log: DataFrame, store: Store, since: str | None = None) -> list[str]:
    """KPI and monitoring tables.

    Those that add up come from tables kept by days, of which only the days from `since` on are read
    and replaced. The others look at all events that the log has.
    """
    spark = log.sparkSession
    marts.update(source.time_slice(log, since), store.path("marts"))
    tables = {n: build(spark, store.path("marts")) for n, build in marts.REPORTS.items()} | {
        "overview": kpi.kpi_overview(log),
        "input_kpis": kpi.input_kpis(log),
        "latency_percentiles": kpi.latency_percentiles(log),
        "alerts": monitor.alert_levels(log),
        "anomalies": monitor.zscore_anomalies(log),
    }
    for name, table in tables.items():
        sinks.write_table(table, store.path(f"reports/{name}"))
    return list(tables)


def requests_of(log: DataFrame) -> DataFrame:
    """Events as scoring requests."""
    return log.select(
        "event_id",
        "user_id_masked",
        F.col("search_query_masked").alias("search_query"),
        "search_intent",
        "query_category",
        *S.REQUEST_FEATURES,
    )


def run_daily(spark: SparkSession, log_path: str, root: str, version: str, **params) -> Store:
    """All steps over one partitioned log."""
    store = Store(root)
    log = source.scan_events(spark, log_path)
    check(log, store)
    load(log, store)
    compute_features(log, store)
    train(log, store, version, **params)
    sinks.write_table(score(requests_of(log), store, version), store.path("scores"))
    report(log, store)
    return store
