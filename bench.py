"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line.

The canonical views are written once, as a pipeline would prepare its ledger, and
timed under ``prepare_*``. Every query then reads them and its full result is
produced into a no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from finsieve.operators import models as md
from finsieve.plans import catalog, catalog_ranking, views
from finsieve.session import local_session

VIEWS = ("ledger", "features", "scored", "events", "event_features", "dirty")
HEADLINE = (
    "feat_sender_prev_count", "feat_model", "feat_account_days",
    "rate_payment_format", "rate_velocity_band", "rate_single_day", "rate_bank_min_support",
    "dq_duplicates", "dq_missing", "profile_numeric", "profile_cardinality", "corr_matrix", "quartiles_by_class",
    "split_exact", "undersample", "score_contract",
    "average_precision", "pr_curve", "operating_point", "fixed_precision", "alert_budgets",
    "best_model_per_budget", "classification_report", "regression_gate",
    "shapley_global", "shapley_direction",
    "drift_report", "drift_summary", "drift_persistence", "telemetry_per_minute", "telemetry_audit",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def models(spark, sf_dir: str) -> dict[str, float]:
    """Fit on the train fold and score the test fold, apart."""
    train, test = catalog_ranking.train_fold(spark, sf_dir), catalog_ranking.test_fold(spark, sf_dir)
    seconds = {}
    for name, spec in md.specs().items():
        start = time.perf_counter()
        model = md.fit(train, spec)
        seconds[f"fit_{name}"] = round(time.perf_counter() - start, 3)
        start = time.perf_counter()
        run(md.score_batch(model, test))
        seconds[f"score_{name}"] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, "bench")
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in VIEWS:
        start = time.perf_counter()
        views.prepared(spark, sf_dir, name)
        seconds[f"prepare_{name}"] = round(time.perf_counter() - start, 3)
    queries = catalog.queries()
    for name in wanted.split(",") if wanted else HEADLINE:
        start = time.perf_counter()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    if not wanted:
        seconds.update(models(spark, sf_dir))
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}))


if __name__ == "__main__":
    main()
