"""Headline benchmark: prints ONE JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced with a ``noop`` write (full execution, no collect).
The feature build runs from the raw tables and writes the feature table once
(S4); downstream steps read that stored copy, as the build pipeline does.
Every step first runs once, untimed, on the smallest fixture (sf0.001) so
the timings measure steady-state execution rather than JVM class loading and
code generation, which a long job on a cluster amortises.  The timed pass
then runs all steps from scratch at ``BENCH_SF_DIR``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from leadlens.operators import aggregates as A  # noqa: E402
from leadlens.operators import metrics as E  # noqa: E402
from leadlens.operators import quality as Q  # noqa: E402
from leadlens.operators import scores as C  # noqa: E402
from leadlens.operators import summaries as S  # noqa: E402
from leadlens.plans.feature_build import stored_feature_table, test_view_keywords  # noqa: E402
from leadlens.plans.q_eval import scored  # noqa: E402
from leadlens.session import local_session  # noqa: E402
from leadlens.sources import testviews as TV  # noqa: E402


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="leadlens-bench")
    timings: dict[str, float] = {}
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if Path(warm_dir).is_dir() and warm_dir != sf_dir:
        steps(spark, warm_dir, {})  # warm-up, untimed
    steps(spark, sf_dir, timings)
    spark.stop()
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": timings, "sf": Path(sf_dir).name.replace("sf", ""),
                      "cpus": int(cpus)}))


def steps(spark, sf_dir: str, timings: dict[str, float]) -> None:
    def run(name, build):
        t0 = time.perf_counter()
        out = build()
        if out is not None:
            force(out)
        timings[name] = round(time.perf_counter() - t0, 3)

    run("activity_aggregate", lambda: A.activity_aggregate(TV.activities_view(spark, sf_dir),
                                                           **test_view_keywords()))
    run("feature_build_and_store", lambda: stored_feature_table(spark, sf_dir) and None)
    run("build_stats_correlations", lambda: force_both(
        S.build_stats(stored_feature_table(spark, sf_dir)),
        S.target_correlations(stored_feature_table(spark, sf_dir))))
    run("p95_scores_split", lambda: scored(spark, sf_dir) and None)
    run("auc_ap_7_scores", lambda: E.evaluate_scores(
        scored(spark, sf_dir).where(F.col("split") == "validation"), "converted", list(C.SCORE_COLUMNS)))
    run("iqr_outliers_rules", lambda: Q.iqr_outliers(Q.valid_flag(TV.training_view(spark, sf_dir)),
                                                     list(TV.NUMERIC_FEATURES)))
    run("ordered_ffill", lambda: Q.fill_ordered(TV.training_view(spark, sf_dir), "id",
                                                list(TV.NUMERIC_FEATURES)))


def force_both(a, b):
    force(a)
    force(b)


if __name__ == "__main__":
    main()
