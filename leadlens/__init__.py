"""leadlens: lead-propensity analytics expressed as Spark DataFrame plans.

Sub-packages:

* ``sources``   – table scans, sinks, CSV batch I/O, profiles, generators.
* ``functions`` – scalar column expressions (null-safe flags, intervals, clips).
* ``operators`` – aggregates, lookups, feature groups, scores, splits, quality
  checks, preprocessing estimators, models, metrics, leaderboard, scoring.
* ``plans``     – the end-to-end jobs (feature build, scored build, training)
  and the registry of checkable queries.
* ``streaming`` – stateless streaming scoring.
"""

__version__ = "0.1.0"
