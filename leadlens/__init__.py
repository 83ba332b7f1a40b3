"""leadlens — a Spark-native lead-funnel training-table, ranking-metric and scoring engine.

Layout:
    config      typed contract constants and run parameters
    session     session defaults, durable checkpoint folder
    functions/  column-level building blocks (parameter lookup, time parts, text rules)
    sources/    event shards, lead snapshots, sinks, fixture adapters over driver tables
    operators/  training-table DAG, user features, preparation/encoding, ranking metrics,
                splits, model fitting, registry and promotion gate
    plans/      end-to-end compositions and the registered query catalogue
    streaming/  stream scoring with model hot swap
"""

__version__ = "0.1.0"
