"""pulsegrid: heart-rate telemetry ingestion, alerting and pipeline metrics as Spark DataFrame operators.

Layout:
  constants.py  fixed values the results depend on (thresholds, windows, messages, metric names)
  session.py    session defaults and the shared checkpoint folder
  sources/      readers (JSON lines, Kafka) and fixture views derived from the driver's tables
  functions/    Column-expression helpers (ids, keys, timestamps, labels, sliced windows)
  operators/    decode / validate / detect / alerts / admission / store / metrics / reconcile
  plans/        the named queries and their DuckDB oracles
  streaming/    Structured Streaming jobs (stateful detector, idempotent sinks)
"""

__all__ = ["constants", "session"]
