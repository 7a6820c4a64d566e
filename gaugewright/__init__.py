"""Gauge telemetry on Spark: landed documents, topics, history, current state, status rows."""
