"""Daily meter telemetry on Spark: typed layers, quality gates, pointer publishing."""
