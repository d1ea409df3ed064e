"""Operational-telemetry analytics as plain Spark DataFrame operators."""
