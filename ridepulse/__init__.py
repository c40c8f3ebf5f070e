"""Rental telemetry and weather demand analytics as Spark DataFrame operators."""
