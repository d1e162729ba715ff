"""Streaming of the telemetry engine."""
