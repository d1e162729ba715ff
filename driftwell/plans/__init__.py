"""Plans of the telemetry engine."""
