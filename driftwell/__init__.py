"""driftwell: a Spark-native telemetry analytics engine."""

__all__ = ["__version__"]
__version__ = "0.1.0"
