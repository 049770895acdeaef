"""Zone analytics and request telemetry as PySpark DataFrame operators."""
