"""Flight-recorder telemetry on Spark: intake, signal alignment, Silver and Gold tables."""
