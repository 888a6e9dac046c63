"""Air-quality telemetry on Spark: batch and Structured Streaming over the same DataFrame functions."""
