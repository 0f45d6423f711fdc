"""Event-time telemetry analytics on Spark: watermarks, windows, detections, alerts, views, datasets."""

__version__ = "0.1.0"
