"""Payments analytics on Spark: star-schema KPIs, retention, quality and live windows."""
