"""Vitals: health-measurement analytics on Spark."""
