"""Taxi-trip analytics on Spark: one DataFrame function per operator, for batch and stream alike."""
