"""Bike-share station analytics expressed as Spark DataFrame operators."""
