"""Interval, annotation and score-track analytics as Spark DataFrame operators."""
