"""Interval, simulation and genome analytics as Spark DataFrame transformations."""
