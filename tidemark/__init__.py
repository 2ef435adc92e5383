"""Propensity scoring and purchase-intent analytics as Spark jobs."""
