"""Sliding-window alerting over host metrics, written as Spark DataFrame plans."""
