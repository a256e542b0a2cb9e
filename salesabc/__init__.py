"""Spark-native retail sales consolidation and ABC/Pareto analysis."""

__version__ = "0.1.0"
