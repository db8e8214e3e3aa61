"""Censored wind-resource statistics for meshes of measurement nodes, on Spark."""
