"""Spatio-temporal panels on Spark."""
