"""Hourly sensor and weather analytics as Spark jobs.

Every operator is a function ``DataFrame -> DataFrame`` that only declares a plan.
"""
