"""Operators of a training-data pipeline. Nothing outside this folder imports it, save the guard in __spark_entry__."""
