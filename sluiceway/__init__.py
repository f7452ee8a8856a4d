"""Sluiceway: declarative batch data jobs on Spark.

A job names a source, any number of Spark SQL transforms over it, and a set of
loads.  Every operator is a function over DataFrames built from Spark's own
expressions, readers and writers.
"""

from sluiceway.plans.runner import JobResult, run_job

__all__ = ["JobResult", "run_job"]
