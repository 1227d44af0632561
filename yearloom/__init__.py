"""Yearly indicators per entity, and regression models on them, as Spark jobs.

Every operator is a plain function from DataFrames to a DataFrame; specs in
``yearloom.specs`` say which columns play which role.
"""

__all__ = ["catalog", "functions", "operators", "plans", "sources", "specs"]
