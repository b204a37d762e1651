"""Layered analytics tables (bronze, silver, gold, platinum) as PySpark jobs.

Everything is a DataFrame-to-DataFrame function: the package declares plans and
leaves join strategy, pushdown and code generation to Spark.
"""

__version__ = "0.1.0"
