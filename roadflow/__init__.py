"""roadflow: road-traffic analytics as PySpark DataFrame functions.

Every operator takes DataFrames and returns DataFrames, so the same code runs on a batch table, a
streaming source or a catalog table, and the plan is left to Spark.
"""

__version__ = "0.1.0"
