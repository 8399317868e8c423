"""lakeflux: PySpark DataFrame operators and jobs for table delivery, zone ETL,
feature/model evaluation, data profiling and drift checks.

Every operator is a function ``DataFrame -> DataFrame`` (or a writer) built from
Spark's own DataFrame, SQL, ML and Structured Streaming primitives.
"""

__all__ = ["session"]
