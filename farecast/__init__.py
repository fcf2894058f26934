"""farecast: a PySpark package for trip-style event data.

load -> clean -> key -> features -> sample/split -> scale -> train -> score ->
upsert, in batch and in Structured Streaming, on the DataFrame, SQL and
Spark ML APIs only.
"""

__version__ = "0.1.0"
