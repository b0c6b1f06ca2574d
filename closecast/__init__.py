"""closecast: partial-period (month-to-date) revenue analytics on Spark.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects; the heavy
lifting is declared with the DataFrame API so Catalyst can prune, push down and
plan the shuffles.
"""

__version__ = "0.1.0"
