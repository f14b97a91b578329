"""demandflow: Spark-native retail demand-forecasting analytics.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, windows, aggregates and Spark ML.  Column names are parameters, and the
time-series operators take optional ``series_keys`` so the same code runs for one
global series or for millions of series partitioned across a cluster.
"""

__version__ = "0.1.0"
