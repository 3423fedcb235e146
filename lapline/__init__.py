"""lapline: Spark-native lap / result / telemetry analytics.

Data operators are ``DataFrame -> DataFrame`` functions built from column
expressions, windows, joins and aggregations (no Python UDFs), so Catalyst
sees the whole plan.  Model code uses ``pyspark.ml`` or small driver-side
solvers fed by a single distributed aggregation.
"""

__version__ = "0.1.0"
