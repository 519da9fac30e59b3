"""tracewright: Spark-native operators for developer-session telemetry.

Every public operator is a pure ``DataFrame -> DataFrame`` function built from
Catalyst expressions (joins, windows, aggregates, array folds, regex, hashing,
VARIANT JSON). Nothing collects to the driver and no Python UDF sits in the
hot path.
"""

__version__ = "0.1.0"
