"""rankspark: Spark-native analytics for grouped search-ranking logs.

Every operator is ``DataFrame -> DataFrame`` built from Spark SQL
expressions, joins, aggregates and windows; Catalyst plans the work.
"""

__version__ = "0.1.0"
