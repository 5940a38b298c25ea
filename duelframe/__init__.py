"""duelframe: Spark-native analytics for two-sided contest tables.

Each row of the input pairs a left ("Red") and a right ("Blue") competitor
with pre-contest statistics, a date and an outcome.  The package audits and
strips outcome-leaking columns, derives differential features, profiles the
table, splits it by time and fits/evaluates baselines -- all as lazy Spark
DataFrame / ``pyspark.ml`` plans.
"""

__version__ = "0.1.0"
