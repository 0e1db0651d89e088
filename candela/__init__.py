"""candela: a Spark-native engine for market-tick analytics.

Bronze → silver → gold medallion processing of price ticks, daily OHLCV with
technical indicators, one-minute streaming window statistics, an idempotent
keyed serving table and the dashboard queries on top of it. Every operator is a
DataFrame → DataFrame function built from Spark SQL expressions.
"""

__version__ = "0.1.0"
