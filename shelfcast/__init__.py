"""Retail sales analytics and forecasting on Spark.

Every operator is a function from DataFrame to DataFrame; nothing is executed until the
caller writes or reads the result.
"""

__version__ = "0.1.0"
