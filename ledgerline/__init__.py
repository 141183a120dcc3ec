"""Commercial analytics on Spark: typed staging, star schema, marts, gates, models.

Every operator is a function from DataFrames to a DataFrame. Nothing runs until
the caller triggers an action, so Catalyst sees the whole plan at once.
"""

__version__ = "0.1.0"
