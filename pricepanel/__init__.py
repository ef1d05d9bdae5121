"""pricepanel: retail price / demand panel analytics as lazy Spark DataFrame operators.

Every public operator takes one or more DataFrames (plus plain parameters) and
returns a DataFrame; nothing is collected except a few documented plan-time
decisions (pivot value lists, sparse-competitor drops).
"""

__version__ = "0.1.0"
