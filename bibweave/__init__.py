"""Spark-native quality control and linkage for bibliographic tables.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame; nothing here starts a job except the few functions whose names
say so (sinks, streaming runs, data-dependent column discovery).
"""

__version__ = "0.1.0"
