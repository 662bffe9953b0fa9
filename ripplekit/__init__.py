"""ripplekit: PySpark jobs for text counts, rating matrices, changelog
occupancy alerts, operation-log analysis and column digests.

Every operator is a function from DataFrames to a typed DataFrame built on
Spark SQL expressions, windows, joins and keyed streaming state.
"""

__version__ = "0.1.0"
