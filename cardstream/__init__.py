"""cardstream: card-transaction analytics on Spark, batch and streaming.

Every operator is a function ``DataFrame -> DataFrame`` (or a pair of
DataFrames) built from Spark SQL functions, windows, joins and, for the two
keyed-state rules in streaming form, ``transformWithStateInPandas``.
"""

__version__ = "0.1.0"
