"""turnstile: visitor analytics on Spark DataFrames.

Sub-packages
------------
sources     table loaders, CSV / parquet / model I/O, cached and optional sources
functions   column-expression builders (scalars, text, statistics)
operators   DataFrame -> DataFrame operators (joins, aggregates, ordered scans,
            journeys, campaigns, tests, text, segmentation, models)
plans       query bindings of the operators to the driver tables, with the
            equivalent DuckDB SQL used as the correctness oracle
streaming   Structured Streaming twin of the inactivity-session operator
"""

__version__ = "0.1.0"
