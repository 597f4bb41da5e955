"""civic_mart: a geocoded star-schema data mart built as Spark DataFrame operators.

Subpackages
-----------
functions   column expressions (calendar, safe casts, surrogate keys, text keys)
sources     readers: seed CSV, GeoJSON layers, JSON pages, page plans, paged data source
operators   DataFrame -> DataFrame operators: filters, quality gate, lookups,
            spatial join and geocode, co-group merge, dimensions, fact, ledger
plans       the registered queries over the driver tables and their DuckDB oracles
streaming   an incremental extract run as Structured Streaming (availableNow)
"""

__version__ = "0.1.0"
