"""sectorlens: DataFrame operators for company-text corpora on Spark.

Every public operator takes and returns a ``pyspark.sql.DataFrame``; the
heavy lifting is left to Catalyst (filters, joins, windows, aggregates).
"""

__version__ = "0.1.0"
