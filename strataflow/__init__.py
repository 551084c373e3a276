"""strataflow: medallion-pipeline operators for application-processing data on Spark.

Layers: ``sources`` (tables, bronze ingestion, test inputs), ``functions`` (column
expressions), ``operators`` (relational building blocks), ``plans`` (silver, gold and KPI
tables) and ``streaming`` (incremental ingestion).  Every plan function takes DataFrames and
returns a lazy DataFrame; only ``sources`` and ``streaming`` write.
"""

__version__ = "0.1.0"
