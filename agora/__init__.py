"""agora — a PySpark-native library and pipeline for dirty open-data CSVs.

The package turns all-text raw files into a cleaned BRONZE zone, a GOLD
star schema (dimensions with surrogate keys, facts), a data-quality log
and a load audit trail, then scores scenarios and allocates votes.
Every operator is DataFrame-in / DataFrame-out and built from Catalyst
expressions, so the work is planned and distributed by Spark.
"""

__version__ = "0.1.0"
