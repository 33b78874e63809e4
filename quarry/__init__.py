"""quarry: a Spark-native analytics library.

Layout:
  quarry.session     one SparkSession builder + the shared scratch folder
  quarry.tables      loading of the input tables
  quarry.sources     readers and writers (files, catalog tables)
  quarry.operators   relational, layout, catalog, versioned-table and ETL operators
  quarry.functions   scalar function families (string, date, math, arrays)
  quarry.streaming   incremental (file-stream) loads
  quarry.plans       the registered queries: name -> (DataFrame builder, oracle SQL)
"""

__all__ = ["session", "tables"]
