"""weekfold: leak-free feature building over entity-by-period tables on Spark.

Every public function takes and returns lazy DataFrames (or Columns), so
Catalyst sees one declarative plan from scan to sink.
"""

__version__ = "0.1.0"
