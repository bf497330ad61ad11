"""gridpulse: batch analytics over hourly, grid-cell activity measurements on Spark.

Every public function takes and returns DataFrames (or Columns), keeps no
session of its own, and receives expected sizes as parameters.
"""

__version__ = "0.1.0"
