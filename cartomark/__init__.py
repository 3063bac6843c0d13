"""cartomark: scoring machine-extracted map data against ground truth on Spark.

Every public function takes and returns DataFrames or Columns; nothing in the
library collects data to the driver.
"""
