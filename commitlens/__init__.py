"""commitlens: analytics over version-control history, logs and text, as plain PySpark.

Every public function takes and returns DataFrames (or Columns); none collects data to the driver.
"""

__version__ = "0.1.0"
