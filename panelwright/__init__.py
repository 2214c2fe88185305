"""Country-by-year panels of health, energy and climate indicators on Spark.

Every public function takes and returns lazy DataFrames (or Columns); nothing here
collects to the driver, so Catalyst sees each question and each load as one plan.
"""
