"""Film-catalogue analytics as Spark DataFrame operations.

Every public function takes and returns DataFrames (or Columns), so a job is a
chain of ``df.transform(...)`` calls that Catalyst plans as a whole.
"""
