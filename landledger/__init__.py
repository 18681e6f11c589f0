"""landledger - a Spark-native KPI warehouse for land requests and fee collection.

Every public function takes and returns lazily planned DataFrames.  Reference
dates (``as_of``) and batch tags (``batch_id``) are parameters, never the clock.
"""
