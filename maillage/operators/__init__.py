"""Relational operators on DataFrames.

No join carries a broadcast hint. Spark broadcasts a side when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, so a
dimension that grows with the data changes the plan instead of filling a driver.
"""
