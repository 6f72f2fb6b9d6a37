"""tidegate: event quality, recovery and incident tables on Spark.

Every operator is a function from DataFrame to DataFrame, so the same code runs on a batch
table and on a stream. See README.md for a tour.
"""
